"""Operations for preparing large training corpora; nothing else in loomspan imports this."""
