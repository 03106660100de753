"""The encoder looks a distinct word up once per call, and its ids are the library's."""

import random

import pytest

pytest.importorskip("tokenizers")

from loomspan.llm.tokens import Encoder, default_path


@pytest.fixture(scope="module")
def own():
    return Encoder(default_path())


class Counted(dict):
    asked = 0

    def get(self, key):
        Counted.asked += 1
        return super().get(key)

    def __getitem__(self, key):
        Counted.asked += 1
        return super().__getitem__(key)


def test_words_are_looked_up_once_per_call(own):
    texts = ["the same words, the same " * 500, "the words. " * 500]
    own.encode(texts)
    known, own.known, Counted.asked = own.known, Counted(own.known), 0
    assert own.encode(texts) == own.whole(texts)
    own.known = known
    assert 0 < Counted.asked <= 10


def test_ids_of_odd_texts_are_the_librarys(own):
    rng = random.Random(9)
    parts = [" ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", " ", "　", ".", ",", "$%", "'", "'s", "12", "É", "é", "ß", "÷", "×", "İ", "ab", "Word", "日本", "😀", "\x00", "<|", "́"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)] + ["", " ", " \t", "a", " a", "a ", "\n\n"]
    assert own.encode(texts) == own.whole(texts)
    assert own.encode([]) == [] and own.encode([None, "", None]) == [b""] * 3


def test_forgotten_words_are_learned_again():
    small = Encoder(default_path(), most=3)
    for texts in (["one two, three. four", None], ["five six"], ["one two, six", "four"]):
        assert small.encode(texts) == small.whole([t or "" for t in texts])
