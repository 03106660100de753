"""Bits of SAM's flag column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: SAM's flag bits in order, from 0x1.
BITS = (
    "paired",
    "proper_pair",
    "unmapped",
    "mate_unmapped",
    "reverse",
    "mate_reverse",
    "first",
    "last",
    "secondary",
    "failed_quality",
    "duplicate",
)


def has(flag: Column, name: str) -> Column:
    return flag.bitwiseAND(1 << BITS.index(name)) != 0


def described(flag: Column) -> Column:
    """Names of the set bits; a segment's strand is named only where the segment is mapped."""
    names = []
    for name in BITS:
        on = has(flag, name)
        if name == "reverse":
            on = on & ~has(flag, "unmapped")
        if name == "mate_reverse":
            on = on & ~has(flag, "mate_unmapped")
        names.append(F.when(on, F.lit(name)))
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def repaired(flag: Column) -> Column:
    """The flag without bits that unmapped (strand, pairing, secondary) or unpaired rows (mate's bits) leave without a meaning."""
    bit = lambda *names: sum(1 << BITS.index(n) for n in names)
    out = F.when(has(flag, "unmapped"), flag.bitwiseAND(~bit("proper_pair", "reverse", "secondary"))).otherwise(flag)
    return F.when(~has(flag, "paired"), out.bitwiseAND(~bit("proper_pair", "mate_unmapped", "mate_reverse", "first", "last"))).otherwise(out)
