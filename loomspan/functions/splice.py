"""Splice signals: what an intron's first and last two bases say about its strand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Donor and acceptor bases on the plus strand; the first pair is the canonical one.
SIGNALS = (
    ("GT", "AG"),
    ("GC", "AG"),
    ("GC", "TG"),
    ("GC", "AA"),
    ("GC", "CG"),
    ("GT", "TG"),
    ("GT", "AA"),
    ("AT", "AC"),
    ("AT", "AA"),
    ("AT", "AG"),
    ("AT", "AT"),
    ("TA", "GA"),
)


def _turned(bases: str) -> str:
    return bases[::-1].translate(str.maketrans("ACGT", "TGCA"))


#: The strand that an intron's first and last two bases tell.
STRANDS = {text: strand for d, a in reversed(SIGNALS) for strand, text in (("-", _turned(a) + _turned(d)), ("+", d + a))}


def signal(first: Column, last: Column, extra: Sequence[tuple[str, str]] = ()) -> Column:
    """struct<strand, canonical> of an intron's first and last two bases; null if they are no signal."""
    pair = F.concat(F.upper(first), F.upper(last))
    out = None
    for k, (donor, acceptor) in enumerate((*SIGNALS, *extra)):
        for strand, text in (("+", donor + acceptor), ("-", _turned(acceptor) + _turned(donor))):
            value = F.struct(F.lit(strand).alias("strand"), F.lit(k == 0).alias("canonical"))
            out = F.when(pair == text, value) if out is None else out.when(pair == text, value)
    return out
