"""Orders of tables: by place, by read, by a column, without repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions.chromosomes import by_location


def by_read(rows: DataFrame, read: str = "seqnum", mate: str = "mate") -> DataFrame:
    """By read number, joined rows first, then forward and reverse ones."""
    return rows.orderBy(read, mate)


def distinct_by_location(rows: DataFrame, start: str = "start", end: str = "end", chromosome: str = "chr") -> DataFrame:
    """Each row once, by chromosome and place; rows of one place by their other columns."""
    others = tuple(c for c in rows.columns if c not in (start, end, chromosome))
    return by_location(rows.distinct(), start, end, chromosome, others)


def by_column(rows: DataFrame, number: int, ties: Sequence[str] = ()) -> DataFrame:
    """By the number-th column from 1, backwards if the number is negative."""
    column = F.col(rows.columns[abs(number) - 1])
    return rows.orderBy(column.desc() if number < 0 else column.asc(), *ties)


def united(tables: Sequence[DataFrame], header: str) -> DataFrame:
    """The lines (value) of several files without those that are the header."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out.where(F.col("value") != header)
