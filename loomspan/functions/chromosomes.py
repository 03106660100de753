"""The order of chromosome names: numbers, Roman numerals, X, Y, M, then all others."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import settled

_ROMAN = re.compile(r"(?=[ivxlc])(c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})\Z")
_PARTS = (("c", 100), ("xc", 90), ("l", 50), ("xl", 40), ("x", 10), ("ix", 9), ("v", 5), ("iv", 4), ("i", 1))


def roman(n: int) -> str:
    """A number below 400 in lower-case numerals."""
    out = ""
    for text, value in _PARTS:
        while n >= value:
            out, n = out + text, n - value
    return out


def arabic(text: str) -> int | None:
    """The value of a lower-case numeral below 400; None if it isn't one."""
    return next((n for n in range(1, 400) if roman(n) == text), None) if _ROMAN.match(text) else None


def order_key(name: Column) -> Column:
    """A struct that puts names in a total order: by class, number, then the name's digits as numbers and letters as text.

    Classes: numbers, numerals, X, Y and M, then all others; names with more behind an underscore come after those without."""
    text = F.lower(name)
    core = F.regexp_replace(text, "^chr", "")
    head, tail = F.split_part(core, F.lit("_"), F.lit(1)), F.regexp_extract(core, "_(.*)$", 1)
    late = (tail != "").cast("int")
    whole = lambda x: x.cast("decimal(38,0)")
    pieces = F.transform(
        F.regexp_extract_all(core, F.lit(r"(\d+|\D+)"), F.lit(1)),
        lambda x: F.when(x.rlike(r"^\d+$"), F.struct(F.lit(0).alias("k"), whole(F.right(x, F.lit(38))).alias("n"), F.lit("").alias("t"))).otherwise(
            F.struct(F.lit(1).alias("k"), whole(F.lit(0)).alias("n"), x.alias("t"))
        ),
    )
    numerals = F.create_map(*[F.lit(x) for n in range(1, 400) for x in (roman(n), n)])
    number = F.element_at(numerals, head)
    letter = F.when(head == "x", 0).when(head == "y", 1).when(head.isin("m", "mt"), 2)
    value = F.when(head.rlike(r"^\d+$"), whole(F.right(head, F.lit(38)))).when(letter.isNotNull(), whole(letter)).otherwise(whole(F.coalesce(number, F.lit(0))))
    kind = F.when(head.rlike(r"^\d+$"), 0).when(letter.isNotNull(), 2).when(number.isNotNull(), 1).otherwise(3)
    return F.struct(F.when(kind == 3, 1).otherwise(late).alias("late"), kind.alias("kind"), value.alias("value"), pieces.alias("pieces"), text.alias("text"), name.alias("name"))


def ranks(df: DataFrame, chromosome: str = "chr") -> DataFrame:
    """(chromosome, chr_rank) of the table's distinct names, which may be as many as its rows: numbered in ranges, no task holds all.

    The ranges are computed at once and kept, see session.settled, as both their sizes and their rows are read."""
    return _ranked(df.select(chromosome).where(F.col(chromosome).isNotNull()), chromosome)


def _ranked(names: DataFrame, chromosome: str) -> DataFrame:
    keyed = names.distinct().withColumn("_key", order_key(F.col(chromosome))).repartitionByRange("_key")
    keyed = settled(keyed.withColumn("_range", F.spark_partition_id()))
    sizes = keyed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return keyed.join(F.broadcast(sizes), "_range").select(chromosome, (F.col("_before") + own - 1).cast("int").alias("chr_rank"))


def by_location(df: DataFrame, start: str = "start", end: str = "end", chromosome: str = "chr", then: tuple[Column | str, ...] = ()) -> DataFrame:
    """The rows in order of chromosome, start, end and `then`: a range-partitioned sort by the names' numbers, no name goes to the driver.

    Names are numbered first, once each, so no row works out or compares the parts of its name; df is read twice and must give the same rows."""
    numbers = _ranked(df.select(F.col(chromosome).alias("_name")), "_name").withColumnRenamed("chr_rank", "_rank")
    rows = df.join(numbers, F.col(chromosome).eqNullSafe(F.col("_name")), "left").drop("_name")
    return rows.orderBy("_rank", start, end, *then).drop("_rank")
