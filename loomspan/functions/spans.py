"""Span columns: array<struct<start: bigint, end: bigint>>, 1-based and closed, in ascending order.

Every function maps columns to columns and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TYPE = "array<struct<start: bigint, end: bigint>>"


def span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))


def parse(text: Column, separator: str = ", ") -> Column:
    """Spans of "s-e, s-e"; null and empty texts have none."""
    parts = F.filter(F.split(text, separator), lambda x: F.length(x) > 0)
    return F.coalesce(F.transform(parts, lambda x: span(F.split_part(x, F.lit("-"), F.lit(1)), F.split_part(x, F.lit("-"), F.lit(2)))), F.array().cast(TYPE))


def render(spans: Column, separator: str = ", ") -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws("-", x["start"], x["end"])), separator)


def zipped(starts: Column, ends: Column) -> Column:
    """Spans of two arrays of equal length."""
    return F.zip_with(starts, ends, span)


def total_length(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"] + 1)


def mean_coordinate(spans: Column) -> Column:
    """The mean of all covered coordinates."""
    total = F.aggregate(spans, F.lit(0.0), lambda n, x: n + (x["start"] + x["end"]) * (x["end"] - x["start"] + 1) / 2)
    return total / F.when(total_length(spans) > 0, total_length(spans))


def first_start(spans: Column) -> Column:
    return F.element_at(spans, 1)["start"]


def last_end(spans: Column) -> Column:
    return F.element_at(spans, -1)["end"]


def fused(spans: Column, gap: int = 1) -> Column:
    """The spans sorted, those that overlap or lie less than gap + 1 apart made one."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast(TYPE),
        lambda out, x: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["end"] + gap >= x["start"]),
            F.concat(
                F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))),
                F.array(span(F.element_at(out, -1)["start"], F.greatest(F.element_at(out, -1)["end"], x["end"]))),
            ),
        ).otherwise(F.concat(out, F.array(span(x["start"], x["end"])))),
    )


def union(a: Column, b: Column) -> Column:
    """The coordinates that either covers, as spans."""
    return fused(F.concat(a, b))


def overlap(a: Column, b: Column) -> Column:
    """Whether two closed block lists share a coordinate."""
    return F.exists(a, lambda x: F.exists(b, lambda y: (x["start"] <= y["end"]) & (y["start"] <= x["end"])))


def shared_length(a: Column, b: Column) -> Column:
    """How many coordinates both cover; each list has no overlaps within."""

    def one(n: Column, x: Column) -> Column:
        return n + F.aggregate(
            b,
            F.lit(0).cast("bigint"),
            lambda m, y: m + F.greatest(F.lit(0), F.least(x["end"], y["end"]) - F.greatest(x["start"], y["start"]) + 1),
        )

    return F.aggregate(a, F.lit(0).cast("bigint"), one)


def introns(spans: Column) -> Column:
    """The gaps between neighbouring spans."""
    return F.transform(
        F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0))),
        lambda x, i: span(F.get(spans, i)["end"] + 1, x["start"] - 1),
    )


def clipped(spans: Column, low: Column, high: Column) -> Column:
    """What of the spans lies within [low, high]."""
    inside = F.filter(spans, lambda x: (x["end"] >= low) & (x["start"] <= high))
    return F.transform(inside, lambda x: span(F.greatest(x["start"], low), F.least(x["end"], high)))


def _offsets(spans: Column) -> Column:
    """Each span with the bases before it."""
    kind = "array<struct<start: bigint, end: bigint, before: bigint>>"
    return F.aggregate(
        spans,
        F.array().cast(kind),
        lambda out, x: F.concat(
            out,
            F.array(
                F.struct(
                    x["start"].alias("start"),
                    x["end"].alias("end"),
                    F.when(F.size(out) > 0, F.element_at(out, -1)["before"] + F.element_at(out, -1)["end"] - F.element_at(out, -1)["start"] + 1)
                    .otherwise(F.lit(0))
                    .cast("bigint")
                    .alias("before"),
                )
            ),
        ),
    )


def bases(spans: Column, skip: Column, n: Column) -> Column:
    """The spans of n bases after the first `skip`, counted along the spans."""
    high = skip + n
    inside = F.filter(_offsets(spans), lambda x: (x["before"] < high) & (x["before"] + x["end"] - x["start"] + 1 > skip) & (n > 0))
    return F.transform(
        inside,
        lambda x: span(
            x["start"] + F.greatest(F.lit(0), skip - x["before"]),
            F.least(x["end"], x["start"] + high - x["before"] - 1),
        ),
    )


def prefix(spans: Column, k: Column) -> Column:
    return bases(spans, F.lit(0), k)


def suffix(spans: Column, k: Column) -> Column:
    return bases(spans, F.greatest(total_length(spans) - k, F.lit(0)), F.least(k, total_length(spans)))


def lifted(exons: Column, strand: Column, offset: Column, n: Column) -> Column:
    """Genome spans of n bases from the 0-based offset of a transcript, whose minus strand runs backwards."""
    skip = F.when(strand == "-", total_length(exons) - offset - n).otherwise(offset)
    return bases(exons, F.greatest(skip, F.lit(0)), n)


def cigar_ops(cigar: Column) -> Column:
    """array<struct<len, op>> of a CIGAR string; "*" and null have none."""
    parts = F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1)
    return F.coalesce(
        F.transform(parts, lambda x: F.struct(F.left(x, F.length(x) - 1).cast("int").alias("len"), F.right(x, F.lit(1)).alias("op"))),
        F.array().cast("array<struct<len: int, op: string>>"),
    )


def cigar_spans(position: Column, cigar: Column) -> Column:
    """Reference spans of an alignment that starts at `position`: matches cover, D and N skip, I, S, H and P don't move."""
    kind = "struct<at: bigint, out: array<struct<start: bigint, end: bigint>>>"
    start = F.struct(position.cast("bigint").alias("at"), F.array().cast(TYPE).alias("out")).cast(kind)

    def step(state: Column, x: Column) -> Column:
        moves, covers = x["op"].isin("M", "=", "X", "D", "N"), x["op"].isin("M", "=", "X")
        return F.struct(
            F.when(moves, state["at"] + x["len"]).otherwise(state["at"]).alias("at"),
            F.when(covers, F.concat(state["out"], F.array(span(state["at"], state["at"] + x["len"] - 1)))).otherwise(state["out"]).alias("out"),
        )

    return fused(F.aggregate(cigar_ops(cigar), start, step)["out"])


def without_deletions(spans: Column, longest: int = 14) -> Column:
    """Spans with gaps of at most `longest` bases closed: what a CIGAR without its D covers."""
    return fused(spans, longest + 1)


def to_cigar(spans: Column, intron: int = 15, left: Column | None = None, right: Column | None = None) -> Column:
    """CIGAR of spans without insertions: gaps from `intron` bases on are N, shorter ones D; clips are S."""
    body = F.transform(
        spans,
        lambda x, i: F.concat(
            F.when(i == 0, F.lit("")).otherwise(
                F.concat(
                    (x["start"] - F.get(spans, i - 1)["end"] - 1).cast("string"),
                    F.when(x["start"] - F.get(spans, i - 1)["end"] - 1 >= intron, F.lit("N")).otherwise(F.lit("D")),
                )
            ),
            (x["end"] - x["start"] + 1).cast("string"),
            F.lit("M"),
        ),
    )
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("S"))).otherwise(F.lit(""))
    return F.concat(clip(F.lit(0) if left is None else left), F.array_join(body, ""), clip(F.lit(0) if right is None else right))
