"""Nucleotide strings, numbers and ids as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """N and marks stay; letters are upper-case ACGT."""
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def trim_n(seq: Column, start: Column) -> Column:
    """struct<start, end, seq> after the Ns at both ends are cut; start moves by those cut in front."""
    left = F.length(seq) - F.length(F.ltrim(seq, F.lit("N")))
    body = F.trim(seq, F.lit("N"))
    first = start + left
    return F.struct(first.alias("start"), (first + F.length(body) - 1).alias("end"), body.alias("seq"))


def count_of(seq: Column, letter: str) -> Column:
    """How often a single character occurs."""
    return F.length(seq) - F.length(F.replace(seq, F.lit(letter), F.lit("")))


def without_insertions(seq: Column) -> Column:
    """+XX+ marks and what they hold are cut."""
    return F.regexp_replace(seq, r"\+[^+]+\+", "")


def with_junctions(seq: Column, spans: Column) -> Column:
    """A colon between the stretches of the sequence that fall on neighbouring spans."""
    plain = F.replace(seq, F.lit(":"), F.lit(""))
    start = F.struct(F.lit(1).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        n = x["end"] - x["start"] + 1
        return F.struct((state["at"] + n).alias("at"), F.concat(state["out"], F.array(F.substring(plain, state["at"].cast("int"), n.cast("int")))).alias("out"))

    return F.array_join(F.aggregate(spans, start, step)["out"], ":")


def mismatches(a: Column, b: Column) -> Column:
    """Positions in which two strings of equal length differ."""
    return F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda n, x: n + x)


def flipped(strand: Column, when: Column) -> Column:
    """The strand, turned where `when` holds."""
    return F.when(when, F.translate(strand, "+-", "-+")).otherwise(strand)


def truncated(value: Column, digits: int = 4) -> Column:
    """Cut, not rounded, to some decimal digits, towards zero."""
    scale = float(10**digits)
    return (value * scale).cast("bigint") / scale


def rpkm(count: Column, length: Column, reads: Column) -> Column:
    """Reads per kilobase and million, truncated to four digits; 0 where length or reads is 0."""
    return F.when((length > 0) & (reads > 0), truncated(count / (length / 1000) / (reads / 1000000))).otherwise(F.lit(0.0))


def grouped_digits(value: Column) -> Column:
    return F.format_number(value, 0)


def least_match_length(read_length: Column) -> Column:
    """35 for reads under 80 bases, else 50; from 0.8 of the read on, 0.6 of it."""
    base = F.when(read_length < 80, F.lit(35)).otherwise(F.lit(50))
    return F.when(base >= 0.8 * read_length, (0.6 * read_length).cast("int")).otherwise(base)


def least_overlap(read_length: Column) -> Column:
    """35 for reads under 80 bases, else 45; from 0.8 of the read on, 0.6 of it."""
    base = F.when(read_length < 80, F.lit(35)).otherwise(F.lit(45))
    return F.when(base >= 0.8 * read_length, (0.6 * read_length).cast("int")).otherwise(base)


def job_name(text: Column) -> Column:
    """A name of letters, digits, dots and underscores that begins with a letter."""
    safe = F.regexp_replace(text, r"[^A-Za-z0-9_.]+", "_")
    return F.when(safe.rlike("^[A-Za-z]"), safe).otherwise(F.concat(F.lit("job_"), safe))


def error_of(quality: Column) -> Column:
    """The error probability of a phred score."""
    return F.pow(F.lit(10.0), -quality / 10)
