"""Alignments of a region or a junction, stacked bases, and small tools on read tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions import sequence as Q
from loomspan.functions import spans as S
from loomspan.operators.intervals import overlap_join
from loomspan.operators.junctions import consensus
from loomspan.session import settled


def in_region(rows: DataFrame, chromosome: str, low: int, high: int) -> DataFrame:
    """Alignments that reach into [low, high]; with a table partitioned by chr only one partition is read."""
    return rows.where((F.col("chr") == chromosome) & (S.last_end(F.col("spans")) >= low) & (S.first_start(F.col("spans")) <= high))


def across_junction(rows: DataFrame, chromosome: str, start: int, end: int) -> DataFrame:
    """Alignments with an intron of exactly [start, end]."""
    gaps = S.introns(F.col("spans"))
    return rows.where((F.col("chr") == chromosome) & F.exists(gaps, lambda x: (x["start"] == start) & (x["end"] == end)))


def by_strand(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return rows.where("strand = '+'"), rows.where("strand = '-'")


def stacked(rows: DataFrame, low: int, high: int) -> DataFrame:
    """(pos, base) of every aligned base in [low, high]; rows (spans, seq) without insertions."""
    plain = F.replace("seq", F.lit(":"), F.lit(""))
    places = F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["end"])))
    each = rows.select(F.posexplode(places).alias("k", "pos"), plain.alias("_s")).where(F.col("pos").between(low, high))
    return each.select("pos", F.substring("_s", F.col("k") + 1, F.lit(1)).alias("base"))


def region_consensus(rows: DataFrame, low: int, high: int) -> DataFrame:
    """(pos, base, n) of the region; places without reads get A and 0."""
    best = consensus(stacked(rows, low, high), ["pos"])
    every = rows.sparkSession.range(low, high + 1).withColumnRenamed("id", "pos")
    return every.join(best, "pos", "left").na.fill({"base": "A", "n": 0})


def _cells(hits: DataFrame) -> DataFrame:
    """(region, _hit, pos, k, base): every base of an alignment; k counts the inserted bases behind pos from 1, aligned ones have 0."""
    plain = F.split(F.replace("seq", F.lit(":"), F.lit("")), "[+]")  # aligned and inserted stretches in turn
    places = F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["end"])))
    parts = hits.select("region", "_hit", places.alias("_at"), plain.alias("_parts"), F.posexplode(plain).alias("_i", "_part"))
    done = F.length(F.array_join(F.filter(F.slice("_parts", F.lit(1), F.col("_i")), lambda x, i: i % 2 == 0), ""))
    each = parts.select("region", "_hit", "_at", (F.col("_i") % 2 == 1).alias("_ins"), done.alias("_done"), F.posexplode(F.split("_part", "")).alias("_j", "base"))
    last = F.when(F.col("_done") > 0, F.get("_at", F.col("_done") - 1)).otherwise(F.get("_at", F.lit(0)) - 1)
    pos = F.when(F.col("_ins"), last).otherwise(F.get("_at", F.col("_done") + F.col("_j")))
    return each.where("base <> ''").select("region", "_hit", pos.alias("pos"), F.when(F.col("_ins"), F.col("_j") + 1).otherwise(0).alias("k"), "base")


def region_views(rows: DataFrame, regions: DataFrame, key: tuple[str, ...] = ("seqnum", "mate"), insertions: bool = True) -> DataFrame:
    """(region, kind, key, start, text): the alignments of each region under each other, and their consensus, in texts of equal length.

    rows: key, chr, spans, seq (junctions as colons, insertions between plus signs); regions: region, chr, low, high. Alignments that reach
    into a region are shown whole. All texts of a region share one layout: a column for every place that any of them covers and for every inserted
    base that any of them has, blank in those that lack it, and a mark with its length where no alignment covers anything. Gaps
    behind an alignment's end are blank. Without `insertions` inserted bases are left out. kind is consensus or alignment: of a column the most
    frequent base, of equally frequent ones the first of ACGTN. Columns are numbered per region, bases stay in their tasks until they are
    put together per alignment, so regions, not the table, bound what a task holds. Equal rows are one. Rows without chr, spans or seq, and regions without rows, give nothing."""
    ready = rows.where("size(spans) > 0 and seq is not null").select(*key, "chr", "spans", "seq", S.first_start(F.col("spans")).alias("start"), S.last_end(F.col("spans")).alias("_end"))
    if not insertions:
        ready = ready.withColumn("seq", Q.without_insertions(F.col("seq")))
    hits = overlap_join(ready, regions.select("region", "chr", "low", "high"), ["chr"], ("start", "_end"), ("low", "high"))
    hits = hits.withColumn("_hit", F.struct("start", *key, F.xxhash64("spans", "seq").alias("_h"))).select("region", "_hit", "spans", "seq").distinct()
    cells = settled(_cells(hits))
    order = Window.partitionBy("region").orderBy("pos", "k")
    columns = consensus(cells, ["region", "pos", "k"])
    gap = F.col("pos") - F.lag("pos").over(order) - 1
    columns = columns.withColumn("_mark", F.when(gap > 0, F.concat(F.lit("  <-  "), Q.grouped_digits(gap), F.lit(" bp gap ->  "))).otherwise(""))
    wide = F.sum(F.length("_mark") + 1).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    columns = settled(columns.withColumn("_at", wide))
    ordered = F.array_sort(F.collect_list(F.struct("_at", "_mark", "base")))
    whole = columns.groupBy("region").agg(ordered.alias("_all"), F.max("_at").cast("int").alias("_width"))
    text = lambda what: F.array_join(F.transform("_all", lambda c: F.concat(c["_mark"], what(c))), "")
    whole = whole.select("region", "_width", text(lambda c: c["base"]).alias("text"), text(lambda c: F.lit(" ")).alias("_blank"))
    own = cells.join(columns.select("region", "pos", "k", "_at"), ["region", "pos", "k"]).groupBy("region", "_hit")
    own = own.agg(F.array_sort(F.collect_list(F.struct("_at", "base"))).alias("_own")).join(whole.drop("text"), "region")
    fill = lambda done, c: F.concat(done, F.substring("_blank", F.length(done) + 1, c["_at"] - 1 - F.length(done)), c["base"])
    line = F.rpad(F.aggregate("_own", F.lit(""), fill), F.col("_width"), F.lit(" "))
    lines = own.select("region", F.lit("alignment").alias("kind"), *[F.col(f"_hit.{c}").alias(c) for c in (*key, "start")], line.alias("text"))
    kinds = {f.name: f.dataType for f in lines.schema}
    top = whole.select("region", F.lit("consensus").alias("kind"), *[F.lit(None).cast(kinds[c]).alias(c) for c in (*key, "start")], "text")
    return lines.unionByName(top)


def replicated(rows: DataFrame, copies: int, key: str = "seqnum", shift: int = 0) -> DataFrame:
    """The rows `copies` times, each copy's key moved on by `shift` more."""
    each = rows.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return each.withColumn(key, F.col(key) + F.col("_c") * shift).drop("_c")


def sampled_reads(genome: DataFrame, per_sequence: int, length: int, seed: int = 0) -> DataFrame:
    """(chr, start, seq): random stretches of each sequence that is long enough; the same ones for the same seed."""
    room = F.length("seq") - length + 1
    each = genome.where(room > 0).select("chr", "seq", room.alias("_room"), F.explode(F.sequence(F.lit(1), F.lit(per_sequence))).alias("_k"))
    start = F.pmod(F.xxhash64("chr", "_k", F.lit(seed)), F.col("_room")) + 1
    return each.select("chr", start.alias("start"), F.substring("seq", start.cast("int"), F.lit(length)).alias("seq"))


def renamed_header(name: Column) -> Column:
    """A short sequence name of a database's FASTA header: the first word, without range, build and pipe fields."""
    last = F.regexp_replace(name, r"^>?\s*(?:[^|\s]*\|)*", "")
    return F.regexp_extract(F.regexp_replace(last, r"[\s:;].*$", ""), r"^(\S*)", 1)


def adapter_places(seqs: pa.StringArray, adapter: str, share: float, ahead: float) -> pa.Int32Array:
    """Where the adapter begins in each sequence, null where it isn't placed (see without_adapter).

    All places of all sequences are scored at once: a pass per letter of the adapter over the letters of the batch. Null is the empty sequence."""
    seqs, m = seqs.fill_null(""), len(adapter)
    sizes = pc.utf8_length(seqs).to_numpy(zero_copy_only=False).astype(np.int64)
    letters = np.frombuffer("".join(seqs.to_pylist()).encode("utf-32-le"), np.uint32)
    fits = np.flatnonzero((sizes >= m) & (m > 0))
    if not len(fits):
        return pa.nulls(len(seqs), pa.int32())
    begins = (np.cumsum(sizes) - sizes)[fits]
    n = len(letters) - m + 1
    scores = np.zeros(n, np.int32)
    for k, c in enumerate(map(ord, adapter)):
        scores += letters[k : n + k] == c
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, begins, 1)
    owner = np.cumsum(edges)[:n] - 1
    np.add.at(edges, begins + sizes[fits] - m + 1, -1)
    scores[np.cumsum(edges)[:n] == 0] = -1  # an adapter that would run into the next sequence
    best = np.maximum.reduceat(scores, begins)
    tops = np.flatnonzero((scores >= 0) & (scores == best[owner]))
    at = tops[np.unique(owner[tops], return_index=True)[1]]
    scores[at] = 0
    second = np.maximum.reduceat(scores, begins)
    placed = (best >= m - 1) | ((best >= share * m) & (best >= ahead * second))
    out, none = np.zeros(len(seqs), np.int32), np.ones(len(seqs), bool)
    out[fits], none[fits] = at - begins, ~placed
    return pa.array(out, mask=none)


def without_adapter(rows: DataFrame, adapter: str, least: int = 1, share: float = 0.65, ahead: float = 1.5) -> DataFrame:
    """Reads (seqnum, seq, ...) cut where the adapter begins, less those shorter than `least`, with trimmed_at.

    An exact adapter is cut first, else one with one mismatch, else the best placing with `share` of the
    adapter matching that has `ahead` times the matches of the second best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = adapter_places(batch.column("seq"), adapter, share, ahead)
            yield pa.RecordBatch.from_arrays([*batch.columns, at], [*batch.schema.names, "trimmed_at"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.mapInArrow(run, f"{kinds}, trimmed_at int")
    cut = F.when(F.col("trimmed_at").isNotNull(), F.substring("seq", F.lit(1), F.col("trimmed_at"))).otherwise(F.col("seq"))
    return found.withColumn("seq", cut).where(F.length("seq") >= least)


def sam_junctions(alignments: DataFrame, least: int = 15, only_unique: bool = True, columns: Sequence[str] = ("chr",)) -> DataFrame:
    """(chr, start, end, n): introns of at least `least` bases and how many alignments have them."""
    rows = alignments.where("is_unique") if only_unique else alignments
    each = rows.select(*columns, F.explode(S.introns(F.col("spans"))).alias("x")).select(*columns, "x.start", "x.end")
    return each.where(F.col("end") - F.col("start") + 1 >= least).groupBy(*columns, "start", "end").agg(F.count(F.lit(1)).alias("n"))
