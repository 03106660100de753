"""Span and sequence functions, and coverage as a table function, by name in Spark SQL.

    register(spark)
    spark.sql("SELECT spans_length(spans), reverse_complement(seq) FROM alignments")

The scalar ones are SQL functions that Spark puts into the plan as expressions. coverage_runs is a table function over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

_SPANS = "ARRAY<STRUCT<start: BIGINT, `end`: BIGINT>>"
_NONE = f"CAST(array() AS {_SPANS})"

#: name -> (parameters, result, expression); spans are closed.
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "spans_parse": (
        "text STRING",
        _SPANS,
        "transform(filter(split(coalesce(text, ''), ', '), x -> x <> ''), "
        "x -> struct(CAST(split_part(x, '-', 1) AS BIGINT) AS start, CAST(split_part(x, '-', 2) AS BIGINT) AS `end`))",
    ),
    "spans_render": (f"spans {_SPANS}", "STRING", "array_join(transform(spans, x -> concat_ws('-', x.start, x.`end`)), ', ')"),
    "spans_length": (f"spans {_SPANS}", "BIGINT", "aggregate(spans, 0L, (n, x) -> n + x.`end` - x.start + 1)"),
    "spans_start": (f"spans {_SPANS}", "BIGINT", "get(spans, 0).start"),
    "spans_end": (f"spans {_SPANS}", "BIGINT", "try_element_at(spans, -1).`end`"),
    "spans_introns": (
        f"spans {_SPANS}",
        _SPANS,
        "transform(slice(spans, 2, greatest(size(spans) - 1, 0)), (x, i) -> struct(get(spans, i).`end` + 1 AS start, x.start - 1 AS `end`))",
    ),
    "spans_clipped": (
        f"spans {_SPANS}, low BIGINT, high BIGINT",
        _SPANS,
        "transform(filter(spans, x -> x.`end` >= low AND x.start <= high), x -> struct(greatest(x.start, low) AS start, least(x.`end`, high) AS `end`))",
    ),
    "spans_overlap": (f"a {_SPANS}, b {_SPANS}", "BOOLEAN", "exists(a, x -> exists(b, y -> x.start <= y.`end` AND y.start <= x.`end`))"),
    "spans_mean": (
        f"spans {_SPANS}",
        "DOUBLE",
        "aggregate(spans, 0.0D, (n, x) -> n + (x.start + x.`end`) * (x.`end` - x.start + 1) / 2) / nullif(aggregate(spans, 0L, (n, x) -> n + x.`end` - x.start + 1), 0)",
    ),
    "spans_fused": (
        f"spans {_SPANS}, gap BIGINT",
        _SPANS,
        f"aggregate(array_sort(spans), {_NONE}, (out, x) -> CASE WHEN size(out) > 0 AND try_element_at(out, -1).`end` + gap >= x.start "
        "THEN concat(slice(out, 1, greatest(size(out) - 1, 0)), array(struct(try_element_at(out, -1).start AS start, greatest(try_element_at(out, -1).`end`, x.`end`) AS `end`))) "
        "ELSE concat(out, array(x)) END)",
    ),
    "tile_pieces": (
        "low BIGINT, high BIGINT, size BIGINT",
        "ARRAY<STRUCT<tile: BIGINT, start: BIGINT, `end`: BIGINT>>",
        "CASE WHEN low < high THEN transform(sequence(low div size, (high - 1) div size), "
        "t -> struct(t AS tile, greatest(low, t * size) AS start, least(high, (t + 1) * size) AS `end`)) END",
    ),
    "tile_part": ("chr STRING, tile BIGINT", "BIGINT", "pmod(xxhash64(chr, tile), 512L)"),
    "reverse_complement": ("seq STRING", "STRING", "reverse(translate(seq, 'ACGT', 'TGCA'))"),
    "without_insertions": ("seq STRING", "STRING", r"regexp_replace(seq, '\\+[^+]+\\+', '')"),
    "base_count": ("seq STRING, letter STRING", "INT", "length(seq) - length(replace(seq, letter, ''))"),
    "strand_flipped": ("strand STRING", "STRING", "translate(strand, '+-', '-+')"),
    "rpkm": ("n BIGINT, length BIGINT, reads BIGINT", "DOUBLE", "n * 1000000000.0D / (CAST(length AS DOUBLE) * reads)"),
}


class CoverageRuns:
    """Of one partition's rows (chr, start, end, and tile if there is one), ordered by chr and tile: the half-open runs of coverage, tile by tile.

    Tiles that a batch holds whole are swept together. What is kept is one number per place of the last tile at which it changes, so tiles,
    see tile_pieces, bound it, and a partition may have any number of them."""

    def __init__(self) -> None:
        self.key, self.pos, self.d = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        if not rows.num_rows:
            return
        names = rows.column("chr").dictionary_encode("encode")
        code = names.indices.to_numpy(zero_copy_only=False)
        tile = rows.column("tile").to_numpy(zero_copy_only=False) if "tile" in rows.schema.names else np.zeros(len(code), np.int64)
        first = np.flatnonzero(np.concatenate([[True], (np.diff(code) != 0) | (np.diff(tile) != 0)]))
        keys = [(name is not None, name or "", t) for name, t in zip(names.dictionary.take(pa.array(code[first])).to_pylist(), tile[first].tolist(), strict=True)]
        known = [] if self.key is None else [self.key]
        goes_on = known == keys[:1]
        keys = keys if goes_on else known + keys
        if any(x >= y for x, y in zip(keys, keys[1:])):  # noqa: B905
            raise ValueError("coverage_runs: rows of a partition must be ordered by chr and tile")
        place = np.repeat(np.arange(len(first)) + len(keys) - len(first), np.diff([*first, len(code)]))
        start, end = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("start", "end"))
        one = np.ones(len(start), np.int64)
        group, pos, d = (np.concatenate(x) for x in ((np.zeros(len(self.pos), np.int64), place, place), (self.pos, start, end), (self.d, one, -one)))
        order = np.lexsort((pos, group))
        group, pos = group[order], pos[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(group) != 0) | (np.diff(pos) != 0)]))
        sums = np.add.reduceat(d[order], new)
        new, d = new[sums != 0], sums[sums != 0]
        group, pos = group[new], pos[new]
        last = int(np.searchsorted(group, len(keys) - 1))
        self.key, self.pos, self.d = keys[-1], pos[last:], d[last:]
        yield from self._runs(keys, group[:last], pos[:last], d[:last])

    def terminate(self) -> Iterator[pa.Table]:
        yield from self._runs([self.key], np.zeros(len(self.pos), np.int64), self.pos, self.d)

    def _runs(self, keys: list[tuple], group: np.ndarray, pos: np.ndarray, d: np.ndarray) -> Iterator[pa.Table]:
        cov = np.cumsum(d)[:-1]  # 0 at the end of each tile
        some = np.flatnonzero(cov)
        if len(some):
            names = pa.array([name if known else None for known, name, _ in keys], pa.string()).take(pa.array(group[some]))
            yield pa.table({"chr": names, "start": pos[some], "end": pos[some + 1], "cov": cov[some]})


def register(spark: SparkSession) -> None:
    """Make all of FUNCTIONS and coverage_runs known to the session.

    coverage_runs takes a table of chr (string), start and end (long, half-open), partitioned by chr and, for many rows, cut into tiles, which are
    dealt into parts of many tiles each, as a part costs a call of its own:
    SELECT * FROM coverage_runs(TABLE(SELECT chr, p.tile, p.start, p.`end`, tile_part(chr, p.tile) AS part FROM
    (SELECT chr, tile_pieces(start, `end`, 65536) AS pieces FROM t) LATERAL VIEW explode(pieces) AS p) PARTITION BY part ORDER BY (chr, tile)).
    PARTITION BY (chr, tile) gives the same, a call per tile.
    Runs end at a tile's border; rows without a bound, or that end before they begin, have no pieces."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    spark.udtf.register("coverage_runs", arrow_udtf(CoverageRuns, returnType="chr string, start bigint, end bigint, cov bigint"))
