"""FASTQ and FASTA files as a Spark data source of whole records: byte ranges that begin and end at records, mates side by side.

A range finds its first record by itself. Records are numbered through one count per range; the range of the forward file then
reads its mates from the ranges of the reverse file that hold the same numbers. So no line is shuffled and no mate is joined."""

from __future__ import annotations

import gzip
import json
import os
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 8 << 20
WHOLE = 1 << 62
#: Ranges of a side, but for those that small files add: every task gets the list of them.
RANGES = 2048


class Shape(NamedTuple):
    """A record has `period` lines; a line is its first if it begins with `first` and the one `ahead` lines on with `then`."""

    period: int
    first: bytes
    ahead: int
    then: bytes


#: A quality line may begin like a header, but two lines behind it come bases.
SHAPES = {"fastq": Shape(4, b"@", 2, b"+"), "fasta": Shape(2, b">", 0, b">")}


class Piece(NamedTuple):
    """The records of a file that begin in [start, end), and how many these are once they are counted."""

    path: str
    start: int
    end: int
    n: int = 0


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def pieces(path: str, size: int) -> list[Piece]:
    """The byte ranges of a file, or of a folder's files by name, of `size` bytes or, of large ones, a RANGES-th; gzip files are one range each."""
    store, name = _opened(path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [(path, info)]
    if not info.is_file:
        files = [(f"{path.rstrip('/')}/{x.base_name}", x) for x in sorted(store.get_file_info(fs.FileSelector(name)), key=lambda x: x.base_name)]
    size = max(size, -(-sum(f.size for _, f in files if f.is_file) // RANGES))
    out = []
    for uri, f in files:
        if f.is_file and f.size and not f.base_name.startswith(("_", ".")):
            out += [Piece(uri, 0, WHOLE)] if uri.endswith(".gz") else [Piece(uri, k, min(k + size, f.size)) for k in range(0, f.size, size)]
    return out


def _unpadded(lines: list[bytes], period: int) -> list[bytes]:
    """Without the blank lines behind the last record, which may itself end in blank ones."""
    n = len(lines)
    while n and not lines[n - 1].strip():
        n -= 1
    return lines[: min(-(-n // period) * period, len(lines))]


def stretches(piece: Piece, shape: Shape, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The lines of the piece's records, whole records only, about `block` bytes at a time."""
    store, name = _opened(piece.path)
    with store.open_input_file(name) as raw:
        source = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw
        at, text, ended = piece.start, b"", False
        if at:
            source.seek(at - 1)  # the line that begins at `at`, or else the next
            while b"\n" not in text and not ended:
                more = source.read(block)
                text, ended = text + more, not more
            skipped = text.find(b"\n") + 1
            if not skipped:
                return
            at, text = at - 1 + skipped, text[skipped:]
            while text.count(b"\n") < shape.period + shape.ahead and not ended:
                more = source.read(block)
                text, ended = text + more, not more
            lines = text.split(b"\n")
            heads = (k for k in range(min(shape.period, len(lines) - shape.ahead)) if lines[k].startswith(shape.first) and lines[k + shape.ahead].startswith(shape.then))
            k = next(heads, None)
            if k is None:
                if text.rstrip(b"\r\n").count(b"\n") >= shape.period + shape.ahead and at < piece.end:
                    raise ValueError(f"{piece.path}: no record begins behind byte {at}")
                return
            past = sum(map(len, lines[:k])) + k
            at, text = at + past, text[past:]
        while at < piece.end:
            lines = text.split(b"\n")
            if ended:
                lines = _unpadded(lines[:-1] if not lines[-1] else lines, shape.period)
            n = (len(lines) - (not ended)) // shape.period  # the last line may go on
            if ended and len(lines) > n * shape.period:
                raise ValueError(f"{piece.path}: the last record is cut short")
            if n:
                used = lines[: n * shape.period]
                sizes = np.fromiter(map(len, used), np.int64, len(used)).reshape(n, shape.period).sum(1) + shape.period
                begins = at + np.concatenate([[0], np.cumsum(sizes)])
                own = int(np.searchsorted(begins[:-1], piece.end))
                if own:
                    yield used[: own * shape.period]
                if own < n:
                    return
                text, at = text[int(sizes.sum()) :], int(begins[-1])
            if ended:
                return
            more = source.read(block)
            text, ended = text + more, not more


def _text(lines: list[bytes]) -> pa.Array:
    try:
        found = pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        found = pa.array([x.decode("utf-8", "replace") for x in lines], pa.string())
    return pc.utf8_rtrim(found, "\r")


def records(piece: Piece, shape: Shape) -> Iterator[pa.Table]:
    """(name, seq, qual) of the piece's records: bases upper-cased, full stops as N."""
    for lines in stretches(piece, shape):
        heads, p = lines[0 :: shape.period], shape.period
        if not all(x.startswith(shape.first) for x in heads) or not all(x.startswith(shape.then) for x in lines[shape.ahead :: p]):
            raise ValueError(f"{piece.path}: a record without its marks from byte {piece.start} on")
        seq = pc.replace_substring(pc.utf8_upper(pc.utf8_trim(_text(lines[1::p]), " ")), ".", "N")
        if not pc.all(pc.match_substring_regex(seq, "^[ACGTN]*$")).as_py():
            raise ValueError(f"{piece.path}: not a sequence from byte {piece.start} on")
        qual = _text(lines[3::p]) if p == 4 else pa.nulls(len(heads), pa.string())
        yield pa.table({"name": pc.utf8_slice_codeunits(_text(heads), 1), "seq": seq, "qual": qual})


def _from(parts: list[Piece], skip: int, shape: Shape) -> Iterator[pa.Table]:
    for piece in parts:
        for rows in records(piece, shape):
            if skip < len(rows):
                yield rows.slice(skip)
            skip = max(skip - len(rows), 0)


def _beside(left: Iterator[pa.Table], right: Iterator[pa.Table]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """Both sides in tables of equal length, as far as the left one goes."""
    b = None
    for a in left:
        while len(a):
            if not b:
                b = next(right)
            n = min(len(a), len(b))
            yield a.slice(0, n), b.slice(0, n)
            a, b = a.slice(n), b.slice(n) if len(b) > n else None


class _Range(InputPartition):
    def __init__(self, place: int, piece: Piece, skip: int = 0, others: list[Piece] | None = None):
        self.place, self.piece, self.skip, self.others = place, piece, skip, others


class _Reader(DataSourceReader):
    """One partition per range. Without `counted` a range gives its number of records, with it the records."""

    def __init__(self, options: dict[str, str]):
        plan = json.loads(options["plan"])
        self.shape, self.counted = SHAPES[plan["shape"]], plan["counted"]
        self.sides = [[Piece(*x) for x in side] for side in plan["sides"]]

    def __getstate__(self) -> dict:
        """What a task needs: its range comes with it, so not those of all."""
        return {k: v for k, v in self.__dict__.items() if k != "sides"}

    def partitions(self) -> list[_Range]:
        if not self.counted:
            return [_Range(k, x) for k, x in enumerate(x for side in self.sides for x in side)] or [_Range(0, None)]
        before = [list(accumulate((x.n for x in side), initial=0)) for side in self.sides]
        out = []
        for k, piece in enumerate(self.sides[0]):
            first, n = before[0][k], piece.n
            skip, others = 0, None
            if len(self.sides) == 2 and n:
                low = bisect_right(before[1], first) - 1
                high = bisect_right(before[1], first + n - 1)
                skip, others = first - before[1][low], self.sides[1][low:high]
            if n:
                out.append(_Range(first, piece, skip, others))
        return out or [_Range(0, None)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        piece, at = partition.piece, partition.place
        if piece is None:
            return
        if not self.counted:
            n = sum(len(x) for x in stretches(piece, self.shape)) // self.shape.period
            yield pa.RecordBatch.from_pydict({"place": pa.array([at], pa.int64()), "n": pa.array([n], pa.int64())})
            return
        own = records(piece, self.shape)
        both = ((a, None) for a in own) if partition.others is None else _beside(own, _from(partition.others, partition.skip, self.shape))
        for a, b in both:
            none = pa.nulls(len(a), pa.string())
            cols = {"seqnum": pa.array(np.arange(at + 1, at + 1 + len(a)), pa.int64())}
            cols |= {f"a_{c}": a[c] for c in a.column_names} | {f"b_{c}": b[c] if b else none for c in a.column_names}
            yield from pa.table(cols).combine_chunks().to_batches(max_chunksize=20_000)
            at += len(a)


class RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sequence_records"

    def schema(self) -> str:
        if not json.loads(self.options["plan"])["counted"]:
            return "place long, n long"
        return "seqnum long, a_name string, a_seq string, a_qual string, b_name string, b_seq string, b_qual string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def paired(spark: SparkSession, forward: str, reverse: str | None = None, shape: str = "fastq", split: int = 64 << 20) -> DataFrame:
    """(seqnum, a_name, a_seq, a_qual, b_name, b_seq, b_qual): records of four lines (fastq) or two (fasta), numbered from 1, mates as one row.

    forward and reverse are a file or a folder each (its files by name), local or on any store that pyarrow opens; numbers run through a
    folder's files. Without reverse the b columns are null, in fasta the qualities. Files are read twice, to count and to give rows; the driver
    holds one number per range, of which a side has at most about RANGES beside one per file. A gzip file is one range, and a range reads on from the start of the reverse range that
    holds its first mate, so of a pair both should be gzip or neither. Bases other than ACGTN and the full stop, records without their marks or cut short, and mates of
    unequal number are errors; blank lines at a file's end are none. Empty files give no rows."""
    spark.dataSource.register(RecordSource)
    sides = [pieces(x, split) for x in (forward, reverse) if x is not None]

    def rows(counted: bool) -> DataFrame:
        plan = {"shape": shape, "counted": counted, "sides": sides}
        return spark.read.format("sequence_records").option("plan", json.dumps(plan)).load()

    counts = {r.place: r.n for r in rows(False).collect()}
    flat = iter(range(len(counts)))
    sides = [[x._replace(n=counts[next(flat)]) for x in side] for side in sides]
    totals = {sum(x.n for x in side) for side in sides}
    if len(totals) > 1:
        raise ValueError(f"{forward} and {reverse} have unequal numbers of records: {sorted(totals)}")
    return rows(True)
