"""Operator 9: token ids in files of canonical length-limited Huffman codes."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.memory import release
from loomspan.llm.store import dropped, file_system, put_once, shared_dir, written
from loomspan.llm.tokens import SLICE, default_path, encoder
from loomspan.llm.words import slices

#: Longest code in bits, and so the width of the decoding table.
LONGEST = 16
#: Ids between two checkpoints, and about how many ids an independent block holds.
STEP, BLOCK = 128, 1 << 20
_FILE, _TOP = b"LSHFILE1", "<8sBII"  # a file's mark, longest code, bytes of the packed code lengths, their CRC-32
_MAGIC = b"LSHF"
_HEAD = "<4sIQQI"  # mark, keys, ids, bits, CRC-32 of what follows


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each symbol's code (0: none) of least total size with no code over `longest` bits.

    Package-merge (Larmore and Hirschberg, 1990): at each of `longest` levels neighbours of the
    sorted list are paired and merged with the symbols; a symbol's length is how often it lies
    among the first 2n-2 entries of the last list."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} symbols need codes over {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    levels, row = [], weight
    for _ in range(longest - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weight, pairs])
        place = np.argsort(merged, kind="stable")
        levels.append(place < len(weight))  # of the merged list: which entries are symbols
        row = merged[place]
    take, bits = 2 * len(order) - 2, np.zeros(len(order), np.int64)
    for leaf in reversed(levels):
        own = int(leaf[:take].sum())
        bits[:own] += 1
        take = 2 * (take - own)
    bits[:take] += 1
    lengths[order] = bits
    return lengths


class Code:
    """Canonical codes of given lengths: shorter first, then by symbol; and the table that decodes them."""

    def __init__(self, lengths: np.ndarray, longest: int = LONGEST):
        self.lengths, self.longest = np.asarray(lengths, np.uint8), longest
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        bits = self.lengths[order].astype(np.int64)
        width = np.int64(1) << (longest - bits)
        first = np.cumsum(width) - width
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[order] = (first >> (longest - bits)).astype(np.uint64)
        full = 1 << longest
        self.symbol, self.bits = np.zeros(full, np.uint32), np.ones(full, np.uint8)
        self.symbol[: width.sum()] = np.repeat(order, width)
        self.bits[: width.sum()] = np.repeat(bits, width)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        """(bit string, bit offset of every STEP-th id, bits)."""
        if not len(ids):
            return b"", np.zeros(0, np.uint64), 0
        bits = self.lengths[ids].astype(np.int64)
        if not bits.all():
            raise ValueError("an id has no code")
        end = np.cumsum(bits)
        at = end - bits
        word, room = at >> 6, 64 - (at & 63) - bits
        code = self.codes[ids]
        high = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        heads = np.flatnonzero(np.diff(word, prepend=-1))  # a code starts in each word, as none is over 64 bits
        out = np.zeros(int(end[-1] + 63 >> 6) + 1, np.uint64)
        out[: len(heads)] = np.add.reduceat(high, heads)
        over = np.flatnonzero(room < 0)
        out[word[over] + 1] += code[over] << (64 + room[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: int(end[-1] + 7 >> 3)], at[::STEP].astype(np.uint64), int(end[-1])

    def unpack(self, data: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        """The n ids; all runs between checkpoints advance together, one table look-up per id."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(data + bytes(8), np.uint8).astype(np.uint32)
        three = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
        at, out = marks.astype(np.int64), np.zeros((STEP, len(marks)), np.uint32)
        last, mask = n - (len(marks) - 1) * STEP, np.uint32((1 << self.longest) - 1)
        for k in range(STEP):
            if k == last:
                at = at[:-1]
                if not len(at):
                    break
            peek = three[at >> 3] >> (24 - self.longest - (at & 7)).astype(np.uint32) & mask
            out[k, : len(at)] = self.symbol[peek]
            at = at + self.bits[peek]
        return out.T.reshape(-1)[:n]


def tokenized(docs: DataFrame, path: str, end: int | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, ids: little-endian, crc, wide, id, n) of whole texts; null and empty texts have only the end id.

    wide is the bytes of each id. The rows with an id are the task's counts, n of each id, so that no second pass counts."""
    tail = b"" if end is None else struct.pack("<I", end)
    size = max(len(encoder(path).last), (end or 0) + 1)
    wide = 2 if size <= 1 << 16 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for rows in slices(batches, "text", SLICE):
            ids = [x + tail for x in encoder(path).encode(rows.column(1).to_pylist())]
            crc = pa.array([zlib.crc32(x) for x in ids], pa.int64())
            every = np.frombuffer(b"".join(ids), "<u4")
            counts += np.bincount(every, minlength=size)
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) // 4 * wide
            small = every.astype(f"<u{wide}").tobytes()
            small = [small[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            none = [pa.nulls(len(ids), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(small, pa.binary()), crc, *none], names)
        seen = np.flatnonzero(counts)
        none = [pa.nulls(len(seen), kind) for kind in (pa.int64(), pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(seen), pa.array(counts[seen])], names)

    names = ["key", "ids", "crc", "id", "n"]
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "key long, ids binary, crc long, id long, n long").withColumn("wide", F.lit(wide))


def _ids(raw: bytes, wide: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{wide}")


def id_counts(table: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all of tokenized()'s table; no more numbers than the vocabulary has."""
    out = np.zeros(size, np.int64)
    for row in table.where("id is not null").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.id] = row.n
    return out


def write_files(ids: DataFrame, lengths: np.ndarray, folder: str, most: int = BLOCK) -> DataFrame:
    """Write (key, ids, crc, wide) in ascending key order below the folder; the manifest, one row per file, which lies there too.

    Equal keys (a third of all rows, say) are spread over files by their ids' CRC, nulls come first. A file has the code
    lengths, which alone give the code back, then independent blocks of `most` ids or one document: keys, counts, checkpoints,
    bits, CRC-32."""
    code = Code(lengths)
    small = zlib.compress(code.lengths.tobytes(), 9)
    top = struct.pack(_TOP, _FILE, code.longest, len(small), zlib.crc32(small)) + small

    def block(keys: list[int | None], raws: list[np.ndarray]) -> bytes:
        data, marks, bits = code.pack(np.concatenate(raws))
        body = b"".join(
            [
                np.array([k or 0 for k in keys], "<i8").tobytes(),
                bytes(k is None for k in keys),
                np.array([len(r) for r in raws], "<u8").tobytes(),
                marks.astype("<u8").tobytes(),
                data,
            ]
        )
        return struct.pack(_HEAD, _MAGIC, len(keys), sum(map(len, raws)), bits, zlib.crc32(body)) + body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: dict[str, int] = {"docs": 0, "ids": 0}
        low: list[tuple[bool, int, int]] = []

        def blocks() -> Iterator[bytes]:
            keys, raws, n = [], [], 0
            yield top
            for batch in batches:
                for key, raw, crc, wide in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if not low:
                        low.append((key is not None, key or 0, crc))
                    keys.append(key)
                    raws.append(_ids(raw, wide))
                    n += len(raws[-1])
                    seen["docs"] += 1
                    seen["ids"] += len(raws[-1])
                    if n >= most or len(keys) >= most:
                        yield block(keys, raws)
                        keys, raws, n = [], [], 0
            if keys:
                yield block(keys, raws)

        path = f"{folder}/{uuid.uuid4().hex}.ids"
        size = put_once(path, blocks())
        if seen["docs"]:
            yield pa.RecordBatch.from_pylist(
                [{"path": path, "bytes": size, "docs": seen["docs"], "ids": seen["ids"], "set": low[0][0], "low": low[0][1], "crc": low[0][2]}]
            )

    order = ["key", "crc"]
    spread = ids.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "ids", "crc", "wide")
    kinds = "path string, bytes long, docs long, ids long, set boolean, low long, crc long"
    spread.mapInArrow(run, kinds).write.parquet(f"{folder}/manifest")
    return ids.sparkSession.read.schema(kinds).parquet(f"{folder}/manifest")


def _code(f, path: str) -> Code:
    """The code of an open file, which is left at its first block."""
    magic, longest, n, crc = struct.unpack(_TOP, f.read(struct.calcsize(_TOP)))
    small = f.read(n)
    if magic != _FILE or zlib.crc32(small) != crc:
        raise OSError(f"{path}: damaged code")
    return Code(np.frombuffer(zlib.decompress(small), np.uint8), longest)


def _sizes(head: bytes, path: str) -> tuple[int, int, int, int, int]:
    """(keys, ids, checkpoints, bytes of the body, CRC-32) of a block's head."""
    magic, docs, n, bits, crc = struct.unpack(_HEAD, head)
    if magic != _MAGIC:
        raise OSError(f"{path}: damaged block")
    steps = -(-n // STEP)
    return docs, n, steps, docs * 17 + steps * 8 + (bits + 7 >> 3), crc


def read_blocks(path: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(keys, ids of each key, all ids) of each block of a file; a block that fails its checks is an error."""
    store, name = file_system(path)
    with store.open_input_stream(name, compression=None) as f:
        code = _code(f, path)
        while head := f.read(struct.calcsize(_HEAD)):
            docs, n, steps, size, crc = _sizes(head, path)
            body = f.read(size)
            if zlib.crc32(body) != crc:
                raise OSError(f"{path}: damaged block")
            keys = np.frombuffer(body, "<i8", docs).tolist()
            none = np.frombuffer(body, np.uint8, docs, docs * 8)
            each = np.frombuffer(body, "<u8", docs, docs * 9)
            marks = np.frombuffer(body, "<u8", steps, docs * 17)
            ids = code.unpack(body[docs * 17 + steps * 8 :], marks, n)
            yield [None if x else k for k, x in zip(keys, none, strict=True)], each.astype(np.int64), ids


def ids_at(path: str, start: int, n: int) -> np.ndarray:
    """Up to n ids of a file from its start-th id on: blocks before are skipped, and of a block only the bits from the
    last checkpoint before on are read, so their CRC isn't checked."""
    store, name = file_system(path)
    out, first = [np.zeros(0, np.uint32)], 0
    with store.open_input_file(name) as f:
        code = _code(f, path)
        at = f.tell()
        while n > 0 and (head := f.read_at(struct.calcsize(_HEAD), at)):
            docs, many, steps, size, _ = _sizes(head, path)
            body = at + len(head)
            at = body + size
            if start < first + many:
                a = (start - first) // STEP
                b = min(-(-(start + n - first) // STEP), steps)
                marks = np.frombuffer(f.read_at((min(b + 1, steps) - a) * 8, body + docs * 17 + a * 8), "<u8")
                bits = body + docs * 17 + steps * 8
                low = int(marks[0]) >> 3
                high = bits + (int(marks[b - a]) + 7 >> 3) if b < steps else at
                data = f.read_at(high - bits - low, bits + low)
                ids = code.unpack(data, marks[: b - a] - np.uint64(low * 8), min(many, b * STEP) - a * STEP)
                out.append(ids[start - first - a * STEP :][:n])
                start, n = start + len(out[-1]), n - len(out[-1])
            first += many
    return np.concatenate(out)


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the manifest's files, decoded by the code that each file holds.

    The manifest (spark.read.parquet of a folder's `manifest`) has a row per file: its running totals, made on the driver, are
    the files' starts."""
    spark = manifest.sparkSession
    files, start = [], 0
    for row in manifest.orderBy("set", "low", "crc").toLocalIterator():
        files.append((row.path, start))
        start += row.ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for keys, each, ids in read_blocks(path):
                    ends = np.cumsum(each)
                    crc = [zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends.tolist(), each.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(start + ends - each), pa.array(each), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    start += int(ends[-1])

    todo = spark.createDataFrame(files, "path string, start long").repartition(max(1, len(files)))
    return todo.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded_ids(docs: DataFrame, path: str | None = None, end: int = 2, folder: str | None = None, most: int = BLOCK) -> DataFrame:
    """Tokenize, count, code and write `docs` (doc_id, text) below the folder; the manifest of the files.

    Null and empty texts are one end id; repeated rows are all kept; other columns are ignored; an
    empty table gives an empty manifest."""
    path = path or default_path()
    table = written(tokenized(docs, path, end), "ids")
    lengths = code_lengths(id_counts(table, max(len(encoder(path).last), end + 1)))
    manifest = write_files(table.where("ids is not null"), lengths, folder or f"{shared_dir(docs.sparkSession)}/files", most)
    dropped(table)
    return manifest


def op9_huffman(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_files(encoded_ids(docs))
