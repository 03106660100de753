"""Operator 6: WARC archives with revisit records, and a reader that salvages damaged ones."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.store import file_system, put_once, shared_dir, written

#: Payloads of fewer bytes are never revisits; about how many bytes an archive file and a read hold.
LEAST, FILE_BYTES, READ = 1000, 64 << 20, 1 << 20
#: Bytes of a compressed piece, and of a record's block that are held.
PIECE, HOLD = 1 << 16, 1 << 28
_GZIP, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_MARKS = (_GZIP, _VERSION)
_STAMP = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """One WARC record: a response, or a revisit that keeps only the HTTP header of an equal payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    place = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_STAMP}",
        f"WARC-Target-URI: {place}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[5:5] = [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """data as a gzip member of its own, so that a reader can start at it."""
    gz = zlib.compressobj(3, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, packed: bool = True) -> DataFrame:
    """Write pages (page_id, url, html) as WARC files; the manifest (path, bytes, records).

    Of equal payloads of at least `least` bytes the row of the largest page_id is the response and the rest
    revisit it; of rows that repeat that page_id the one with the last url, and only rows equal in all three are responses each. Payloads are compared by SHA-1 and length, whose largest
    page_id is found with map-side combining; the join that gives it to each page has one row per digest on one
    side, so a payload that a third of all pages share is split as a skewed join. Null page_ids are
    responses or revisits like others, but never referred to: where all pages of a payload have none, all are responses."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    chosen = rows.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max(F.struct("page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("top"))
    chosen = chosen.select("digest", "size", F.col("top.page_id").alias("first"), F.col("top.url").alias("first_url"))
    rows = rows.join(chosen, ["digest", "size"], "left").select("page_id", "url", "payload", "digest", "first", "first_url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = (row for batch in batches for at in range(0, batch.num_rows, 64) for row in batch.slice(at, 64).to_pylist())
        row = next(waiting, None)
        while row is not None:
            count = 0

            def records() -> Iterator[bytes]:
                nonlocal row, count
                total = 0
                while row is not None and total < FILE_BYTES:
                    own = row["first"] is None or (row["first"] == row["page_id"] and row["first_url"] == (row["url"] or ""))
                    data = record(row["page_id"], row["url"], row["payload"], None if own else row["first"], row["digest"])
                    data = member(data) if packed else data
                    yield data
                    total, count, row = total + len(data), count + 1, next(waiting, None)

            path = f"{folder}/{uuid.uuid4().hex}.warc" + ".gz" * packed
            size = put_once(path, records())
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": count}])

    return written(rows.mapInArrow(run, "path string, bytes long, records long"), "manifest")


class Damaged(ValueError):
    """A record or member that fails a check."""


class _Source:
    """A file by place, of which one stretch of READ bytes is held."""

    def __init__(self, file):
        self.file, self.size, self.low, self.data = file, file.size(), 0, b""
        self.zero, self.failed = {}, set()  # for a header's name and comment: a place and the first zero byte from there on; where inflating led to no record

    def get(self, at: int, n: int) -> bytes:
        """Up to n bytes from `at` on: fewer only at the end."""
        out = b""
        while n > len(out) and at < self.size:
            if not self.low <= at < self.low + len(self.data):
                self.low, self.data = at, self.file.read_at(READ, at)
                if not self.data:
                    break
            part = self.data[at - self.low : at - self.low + n - len(out)]
            out, at = out + part if out else part, at + len(part)
        return out

    def hold(self, at: int) -> None:
        pass

    def next_zero(self, at: int, what: int) -> int:
        """The first zero byte from `at` on, or the end; places asked for in order cost one pass over the file."""
        low, found = self.zero.get(what, (0, -1))
        if not low <= at <= found:
            found = at
            while found < self.size:
                data = self.get(found, READ)
                k = data.find(b"\0")
                found += len(data) if k < 0 else k
                if k >= 0:
                    break
            self.zero[what] = at, found
        return found

    def deflated(self, at: int) -> int | None:
        """Where the compressed bytes of the gzip member at a place begin; None if its header isn't one or was cut."""
        head = self.get(at, 12)
        if len(head) < 12 or head[3] & 0xE0:
            return None
        place = at + 10
        if head[3] & 4:
            place += 2 + int.from_bytes(head[10:12], "little")
        for flag in (8, 16):  # name, comment
            if head[3] & flag:
                place = self.next_zero(place, flag) + 1
        place += head[3] & 2
        return place if place < self.size else None

    def checked(self, at: int, place: int) -> bool:
        """Whether the header's own sum, if it has one, is right."""
        if not self.get(at + 3, 1)[0] & 2:
            return True
        head = self.get(at, place - at)
        return zlib.crc32(head[:-2]) & 0xFFFF == int.from_bytes(head[-2:], "little")


class _Inflated:
    """The content of the gzip member at a place of the source, whose compressed bytes begin at `first`, by place. Members of up to READ bytes are held whole; of others
    one stretch is, with the inflater's state before a held place, from which it is inflated again."""

    def __init__(self, source: _Source, at: int, first: int):
        self.source, self.start, self.why, self.whole = source, first, "", None
        self.origin = self.kept = self.before = (0, None, first, b"")
        self._rewind(self.origin)
        n, data, check = 0, b"", 0
        while self._more():
            n += len(self.data)
            check = zlib.crc32(self.data, check)
            data = self.data if n == len(self.data) else data + self.data if n <= READ else b""
        end = self.next - len(self.gz.unused_data)
        if self.gz.eof and not self.why:
            sums = source.get(end, 8)
            if sums != check.to_bytes(4, "little") + (n & 0xFFFFFFFF).to_bytes(4, "little"):
                self.why = "member's end" if len(sums) < 8 else "member"
            end += len(sums)
        self.used = end - at
        if n <= READ:
            self.whole = data
        else:
            self._rewind(self.origin)

    def _rewind(self, state: tuple) -> None:
        self.low, gz, self.next, self.rest = state
        self.gz, self.data, self.over = zlib.decompressobj(-15) if gz is None else gz.copy(), b"", False

    def _more(self) -> bool:
        """Inflate the next stretch; why says what ended a member that isn't whole."""
        self.low, self.data = self.low + len(self.data), b""
        while not self.data and not self.gz.eof and not self.over:
            self.before = (self.low, self.gz.copy(), self.next, self.rest) if self.next > self.start else self.origin
            piece = self.rest or self.source.get(self.next, PIECE)
            if not piece:
                self.why = "member's end"
                return False
            self.next += 0 if self.rest else len(piece)
            try:
                self.data = self.gz.decompress(piece, READ)
                self.rest = self.gz.unconsumed_tail
            except zlib.error:
                self._tear(piece)
        return bool(self.data)

    def _tear(self, piece: bytes) -> None:
        """Take what the piece gives up to the byte at which inflating fails."""
        low, high = 0, len(piece)
        while low < high:  # a start without the failing byte inflates
            mid = (low + high + 1) // 2
            try:
                self._again().decompress(piece[:mid])
                low = mid
            except zlib.error:
                high = mid - 1
        gz, at = self._again(), low
        out = gz.decompress(piece[:low])
        self.why, self.over, self.gz, self.data, self.rest = "member", True, gz, out, b""
        self.next -= len(piece) - at

    def _again(self):
        return zlib.decompressobj(-15) if self.before[1] is None else self.before[1].copy()

    def get(self, at: int, n: int) -> bytes:
        if self.whole is not None:
            return self.whole[at : at + n]
        if at < self.low:
            self._rewind(self.kept if self.kept[0] <= at else self.origin)
        out = b""
        while n > len(out):
            if at < self.low + len(self.data):
                part = self.data[at - self.low : at - self.low + n - len(out)]
                out, at = out + part if out else part, at + len(part)
            elif not self._more():
                break
        return out

    def hold(self, at: int) -> None:
        """Places from `at`, in the present stretch, on will be asked for again."""
        if self.before[0] <= at:
            self.kept = self.before


@dataclass
class Part:
    """A sound record, or a gap: bytes of the file, or (inner: place and bytes of a member's content) of a member, that hold none."""

    kind: str
    at: int
    bytes: int
    fields: dict[str, str] = field(default_factory=dict)
    block: bytes | None = None
    why: str = ""
    inner: tuple[int, int] | None = None
    payload: tuple[int, str] | None = None  # size and SHA-1 of a payload that is too large to hold
    torn: bool = False  # from a member that fails its own check: the block's digest holds, nothing vouches for the header


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        raise Damaged("version line")
    out = {}
    for line in lines[1:]:
        name, mark, value = line.partition(":")
        if not mark:
            raise Damaged("header line")
        name = name.strip().lower()
        if name in out and name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
            raise Damaged("two headers in one")
        out[name] = value.strip()
    return out


def _one(source: _Source | _Inflated, at: int, sure: bool, most: int) -> tuple[int, Part]:
    """(end, record) of the plain record at a place. A block of over READ bytes is hashed before it is held, so a false length
    costs no memory; where the place is not sure (in a torn member) the record needs a digest of its own."""
    n = 4096
    head = source.get(at, n)
    if not re.match(rb"WARC/1\.[01]\r\n", head):
        raise Damaged("version line")
    source.hold(at)
    while (end := head.find(b"\r\n\r\n")) < 0:
        # no header holds another version line, so of headers that never end each is read up to the next one
        if len(head) < n or head.find(b"\r\n" + _VERSION) >= 0:
            raise Damaged("header's end")
        n *= 4
        head = source.get(at, n)
    fields = _fields(head[:end])
    size = fields.get("content-length", "")
    if not size.isdigit() or len(size) > 15:
        raise Damaged("length")
    size, start = int(size), at + end + 4
    digest = fields.get("warc-block-digest", "")
    if not digest.startswith("sha1:") and not sure:
        raise Damaged("no digest in a torn member")
    part = Part("record", at, start + size + 4 - at, fields)
    if size <= READ:
        block = source.get(start, size + 4)
        if len(block) < size + 4 or block[size:] != b"\r\n\r\n":
            raise Damaged("record's end")
        part.block = block[:size]
        found = hashlib.sha1(part.block)
    else:
        source.hold(at)
        if isinstance(source, _Source) and source.get(start + size, 4) != b"\r\n\r\n":
            raise Damaged("record's end")
        found, body, done = hashlib.sha1(), None, 0
        while done < size:
            piece = source.get(start + done, min(READ, size - done))
            if not piece:
                raise Damaged("record's end")
            found.update(piece)
            if body is None:  # the payload begins in the first piece
                http = piece.find(b"\r\n\r\n") + 4
                body, skipped = hashlib.sha1(piece[http:]), http
            else:
                body.update(piece)
            done += len(piece)
        if source.get(start + size, 4) != b"\r\n\r\n":
            raise Damaged("record's end")
        part.payload = (size - skipped, body.hexdigest())
    if digest.startswith("sha1:") and base64.b32encode(found.digest()).decode() != digest[5:]:
        raise Damaged("block digest")
    if size > READ:
        part.block = source.get(start, size) if size <= most else source.get(start, skipped)
    return start + size + 4, part


def _member(source: _Source, at: int, first: int, most: int) -> tuple[int, bool, Iterator[Part]]:
    """(bytes, whole, parts) of the gzip member at a place: its sound records, also those before its torn end and those behind a
    damaged one, and the inner gaps between. Without any sound record there are no parts."""
    inside = _Inflated(source, at, first)

    def parts() -> Iterator[Part]:
        place, gap, why, met = 0, -1, "", False
        while inside.get(place, 1):
            try:
                end, part = _one(inside, place, not inside.why, most)
            except Damaged as e:
                if gap < 0:
                    gap, why = place, str(e)
                place = _seek(inside, place + 1, (_VERSION,))
                continue
            if gap >= 0:
                yield Part("gap", at, inside.used, why=why, inner=(gap, place - gap))
                gap = -1
            part.at, part.bytes, part.inner, part.torn, met = at, inside.used, (place, end - place), bool(inside.why), True
            yield part
            place = end
        if gap >= 0 and met:
            yield Part("gap", at, inside.used, why=inside.why or why, inner=(gap, place - gap))

    return inside.used, not inside.why, parts()


def _begin(source: _Source, at: int, most: int) -> tuple[int, bool, str, list[Part], Iterator[Part]]:
    """(end, whole, why, first parts, other parts) of what starts at a place; no first parts if that is no sound record."""
    if source.get(at, 3) != _GZIP:
        try:
            end, part = _one(source, at, True, most)
        except Damaged as e:
            return at, False, str(e), [], iter(())
        return end, True, "", [part], iter(())
    place = source.deflated(at)
    if place is None or place in source.failed or not source.checked(at, place):
        return at, False, "member", [], iter(())
    used, whole, parts = _member(source, at, place, most)
    first = list(itertools.islice(parts, 1))
    if first and first[0].kind == "gap":  # a gap at a member's head: a record follows, or there are no parts
        first += itertools.islice(parts, 1)
        first = first if len(first) > 1 else []
    if not first and not whole:
        source.failed.add(place)
    return at + used, whole, "no sound record in a member" if whole else "member", first, parts


def salvage(path: str, most: int = HOLD) -> Iterator[Part]:
    """The sound records of an archive, and gaps for what lies between them.

    A record is sound when its version line, header, lengths and block digest hold; without a digest the member it lies in must
    inflate with the right CRC. After a failed check the reader looks for the next place where a sound one starts, by
    gzip's magic or a version line, in the file and in what a member inflates to, and logs the bytes in between as
    quarantined: each byte of the file lies in a member or record that has been read, or in a gap. No more than `most` bytes
    of a record are held: of larger ones the payload's size and SHA-1 are told, and the block is its HTTP header."""
    store, name = file_system(path)
    with store.open_input_file(name) as file:
        source, at, gap, why = _Source(file), 0, -1, ""
        while at < source.size:
            end, whole, reason, first, parts = _begin(source, at, most)
            if not first:
                if gap < 0:
                    gap, why = at, reason
                at = end if whole else _seek(source, at + 1, _MARKS)
                continue
            if gap >= 0:
                yield Part("gap", gap, at - gap, why=why)
                gap = -1
            if not whole:  # a cut member may run into the next one
                end = next((k for k in _marks(source, at + 1, end) if _begin(source, k, most)[3]), end)
            for part in itertools.chain(first, parts):
                part.bytes = end - at
                yield part
            at = end
        if gap >= 0:
            yield Part("gap", gap, at - gap, why=why)


def _marks(source: _Source, at: int, end: int) -> Iterator[int]:
    """Places in [at, end) at which a member or a record may start."""
    while (at := _seek(source, at, _MARKS)) < end:
        yield at
        at += 1


def _seek(source: _Source | _Inflated, at: int, marks: tuple[bytes, ...]) -> int:
    """The next place from `at` on where a mark stands, or the end."""
    n = 64  # marks may stand close to each other
    while True:
        data = source.get(at, n)
        found = [k for k in map(data.find, marks) if k >= 0]
        if found:
            return at + min(found)
        if len(data) < n:
            return at + len(data)
        at, n = at + n - len(_VERSION) + 1, min(4 * n, READ)


_KINDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, "
    "path string, at long, bytes long, inner_at long, inner_bytes long, torn boolean, gap string"
)


def read_archives(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record and every quarantined gap of the archives that the manifest (path) names.

    Gaps have record_type `gap`, their place, size and reason. at and bytes are the member's or the plain record's in the file,
    inner_at and inner_bytes the record's or the gap's in what the member inflates to; torn records are whole, but lie in a
    member that is not. Size and digest of a revisit's
    payload are those of the full payload, from its headers. One file at a time is read by a task, record by record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for part in salvage(path):
                    rows.append(_row(path, part, payloads))
                    held += len(part.block or b"")
                    if held > 4 * READ or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    arrow = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(n, arrow[k]) for n, k in (c.split() for c in _KINDS.split(", "))])
    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(run, _KINDS)


def _row(path: str, part: Part, payloads: bool) -> dict:
    row = {"path": path, "at": part.at, "bytes": part.bytes, "record_type": "gap"}
    if part.inner:
        row |= dict(zip(("inner_at", "inner_bytes"), part.inner, strict=True))
    if part.kind == "gap":
        return row | {"gap": part.why}
    fields = part.fields
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    http, _, payload = part.block.partition(b"\r\n\r\n")
    size, found = part.payload or (len(payload), hashlib.sha1(payload).hexdigest())
    full = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
    revisit = fields.get("warc-type") == "revisit"
    digest = fields.get("warc-payload-digest", "")[5:]
    return row | {
        "record_type": fields.get("warc-type"),
        "torn": part.torn,
        "page_id": number("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "refers_to": number("warc-refers-to"),
        "payload_bytes": int(full[1]) if revisit and full else size,
        "payload_digest": base64.b32decode(digest).hex() if revisit and digest else found,
        "payload": payload if payloads and not revisit and len(payload) == size else None,
    }


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """pages written and read back: one row per page. Null html is an empty payload, null urls read as
    about:blank, other columns are ignored, and an empty table gives an empty result."""
    return read_archives(write_archives(pages, folder or f"{shared_dir(pages.sparkSession)}/warc"), payloads=False).where("record_type <> 'gap'")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return archived(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
