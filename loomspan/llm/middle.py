"""Operator 13: fill-in-middle by rotating blocks of a text in place, and its exact inverse."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm.words import slices

#: Sentinels before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes that are scanned or swapped at a time: bounds what a long text needs besides itself.
STRETCH = 1 << 20
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _starts(raw: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which of the bytes a to b begin a token, `[A-Za-z]+` or one other code point."""
    letter = _LETTER[raw[a:b]]
    before = np.empty(b - a, bool)
    before[:1], before[1:] = a > 0 and _LETTER[raw[a - 1]], letter[:-1]
    return ((raw[a:b] & 0xC0) != 0x80) & ~(letter & before)


class Units:
    """The tokens of a text of UTF-8 bytes: their number, and where one of them begins."""

    def __init__(self, raw: np.ndarray):
        self.raw = raw
        self.parts = [(a, min(a + STRETCH, len(raw))) for a in range(0, len(raw), STRETCH)]
        self.upto = np.cumsum([0] + [int(np.count_nonzero(_starts(raw, a, b))) for a, b in self.parts])
        self.n = int(self.upto[-1])

    def byte(self, unit: int) -> int:
        if unit == self.n:
            return len(self.raw)
        k = int(np.searchsorted(self.upto, unit, "right")) - 1
        a, b = self.parts[k]
        return a + int(np.flatnonzero(_starts(self.raw, a, b))[unit - self.upto[k]])


def _reverse(v: np.ndarray, a: int, b: int) -> None:
    while b - a > 1:
        k = min(STRETCH, (b - a) // 2)
        left = v[a : a + k].copy()
        v[a : a + k] = v[b - k : b][::-1]
        v[b - k : b] = left[::-1]
        a, b = a + k, b - k


def exchange(buffer: bytearray, a: int, m: int, b: int) -> None:
    """buffer[a:m] and buffer[m:b] change places, by three reversals."""
    v = np.frombuffer(buffer, np.uint8)
    _reverse(v, a, m)
    _reverse(v, m, b)
    _reverse(v, a, b)


def moved(raw: bytes, first: int, second: int, form: str, marks: tuple[bytes, bytes, bytes]) -> bytearray:
    """The text cut at two bytes, with sentinels, its middle moved behind its suffix."""
    p, s, m = marks
    out = bytearray(raw)
    out[second:second] = s
    out[first:first] = m
    out[0:0] = p
    # now P prefix M middle S suffix
    tail = len(p) + second + len(m)
    exchange(out, 0 if form == "spm" else len(p) + first, tail, len(out))
    return out


def back(raw: bytes, form: str, marks: tuple[bytes, bytes, bytes]) -> bytearray:
    """The text that moved() made this of."""
    p, s, m = marks
    out = bytearray(raw)
    begin, turn = (0, out.find(p)) if form == "spm" else (out.find(s), out.find(m))
    exchange(out, begin, turn, len(out))
    tail = begin + len(out) - turn
    del out[tail : tail + len(s)]
    at = out.find(m)
    del out[at : at + len(m)]
    del out[: len(p)]
    return out


def _points(raw: np.ndarray, a: int, b: int) -> int:
    return sum(int(np.count_nonzero((raw[k : min(k + STRETCH, b)] & 0xC0) != 0x80)) for k in range(a, b, STRETCH))


def _kinds(docs: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema)


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, moved_pct: int = 90, spm_pct: int = 20, marks: tuple[str, str, str] = MARKS
) -> DataFrame:
    """docs with n (tokens), form (plain, psm or spm), prefix_chars, middle_chars and output; columns of such names are replaced.

    A document's draws are 8-digit groups of sha256("seed:key"), so they depend on nothing but its key: two cut
    points among its tokens, whether it is moved at all, and the order. Null texts count as empty; empty ones, and those that hold a
    sentinel, stay plain, with null lengths. Rows that repeat a key are cut at their own tokens by the same draws; a null key draws as
    the word null. Long texts are scanned and rotated a stretch at a time. Other columns are kept; an empty table stays empty."""
    added = ["n", "form", "prefix_chars", "middle_chars", "output"]
    docs = docs.drop(*added)
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4))
    whole = F.coalesce(F.col(text), F.lit(""))
    plain = (whole == "") | (h3 % 100 >= moved_pct)
    for mark in marks:
        plain = plain | F.contains(whole, F.lit(mark))
    form = F.when(plain, "plain").when(h4 % 100 < spm_pct, "spm").otherwise("psm")
    ready = docs.select("*", form.alias("form"), h1.alias("output"), h2.alias("n"))
    raw_marks = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, text):
            *old, forms, first, second = rows.columns
            n, prefix, middle, out = [], [], [], []
            for t, kind, one, two in zip(rows.column(text), forms.to_pylist(), first.to_pylist(), second.to_pylist(), strict=True):
                raw = (t.as_py() or "").encode()
                view = np.frombuffer(raw, np.uint8)
                units = Units(view)
                n.append(units.n)
                if kind == "plain":
                    prefix.append(None)
                    middle.append(None)
                    out.append(raw)
                    continue
                a, b = (units.byte(u) for u in sorted((one % (units.n + 1), two % (units.n + 1))))
                prefix.append(_points(view, 0, a))
                middle.append(_points(view, a, b))
                out.append(bytes(moved(raw, a, b, kind, raw_marks)))
            new = [pa.array(n, pa.int64()), forms, pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*old, *new], [*rows.schema.names[:-3], *added])

    return ready.mapInArrow(run, f"{_kinds(docs)}n long, form string, prefix_chars long, middle_chars long, output string")


def restored(rows: DataFrame, output: str = "output", form: str = "form", marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """rows with the column restored: the exact text that fill_in_middle made each output of, from output and form alone.

    A null output is restored as the empty text; other columns are kept (one named restored is replaced)."""
    rows = rows.drop("restored")
    raw_marks = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, output):
            out = []
            for t, kind in zip(part.column(output), part.column(form).to_pylist(), strict=True):
                raw = (t.as_py() or "").encode()
                out.append(raw if kind == "plain" else bytes(back(raw, kind, raw_marks)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary()).cast(pa.string())], [*part.schema.names, "restored"])

    return rows.mapInArrow(run, f"{_kinds(rows)}restored string")


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = restored(fill_in_middle(docs).drop("text"))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
    FROM documents
), drawn AS (
    SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
        ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS u, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS v,
        ('0x' || substr(h, 17, 8))::BIGINT % 100 AS x, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS y
    FROM cut
), parts AS (
    SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR x >= 90 THEN 'plain'
            WHEN y < 20 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(units[1 : least(u, v)], '') AS p, array_to_string(units[least(u, v) + 1 : greatest(u, v)], '') AS m,
        array_to_string(units[greatest(u, v) + 1 :], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
