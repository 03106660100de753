import json
import pickle
import gzip

import pytest

from loomspan.sources import mates, readers

#: Qualities that begin like headers and like separators, bases in lower case, an empty read, a full stop.
ROWS = [("r1 x", "acg.t", "@II+I"), ("r2", "GG", "++"), ("r3", "", ""), ("@r4", "TTTTTTTTTT", "@@@@@@@@@@"), ("r5", "A", "@"), ("r6", "CC", "I@")]


def fastq(rows, end="\n"):
    return "".join(f"@{n}{end}{s}{end}+{end}{q}{end}" for n, s, q in rows)


def fasta(rows):
    return "".join(f">{n}\n{s}\n" for n, s, _ in rows)


def want(rows):
    return [(n, s.upper().replace(".", "N"), q) for n, s, q in rows]


def read(path, shape, size, block):
    out = []
    for piece in mates.pieces(str(path), size):
        got = [t for lines in mates.stretches(piece, mates.SHAPES[shape], block) for t in [lines]]
        p = mates.SHAPES[shape].period
        assert all(len(x) % p == 0 for x in got)
        out += [x for lines in got for x in lines[::p]]
    return out


@pytest.mark.parametrize("size", range(1, 60))
def test_pieces_of_every_size(tmp_path, size):
    (tmp_path / "a.fq").write_text(fastq(ROWS))
    (tmp_path / "a.fa").write_text(fasta(ROWS))
    for block in (1, 7, 1 << 20):
        assert read(tmp_path / "a.fq", "fastq", size, block) == [f"@{n}".encode() for n, _, _ in ROWS]
        assert read(tmp_path / "a.fa", "fasta", size, block) == [f">{n}".encode() for n, _, _ in ROWS]


def test_cut_at_every_byte(tmp_path):
    path = tmp_path / "a.fq"
    text = fastq(ROWS, "\r\n") + "\n\n"
    path.write_bytes(text.encode())
    shape = mates.SHAPES["fastq"]
    for cut in range(1, len(text)):
        both = [mates.Piece(str(path), 0, cut), mates.Piece(str(path), cut, len(text))]
        rows = [tuple(r.values()) for x in both for t in mates.records(x, shape) for r in t.to_pylist()]
        assert rows == want(ROWS), cut


@pytest.mark.parametrize("split", [1, 13, 50, 1 << 20])
def test_mates_side_by_side(spark, tmp_path, split):
    back = [(f"m{k}", "ACGT"[k % 4] * (k * 7 + 1), "I" * (k * 7 + 1)) for k in range(6)]
    (tmp_path / "a.fq").write_text(fastq(ROWS))
    folder = tmp_path / "b"
    folder.mkdir()
    for k in range(3):  # a folder's files count on
        (folder / f"part-{k}").write_text(fastq(back[2 * k : 2 * k + 2]))
    (folder / "_SUCCESS").write_text("")
    got = sorted(tuple(r) for r in mates.paired(spark, str(tmp_path / "a.fq"), f"file:{folder}", split=split).collect())
    assert got == [(k + 1, *a, *b) for k, (a, b) in enumerate(zip(want(ROWS), back, strict=True))]


def test_same_rows_as_the_lines_reader(spark, tmp_path):
    rows = [(f"r{k}", "ACGT"[k % 4] * (k % 50), "I" * (k % 50)) for k in range(1000)]
    (tmp_path / "a.fq").write_text(fastq(rows))
    (tmp_path / "b.fq").write_text(fastq(rows[::-1]))
    two = [str(tmp_path / x) for x in ("a.fq", "b.fq")]
    one = {(r.seqnum, m, r[f"{m}_name"], r[f"{m}_seq"], r[f"{m}_qual"]) for r in mates.paired(spark, *two, split=4096).collect() for m in "ab"}
    assert one == {(r.seqnum, r.mate, r.name, r.seq, r.qual) for r in readers.fastq(spark, *two).collect()}


def test_gzip_fasta_and_lone_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.fa.gz", "wt") as f:
        f.write(fasta(ROWS))
    got = mates.paired(spark, str(tmp_path / "a.fa.gz"), shape="fasta", split=10).orderBy("seqnum").collect()
    assert [tuple(r) for r in got] == [(k + 1, n, s, None, None, None, None) for k, (n, s, _) in enumerate(want(ROWS))]
    (tmp_path / "none.fq").write_text("")
    assert mates.paired(spark, str(tmp_path / "none.fq")).count() == 0


def test_what_is_wrong_is_told(spark, tmp_path):
    path = tmp_path / "a.fq"
    path.write_text(fastq(ROWS))
    (tmp_path / "b.fq").write_text(fastq(ROWS[1:]))
    with pytest.raises(ValueError, match="unequal numbers"):
        mates.paired(spark, str(path), str(tmp_path / "b.fq"))
    with pytest.raises(FileNotFoundError):
        mates.paired(spark, str(tmp_path / "gone"))
    shape = mates.SHAPES["fastq"]
    for text, message in ((fastq(ROWS)[:-8], "cut short"), (fastq([("r", "AXC", "III")]), "not a sequence"), ("r\nA\n+\nI\n", "without its marks")):
        path.write_text(text)
        with pytest.raises(ValueError, match=message):
            list(mates.records(mates.Piece(str(path), 0, 1 << 40), shape))


def test_ranges_are_bounded(tmp_path, monkeypatch):
    path = tmp_path / "reads.fq"
    path.write_text("".join(f"@{k}\nACGT\n+\n!!!!\n" for k in range(500)))
    monkeypatch.setattr(mates, "RANGES", 10)
    parts = mates.pieces(str(path), 8)
    assert len(parts) == 10 and sum(len(x) for p in parts for x in mates.stretches(p, mates.SHAPES["fastq"])) == 2000
    plan = {"shape": "fastq", "counted": True, "sides": [[x._replace(n=50) for x in parts]]}
    reader = mates._Reader({"plan": json.dumps(plan)})
    assert len(reader.partitions()) == 10 and "reads.fq" not in str(pickle.dumps(reader))
