import gzip

from pyspark.sql import functions as F

from loomspan.functions import spans as S
from loomspan.operators import coverage
from loomspan.sources import lines, readers, writers
from loomspan.streaming import coverage as live


def test_numbered_lines_over_blocks(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_text("".join(f"line {k}\n" for k in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = sorted((r.line, r.value) for r in lines.numbered_lines(spark, str(path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(k, f"line {k}") for k in range(5000)]


def test_fastq_and_gzip(spark, tmp_path):
    text = "".join(f"@r{k}\nac.t\n+\nIIII\n" for k in range(6))
    (tmp_path / "a.fq").write_text(text)
    with gzip.open(tmp_path / "b.fq.gz", "wt") as f:
        f.write(text)
    out = readers.fastq(spark, str(tmp_path / "a.fq"), str(tmp_path / "b.fq.gz"))
    assert sorted((r.seqnum, r.mate, r.name, r.seq, r.qual) for r in out.collect())[:2] == [(1, "a", "r0", "ACNT", "IIII"), (1, "b", "r0", "ACNT", "IIII")]
    assert lines.sniffed(spark, str(tmp_path / "a.fq")) == "fastq"
    assert lines.inferred_layout(spark, str(tmp_path / "a.fq")) == (1, 4)


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">x one\nacg\n>y\nTTT\n")
    assert {(r.seqnum, r.seq) for r in readers.fasta(spark, str(tmp_path / "a.fa")).collect()} == {(1, "ACG"), (2, "TTT")}
    assert {(r.chr, r.seq) for r in readers.genome(spark, str(tmp_path / "a.fa")).collect()} == {("x", "ACG"), ("y", "TTT")}
    (tmp_path / "b.fa").write_text(">x\nac\ngt\n>y\nT\n")
    out = readers.one_line(lines.numbered_lines(spark, str(tmp_path / "b.fa")))
    assert {(r.name, r.seq) for r in out.collect()} == {("x", "ACGT"), ("y", "T")}


def test_many_headers_and_chunks(spark, tmp_path):
    seqs = {f"s{k}": "ACGT"[k % 4] * (k % 7) + "acgtacgtacgt"[: k % 13] for k in range(3000)} | {"long": "".join("ACGT"[(k * k) % 4] for k in range(5000))}
    text = "".join(f">{n} x\n" + "".join(f"{s[k : k + 5]}\n" for k in range(0, len(s), 5)) for n, s in seqs.items())
    (tmp_path / "c.fa").write_text("; comment\n" + text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        raw = lines.numbered_lines(spark, str(tmp_path / "c.fa"))
        rows = readers.sequence_lines(raw, stretch=100).collect()
        chunks = readers.chunked(raw, size=64, over=6).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got: dict = {}
    for r in sorted(rows, key=lambda r: r.line):
        assert r.before == len(got.setdefault(r.name.split()[0], ""))
        got[r.name.split()[0]] += r.value
    assert got == {n: s for n, s in seqs.items() if s}
    want = {(n, k): s.upper()[k * 64 : k * 64 + 70] for n, s in seqs.items() for k in range(-(-len(s) // 64))}
    assert {(r.chr, r.chunk): r.seq for r in chunks} == want
    counts = {r.q_name: r.n_masked for r in readers.masked_counts(spark, str(tmp_path / "c.fa"), "T").collect()}
    assert counts["long"] == seqs["long"].count("T")


def test_two_columns(spark, tmp_path):
    (tmp_path / "i.tsv").write_text("gene\tdescription\ng1\tfirst\ng2\tsecond\n")
    assert {tuple(r) for r in readers.two_columns(spark, str(tmp_path / "i.tsv")).collect()} == {("g1", "first"), ("g2", "second")}


def test_gaps_of_psl(spark):
    schema = "matches long, mismatches long, q_gap_count long, q_gap_bases long, t_gap_count long, q_name string, q_size long, q_end long, block_count long, block_sizes array<long>, q_starts array<long>, t_starts array<long>"
    row = lambda n, sizes, qs, ts, tg, wrong=0: (40, wrong, 1, 2, tg, n, 42, 42, len(sizes), sizes, qs, ts)
    data = [
        row("ok", [20, 20], [0, 22], [100, 120], 0),
        row("thin", [34, 6], [0, 36], [100, 134], 0),
        row("same place", [20, 20], [0, 22], [100, 320], 1),
        row("two places", [10, 10, 20], [0, 10, 22], [100, 210, 220], 1),
        row("short gap", [10, 10, 20], [0, 10, 22], [100, 120, 130], 1),
        row("wrong", [20, 20], [0, 22], [100, 120], 0, 3),
    ]
    out = readers.kept_psl(spark.createDataFrame(data, schema))
    assert {r.q_name for r in out.collect()} == {"ok", "two places"}


def test_alignment_round_trip(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("seq.7a\tchr1\t1-5, 9-10\t+\tACGTA:CC\nseq.8\tchr2\t3-4\t-\tAC\n")
    rows = readers.alignments(spark, str(tmp_path / "in.tsv"))
    assert {(r.seqnum, r.mate, r.n) for r in rows.select("seqnum", "mate", S.total_length(F.col("spans")).alias("n")).collect()} == {(7, "a", 7), (8, "", 2)}
    writers.write(writers.alignment_lines(rows), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert sorted(text.splitlines()) == sorted((tmp_path / "in.tsv").read_text().splitlines())


def test_genes_and_bedgraph(spark, tmp_path):
    (tmp_path / "g").write_text("chr1\t+\t9\t40\t2\t9,30,\t20,40,\tg(r)\n")
    r = readers.genes(spark, str(tmp_path / "g")).select(S.render(F.col("exons")).alias("s"), "id").first()
    assert (r.s, r.id) == ("10-20, 31-40", "g(r)")
    cov = spark.createDataFrame([("1", 0, 5, 2)], "chr string, start long, end long, cov long")
    writers.write(writers.bedgraph_lines(cov), str(tmp_path / "c"), header="track type=bedGraph")
    assert [tuple(x) for x in readers.bedgraph(spark, str(tmp_path / "c")).collect()] == [("1", 0, 5, 2)]


def test_psl_and_gtf(spark, tmp_path):
    row = "50\t0\t0\t0\t0\t0\t0\t0\t+\tseq.1a\t50\t0\t50\tchr1\t999\t10\t60\t1\t50,\t0,\t10,"
    bad = row.replace("50\t0\t0", "20\t9\t0", 1).replace("\t50,\t0,", "\t20,\t0,")
    (tmp_path / "p").write_text(f"psLayout version 3\n\n{row}\n{bad}\n")
    rows = readers.psl(spark, str(tmp_path / "p"))
    assert rows.count() == 2 and readers.kept_psl(rows, least=35).count() == 1
    info = 'gene_id "g"; transcript_id "t"; gene_name "n";'
    (tmp_path / "x.gtf").write_text(f"#c\nchr1\ts\texon\t31\t40\t.\t+\t.\t{info}\nchr1\ts\texon\t10\t20\t.\t+\t.\t{info}\nchr1\ts\tCDS\t10\t20\t.\t+\t.\t{info}\n")
    r = readers.gtf(spark, str(tmp_path / "x.gtf")).select("id", S.render(F.col("exons")).alias("s")).first()
    assert (r.id, r.s) == ("n_t", "10-20, 31-40")


def test_sam_reader(spark, tmp_path):
    (tmp_path / "s").write_text("@SQ\tSN:1\tLN:9\nseq.1a\t99\t1\t5\t25\t4M\t=\t9\t8\tACGT\t*\tIH:i:1\tHI:i:1\n")
    r = readers.sam(spark, str(tmp_path / "s")).first()
    assert (r.qname, r.flag, r.pos, r.tags) == ("seq.1a", 99, 5, ["IH:i:1", "HI:i:1"])


def test_streaming_coverage(spark, tmp_path):
    data = [("1", 5, 10), ("1", 8, 15), ("2", 1, 3)]
    df = spark.createDataFrame(data, "chr string, start long, end long")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    keep = lambda batch, _: batch.write.mode("overwrite").parquet(str(tmp_path / "changes"))
    q = live.changes(stream).writeStream.foreachBatch(keep).outputMode("complete").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(map(tuple, live.settled(spark.read.parquet(str(tmp_path / "changes"))).select("chr", "start", "end", "cov").collect()))
    assert got == sorted(map(tuple, coverage.sweep(df, ["chr"]).select("chr", "start", "end", "cov").collect()))
