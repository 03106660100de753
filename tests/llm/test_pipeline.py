"""The pipeline against the brute-force versions of its stages."""

from pyspark.sql import functions as F

import corpus_pipeline
from loomspan.llm import pii, toxicity
from tests.llm.test_llm import brute_contamination, brute_join

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    docs = read("documents")
    kept, tables = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
        tables.append({r.doc_id: r.text for r in kept.collect()})
    texts = {r.doc_id: r.text for r in docs.collect()}

    scores = {r.doc_id: r.predicted for r in toxicity.scored(docs, toxicity.train(docs, read("labels").select("doc_id", "toxic"))).collect()}
    want = {k: t for k, t in texts.items() if not scores[k]}
    assert tables[0] == want
    want = {k: want[k] for k, _, c in brute_join(want.items()) if k == c}
    assert tables[1] == want
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    bad = {r[0] for r in brute_contamination(want.items(), items) if r[-1]}
    want = {k: t for k, t in want.items() if k not in bad}
    assert tables[2] == want and bad
    assert tables[3].keys() == want.keys() and not any(pii.base_spans(t) for t in tables[3].values())
    assert all(tables[3][k] == t for k, t in want.items() if not pii.base_spans(t) and tables[3][k].count("<") == t.count("<"))

    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == want.keys() and max(r.offset + r.length for r in rows) <= 4096


def test_stages_of_odd_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows and names that operators use: every stage keeps rows and columns as stated."""
    long = " ".join(f"word{k}" for k in range(60_000))
    rows = [(1, None, "en"), (2, "", None), (3, "one two three", "en"), (3, "one two three", "en"), (None, "no id here", None), (5, long, "de"), (6, long + " end", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    clash = "n_words n_hit n_items items hits contaminated score predicted held_out spans n_email base_sha256 size slot _row component_id n_chars id g".split()
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("lang")) for c in clash})
    want = sorted(map(str, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = [r for r in out.collect()]
        if name == "ngram_jaccard_join":  # of the two long ones the first stays
            assert sorted(map(str, got)) == sorted(map(str, docs.where("doc_id is null or doc_id <> 6").collect()))
        elif name == "personal_data":
            assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows) and {r.score for r in got} == {"scoreen", "scorede", None}
        else:
            assert sorted(map(str, got)) == want, name
    packed = corpus_pipeline.packed(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in rows} and sum(r.doc_id == 3 for r in packed) == 2
    assert sum(r.doc_id in (1, 2) and r.length == 1 for r in packed) == 2 and sum(r.doc_id == 5 for r in packed) > 10


def test_stages_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.packed(spark, docs, SF).count() == 0
