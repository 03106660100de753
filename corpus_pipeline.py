"""A corpus from raw documents to packed sequences, as stages over `documents`.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of
`documents`, but for the last, which returns the packing. run() writes each stage's result to the shared folder
and reads it again, so that a lost executor never repeats more than one stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import decontam, ngram_join, packing, pii, toxicity
from loomspan.llm.store import written


def _aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of work(docs) with docs' columns: all but doc_id and text have other names meanwhile, so none can clash."""
    names = {c: f"_{k}_" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    out = work(docs.withColumnsRenamed(names))
    return out.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among docs, doesn't call toxic.

    Null and empty texts get the bias's score, so they stay where most labels are clean; null doc_ids have no label but are judged;
    rows that repeat a doc_id are judged by their own texts; columns of any other name pass through; an empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels)
    return _aside(docs, lambda rows: toxicity.scored(rows, model).where("predicted = 0"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id.

    Rows that repeat a doc_id are one document and stay or go together; rows without a doc_id stay; null and empty texts have no
    shingles, so each of them stays; columns of any other name pass through; an empty table stays empty."""
    groups = ngram_join.linked(docs).where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(groups, "doc_id", "left_semi")
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark windows.

    Null and empty texts have no words and stay; rows that repeat a doc_id are judged each; null doc_ids make no difference; columns named as
    the operator's pass through as they were; an empty table stays empty."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _aside(docs, lambda rows: decontam.contaminated(rows, benchmark, keep_text=True).where("not contaminated"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with <KIND> in place of personal data; n_chars follows the text.

    No row goes: null texts stay null and keep their n_chars, empty ones stay empty, repeated rows and null doc_ids are treated as any
    other; columns named as the operator's pass through as they were."""
    out = _aside(docs, lambda rows: pii.personal_data(rows, redact=True))
    if "n_chars" not in docs.columns:
        return out
    count = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), count).otherwise(F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their place in training sequences.

    Null and empty texts are one piece of the end id, rows that repeat a doc_id are packed each, a null doc_id stays null; other columns
    are dropped; an empty table gives an empty packing."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", clean_language),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", decontaminated),
    ("personal_data", redacted),
    ("best_fit_packing", packed),
]

#: A trained classifier and a tokenizer decide; tests/llm checks run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
