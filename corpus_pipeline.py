"""The corpus pipeline: five stages, each working on everything the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``.  All but the last return the columns of ``documents``.

1. quality_rules: rejected documents go (rules, the trusted / raw n-gram score, and passages with toxic words).
2. near_duplicates: one document of each class of 5-word shingle similarity >= 0.8 stays (the smallest id).
3. decontamination: documents that hold a benchmark window go.
4. private_data: entities are replaced by surrogates; ``n_chars`` follows the new text.
5. sentencepiece: ids of the remaining texts, with the round trip checked.

Decisions are per doc_id: rows that repeat a doc_id stay or go together, but of rows that repeat doc_id and
text stage 2 leaves one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.llm import decontam, near_dup, pieces, pii, quality
from layerwise.llm.common import keep_rows, materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    trusted, toxic = labels.filter("quality = 1 and toxic = 0").select("doc_id"), labels.filter("toxic = 1").select("doc_id")
    # written first: a filter on the rules would be pushed below the n-grams and run the rules twice
    verdicts = materialise(spark, quality.judge(docs, trusted, toxic=toxic).select("doc_id", "kept"), "pipeline-quality", small=True)
    return keep_rows(docs, verdicts.filter("kept").select("doc_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = near_dup.near_duplicates(docs, num=80, bands=32).filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    kept = materialise(spark, kept, "pipeline-kept", small=True)
    out = keep_rows(docs, kept.select("doc_id"))
    if kept.filter("n > 1").isEmpty():
        return out
    return out.dropDuplicates(["doc_id", "text"])  # rows that repeat a document: one stays


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hit = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return keep_rows(docs, hit.filter("not contaminated").select("doc_id"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.pseudonymise(docs).drop("_pii")
    if "n_chars" not in docs.columns:
        return clean
    n_chars = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", n_chars)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
          ("PII", private_data), ("SentencePiece", sentencepiece)]
ORACLE_SQL = None  # surrogates, n-gram hashes and pieces are not SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
