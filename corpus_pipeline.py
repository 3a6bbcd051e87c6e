"""A training corpus from ``documents``: each stage reads what the one before kept.

Near-duplicates are found among rows, so ids may repeat or be null there; a passage is compared with documents of smaller
ids, so rows of one id or without an id keep theirs.  The stages cast nothing away but what they are there to reject.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import jaccard, outliers, packing, quality, substrings
from recspark.llm.queries import WORDS
from recspark.operators.durable import scratch_path, stored

# Near-duplicates of the pipeline: five words, similarity 0.8 or more.
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
# At this similarity parts hold few shingles; more spare ones let documents drop the keys of common passages.
SPARE_SHARE = 0.5


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose score reaches the classifier's threshold."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(model.score("text") >= quality.THRESHOLD)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base rule and are no outliers of their language and source."""
    return outliers.keep_regular(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of every group of near-duplicates; a null id is the largest."""
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")  # written, so numbers stay with their rows
    found = jaccard.jaccard_components(rows, key="__row", n=SHINGLE_WORDS, percent=SIMILARITY_PERCENT, spare_share=SPARE_SHARE)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    first = (found.select("__row", "component_id").join(rows.select("__row", "doc_id"), "__row")
             .groupBy("component_id").agg(F.min(order).getField("__row").alias("__row")))
    return rows.join(first, "__row", "left_semi").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in a document with a smaller id; every document stays."""
    found = substrings.remove_repeats(docs, keep=("lang", "source"))
    return found.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path(WORDS)))


STAGES = [("quality classifier", classify_quality), ("quality rules", apply_rules), ("n-gram Jaccard join", drop_near_duplicates),
          ("substring dedup", drop_repeats), ("best-fit packing", pack)]

# The classifier is trained and the rules iterate: SQL cannot express them.  Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            path = scratch_path(spark, f"stage{place}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
