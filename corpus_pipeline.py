"""From documents to packed training sequences: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. The first four
return the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import jaccard_join, mixing, packing, suffix_dedup, toxicity
from pulsegrid.llm.common import new_folder, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field tagger does not reject; it learns from the labels of ``sf_dir``.

    Null and empty texts have no toxic token and stay; repeated rows and rows without an id are
    judged row by row; without labels, or an empty table, nothing is rejected."""
    model = toxicity.learn(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return jaccard_join.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of fifty bytes or more that an earlier document has."""
    return suffix_dedup.without_repeats(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    Null and empty texts have no words and are never taken; a null source is a source of its own;
    repeated rows and rows without an id are documents like any others; an empty table stays empty."""
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    return mixing.repeated(mixing.mix(mixing.with_size(rows))).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    Null and empty texts are documents of one id; repeated rows are packed each time; an empty table
    gives no rows."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("mixing", mixed_to_weights),
    ("packing", packed),
]

# learned decisions and hashed sets are not SQL; tests/llm compares the rows with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
