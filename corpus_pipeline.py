"""A training corpus from raw documents: five stages, each one of the operators of dumpwinnow.llm.

Every stage reads what its predecessor kept.  All but the last return the columns of documents,
whatever these are called; extra columns come along.  All take empty tables and very long texts,
and treat a null text as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpwinnow.llm import decontaminate, quality_rules, sentencepiece_nbest, substring, superminhash
from dumpwinnow.llm.rows import carried_back, keyed
from dumpwinnow.llm.scratch import written


#: Rows of an Arrow batch in the pipeline's session.  Whole texts travel in batches, and Spark's
#: default of 10,000 rows is some 30 MB of them, several times over in each task.
BATCH_ROWS = 1000


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the fixed limits or the boosted trees reject.

    Null, empty and blank texts have too few words and go.  Repeated rows are judged alike, null
    ids like others; without labels of both kinds the fixed limits alone decide.
    """
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality_rules.quality_rules(docs, labels, carry=True)
    return carried_back(judged.where("kept"), docs.schema, "text")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near-duplicates (five words, 0.8).

    Rows that repeat an id with the same text are one document and stay together; texts without
    words link with nothing and stay.  A null id gives way to any other of its group; a group of
    null ids alone stays.
    """
    bound_batches(spark)
    found = superminhash.near_duplicates(docs, shingle=5, percent=80)
    keys = written(found.where("kept").select("key").distinct())
    return carried_back(
        keyed(docs, "doc_id", "text", carry=True).join(keys, "key", "left_semi"), docs.schema, "text"
    )


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut 50-word windows that an earlier document holds; other texts stay as they are.

    Of equal windows the smallest id keeps its own; rows that share an id do not cut each other,
    and null ids come last.  A cut text is its words joined by one space, and n_chars follows.  A
    null text becomes an empty one; no row goes, even if all its words do.
    """
    bound_batches(spark)
    cut = substring.remove_windows(docs, carry=True)
    shorter = cut.withColumn("text", F.when(F.size("removed") > 0, F.col("kept")).otherwise(F.col("text")))
    rows = carried_back(shorter, docs.schema, "text")
    return rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark windows cover at least one word in twenty.

    Texts without words are not contaminated and stay.  Each row is judged by itself, so repeated
    rows fare alike; items without words or with a null text occur nowhere.
    """
    bound_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits, _ = decontaminate.find_hits(docs, items, carry=True)
    found = decontaminate.hit_share(hits)
    return carried_back(found.where("not contaminated"), docs.schema, "text")


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best segmentation of each text and what it decodes to, a row for every row.

    Null and empty texts have no pieces; of paths with equal scores the one whose last pieces are
    longer comes first.
    """
    bound_batches(spark)
    vocabulary = sentencepiece_nbest.shared_vocabulary(spark)
    encoded = sentencepiece_nbest.encode(docs, vocabulary)
    return sentencepiece_nbest.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        "score",
        "more",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", good_documents),
    ("near-duplicates", one_of_each_group),
    ("repeated passages", without_repeated_passages),
    ("decontamination", uncontaminated),
    ("pieces", in_pieces),
]

#: Boosted trees and model files are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
