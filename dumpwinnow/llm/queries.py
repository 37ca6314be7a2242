"""One registered query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.once import once
from . import (
    decontaminate,
    hard_negatives,
    mil,
    oracle,
    periodic_runs,
    ppm,
    quality_rules,
    sentencepiece_nbest,
    sharding,
    simhash,
    substring,
    suffix_dedup,
    superminhash,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece_nbest.shared_vocabulary(spark)
    encoded = sentencepiece_nbest.encode(table(spark, sf_dir, "documents"), vocabulary)
    return sentencepiece_nbest.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        "ids",
        "score",
        "more",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = superminhash.near_duplicates(docs, shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.judged(decontaminate.find_items(docs, items)).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.quality_rules(docs, labels)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_windows(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["high"] - x["low"])
    return rows.select(
        "doc_id",
        "n_words",
        gone.alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mil.quality_scores(docs, labels)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, the words from a on repeat p of them to the end.

    h is the crc32 of the id as text and g = floor(h / 10); chosen are h % 10 = 0, a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)), for n words.
    """
    chosen = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    chosen = chosen.select(
        "doc_id",
        "text",
        F.floor(F.col("h") / 10).alias("g"),
        once(
            F.when(
                F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
            )
        ).alias("ws"),
    )
    chosen = chosen.withColumn("n", F.size("ws")).withColumn("a", F.expr("cast(g % n as int)"))
    chosen = chosen.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    planted = F.expr(
        "array_join(concat(slice(ws, 1, a), slice(flatten(array_repeat("
        "slice(ws, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')"
    )
    return chosen.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    order = "transform(runs, r -> struct(-r.length as l, r.start as start, r.period as period))"
    lines = "transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || char(10))"
    return rows.withColumn("top", F.array_min(F.expr(order))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        (-F.col("top.l")).alias("length"),
        F.col("top.period").alias("period"),
        F.floor(1000 * -F.col("top.l") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.expr(lines), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, anchor=F.col("vec_id") % 50 == 0, label=label)


def op13_pivot_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_sentencepiece_nbest,
        op2_superminhash,
        op3_ppm_scores,
        op4_decontaminate,
        op5_warc_revisits,
        op6_quality_rules,
        op7_suffix_dedup,
        op8_label_propagation,
        op9_substring_dedup,
        op10_attention_mil,
        op11_periodic_runs,
        op12_hard_negatives,
        op13_pivot_simhash,
    )
    return {f.__name__: f for f in found}


def all_oracles() -> dict[str, str]:
    return {
        "op2_superminhash": oracle.NEAR_DUPLICATES,
        "op4_decontaminate": oracle.CONTAMINATION,
        "op5_warc_revisits": oracle.REVISITS,
        "op7_suffix_dedup": oracle.SUFFIXES,
        "op9_substring_dedup": oracle.WINDOWS,
        "op12_hard_negatives": oracle.HARD_NEGATIVES,
    }
