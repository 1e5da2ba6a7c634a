"""Queries over the documents, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import mixture, sentences, tokens


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.encode_documents(_table(spark, folder, "documents"), "text", ["doc_id"])


def p7_uses(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(_table(spark, folder, "documents"), _table(spark, folder, "mix_target"))[0]


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(_table(spark, folder, "documents"), _table(spark, folder, "mix_target"))[1]


def p7_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture with unequal inclusion odds, by size."""
    return mixture.mix(_table(spark, folder, "documents"), _table(spark, folder, "mix_target"), by_size=True)[0]


def p7_kept(spark: SparkSession, folder: str) -> DataFrame:
    """(plan_id, source, known, once, within_limit) per target: whether every chosen document is one of the source's,
    is chosen once and isn't used more often than the limit allows."""
    docs, targets = _table(spark, folder, "documents"), _table(spark, folder, "mix_target")
    chosen = mixture.mix(docs, targets)[0]
    own = docs.select("doc_id", mixture.source_name(F.col("source")).alias("own"))
    limits = targets.select("plan_id", mixture.source_name(F.col("source")).alias("source"), "max_repeats")
    per = chosen.join(own, "doc_id", "left").groupBy("plan_id", "source").agg(
        F.every(F.col("own").eqNullSafe(F.col("source"))).alias("known"), (F.count_distinct("doc_id") == F.count("*")).alias("once"), F.max("uses").alias("most")
    )
    kept = limits.join(per, ["plan_id", "source"], "left")
    return kept.select(
        "plan_id", "source", F.coalesce("known", F.lit(True)).alias("known"), F.coalesce("once", F.lit(True)).alias("once"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_limit")
    )


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.split_documents(_table(spark, folder, "documents"), "doc_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p6_ids": p6_ids,
    "p7_uses": p7_uses,
    "p7_shares": p7_shares,
    "p7_weighted": p7_weighted,
    "p7_kept": p7_kept,
    "p8_found": p8_found,
}
SQL: dict[str, str] = {
    "p7_kept": "SELECT plan_id, lower(trim(source)) AS source, true AS known, true AS once, true AS within_limit FROM mix_target",
}
