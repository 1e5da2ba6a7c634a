"""Reads of a Type-2 history: now, as of a load time, as of a business date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .cleaning import keep_first
from .ordered import running


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def current(bronze: DataFrame) -> DataFrame:
    """Active versions."""
    return bronze.where("UdmActiveFlag = 1")


def current_defensive(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One active version per key even where several are active: the latest by load time, then surrogate key."""
    order = [F.col("UdmEffectiveDateTime").desc_nulls_last(), F.col("_scd2_key").desc_nulls_last()]
    return keep_first(current(bronze), keys, order)


def as_of_load(bronze: DataFrame, at: str) -> DataFrame:
    """Versions that were loaded by then and not closed yet."""
    end = F.col("UdmEndDateTime")
    return bronze.where((F.col("UdmEffectiveDateTime") <= _ts(at)) & (end.isNull() | (end > _ts(at))))


def as_of_business(bronze: DataFrame, at: str) -> DataFrame:
    """Versions valid at the source on that date; both ends belong to it."""
    return bronze.where((F.col("UdmSourceBeginDate") <= _ts(at)) & (F.col("UdmSourceEndDate") >= _ts(at)))


def history_of(bronze: DataFrame, keys: DataFrame, names: Sequence[str], *, ordered: bool = False) -> DataFrame:
    """All versions of the given keys, if asked in order of key and load time (a range sort, over all tasks)."""
    found = bronze.join(keys.select(*names).distinct(), list(names), "left_semi")
    return found.orderBy(*names, "UdmEffectiveDateTime") if ordered else found


def deleted_since(bronze: DataFrame, since: str) -> DataFrame:
    """Versions closed by a delete at or after then."""
    return bronze.where((F.col("UdmActiveFlag") == 2) & (F.col("UdmEndDateTime") >= _ts(since)))


def deleted_keys(bronze: DataFrame, candidates: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of the candidate keys that have a deleted version."""
    return bronze.where("UdmActiveFlag = 2").select(*names).distinct().join(candidates.select(*names).distinct(), list(names), "left_semi")


def as_of_join(facts: DataFrame, bronze: DataFrame, fact_key: str, key: str, at: str, chunk: str = "month") -> DataFrame:
    """Each fact with the last version of its key that began by its time, if that hasn't ended by then; else nulls.

    Facts and versions are laid in one order and the last version is carried along, in chunks of time
    (see :mod:`ordered`): no pair is formed, however many facts and versions a key has.  Of versions that
    begin at one time the one that ends last counts, an open one first, then any, but always the same.  A fact
    without key or time has no version; the version's columns are named ``v_...``.
    """
    end = F.coalesce(F.col("UdmEndDateTime").cast("timestamp_ntz"), F.lit("9999-12-31").cast("timestamp_ntz"))
    body = F.struct(*[F.col(f"`{c}`").alias(c) for c in bronze.columns])
    fact = F.struct(*[F.col(f"`{c}`").alias(c) for c in facts.columns])
    when = F.col(at).cast("timestamp_ntz")
    f = facts.select(F.col(fact_key).alias("__k"), when.alias("__t"), fact.alias("__f"))
    versions = bronze.select(
        F.col(key).alias("__k"), F.col("UdmEffectiveDateTime").cast("timestamp_ntz").alias("__t"), F.lit(0).alias("__kind"), end.alias("__e"), F.xxhash64(body).alias("__tie"), body.alias("__v")
    )
    both = versions.unionByName(f.withColumn("__kind", F.lit(1)), allowMissingColumns=True)
    order = [F.col(c) for c in ("__t", "__kind", "__e", "__tie")]
    seen = running(both, ["__k"], "__t", order, {"__last": ("rare", F.when(F.col("__kind") == 0, F.struct("__e", "__v")))}, chunk)
    valid = F.col("__t") < F.col("__last.__e")
    out = seen.where("__kind = 1").select("__f.*", F.when(valid, F.col("__last.__v")).alias("__v"))
    alone = f.where(F.col("__k").isNull() | F.col("__t").isNull()).select("__f.*", F.lit(None).cast(versions.schema["__v"].dataType).alias("__v"))
    return out.unionByName(alone).select(*[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"__v.`{c}`").alias(f"v_{c}") for c in bronze.columns])
