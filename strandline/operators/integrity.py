"""Checks and repairs of a Type-2 history.  Checks return counts in one row, or the offending keys.

Checks that compare a version with those before it run in chunks of time (see :mod:`ordered`), so a key
with a third of all versions is checked by many tasks.  Versions without key or begin aren't compared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import seconds_between
from .cleaning import keep_first
from .ordered import running
from .scd2 import SENTINEL, in_flight

FLAGS, OPERATIONS = (0, 1, 2), ("I", "U", "R", "D")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def overlapping(bronze: DataFrame, keys: Sequence[str], chunk: str = "month") -> DataFrame:
    """Keys with versions whose load intervals overlap.

    Ends don't precede begins on this axis, so a version overlaps an earlier one exactly if it begins
    before the latest end so far: one order per key instead of a self join.
    """
    end = F.coalesce("UdmEndDateTime", _ts("9999-12-31"))
    rows = bronze.select(*keys, F.col("UdmEffectiveDateTime").alias("__at"), end.alias("__end"))
    seen = running(rows, keys, "__at", [F.col("__at"), F.col("__end")], {"__last": ("max", F.col("__end"))}, chunk)
    return seen.where(F.col("__at") < F.col("__last")).select(*keys).distinct()


def business_overlapping(bronze: DataFrame, keys: Sequence[str], chunk: str = "month") -> DataFrame:
    """Keys with versions whose business intervals overlap; ends may precede begins here.

    Two intervals overlap if each begins before the other ends.  Forward intervals are sorted by begin:
    one overlaps an earlier one if it begins before the largest end so far.  A backward (or empty) one
    overlaps just those forward ones that begin before its end and end after its begin: placed at its
    end among the others' begins, it needs the largest end so far to be after its own begin.  Two
    backward ones never overlap.  Both are one order per key; no pairs are formed.
    """
    rows = bronze.select(*keys, F.col("UdmSourceBeginDate").alias("b"), F.col("UdmSourceEndDate").alias("e")).where("b IS NOT NULL AND e IS NOT NULL")
    forward = F.col("b") < F.col("e")
    placed = rows.withColumns({"at": F.least("b", "e"), "fwd": forward.cast("int")})
    run = running(placed, keys, "at", [F.col("at"), F.col("fwd")], {"reach": ("max", F.when(forward, F.col("e")))}, chunk)
    return run.where(F.col("b") < F.col("reach")).select(*keys).distinct()


def version_gaps(bronze: DataFrame, keys: Sequence[str], above: int = 1, chunk: str = "month") -> DataFrame:
    """(keys, gaps): load-time gaps of more than a second between versions that follow each other."""
    end = F.coalesce("UdmEndDateTime", _ts("9999-12-31"))
    rows = bronze.select(*keys, "UdmEffectiveDateTime", "_scd2_key", end.alias("__end"))
    seen = running(rows, keys, "UdmEffectiveDateTime", [F.col("UdmEffectiveDateTime"), F.col("_scd2_key")], {"__last": ("last", F.col("__end"))}, chunk)
    gap = seconds_between(F.col("__last"), F.col("UdmEffectiveDateTime")) > above
    return seen.where(F.col("__last").isNotNull() & gap).groupBy(*keys).agg(F.count("*").alias("gaps"))


def business_gaps(bronze: DataFrame, keys: Sequence[str], chunk: str = "month") -> DataFrame:
    """(keys, gaps): business gaps of more than a day after an end below the sentinel."""
    rows = bronze.select(*keys, "UdmSourceBeginDate", "_scd2_key", F.struct("UdmSourceEndDate").alias("__end"))
    order = [F.col("UdmSourceBeginDate"), F.col("_scd2_key")]
    seen = running(rows, keys, "UdmSourceBeginDate", order, {"__before": ("last", F.col("__end"))}, chunk).withColumn("__last", F.col("__before.UdmSourceEndDate"))
    gap = F.datediff(F.col("UdmSourceBeginDate").cast("date"), F.col("__last").cast("date")) > 1
    return seen.where((F.col("__last") < _ts(SENTINEL)) & gap).groupBy(*keys).agg(F.count("*").alias("gaps"))


def flag_checks(bronze: DataFrame) -> DataFrame:
    """One row of counts over one scan: sentinel, flag and operation rules."""
    flag, op, end, send = (F.col(c) for c in ("UdmActiveFlag", "UdmScd2Operation", "UdmEndDateTime", "UdmSourceEndDate"))
    return bronze.agg(
        F.count_if((flag == 1) & (send.isNull() | (send != _ts(SENTINEL)))).alias("missing_sentinel"),
        F.count_if((flag == 1) & end.isNotNull()).alias("active_with_end"),
        F.count_if(flag.isNull() | ~flag.isin(*FLAGS)).alias("bad_flag"),
        F.count_if(op.isNull() | ~op.isin(*OPERATIONS)).alias("bad_operation"),
        F.count_if(in_flight()).alias("in_flight"),
        F.count_if((flag == 2) & end.isNull()).alias("deleted_without_end"),
        F.count_if((flag == 2) & (send == _ts(SENTINEL))).alias("deleted_with_sentinel"),
    )


def key_checks(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys without an active or deleted version, with several active ones, with both."""
    flag = F.col("UdmActiveFlag")
    per = bronze.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(
        F.count_if(flag == 1).alias("a"), F.count_if(flag == 2).alias("d")
    )
    return per.agg(
        F.count_if((F.col("a") == 0) & (F.col("d") == 0)).alias("zero_active"),
        F.count_if(F.col("a") > 1).alias("duplicate_active"),
        F.count_if((F.col("a") > 0) & (F.col("d") > 0)).alias("active_and_deleted"),
    )


def integrity(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(check_name, violations) of all twelve checks, and two more on keys."""
    flags = flag_checks(bronze)
    per_key = key_checks(bronze, keys)
    out = flags.unpivot([], flags.columns, "check_name", "violations").unionByName(per_key.unpivot([], per_key.columns, "check_name", "violations"))
    for name, found in (
        ("overlap", overlapping(bronze, keys)),
        ("version_gap", version_gaps(bronze, keys)),
        ("business_overlap", business_overlapping(bronze, keys)),
        ("business_gap", business_gaps(bronze, keys)),
    ):
        out = out.unionByName(found.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations"))
    return out


def samples(bronze: DataFrame, keys: Sequence[str], most: int = 5) -> DataFrame:
    """(check_name, keys): for each of the row checks and interval checks, its first keys that offend, in order of key.

    Each check sorts only the distinct keys that offend, and a limit keeps a few per task.
    """
    flag, op, end, send = (F.col(c) for c in ("UdmActiveFlag", "UdmScd2Operation", "UdmEndDateTime", "UdmSourceEndDate"))
    rows = {
        "missing_sentinel": (flag == 1) & (send.isNull() | (send != _ts(SENTINEL))),
        "active_with_end": (flag == 1) & end.isNotNull(),
        "bad_flag": flag.isNull() | ~flag.isin(*FLAGS),
        "bad_operation": op.isNull() | ~op.isin(*OPERATIONS),
        "in_flight": in_flight(),
        "deleted_without_end": (flag == 2) & end.isNull(),
        "deleted_with_sentinel": (flag == 2) & (send == _ts(SENTINEL)),
    }
    whole = bronze.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    found = {n: whole.where(c).select(*keys).distinct() for n, c in rows.items()}
    found |= {"overlap": overlapping(bronze, keys), "version_gap": version_gaps(bronze, keys), "business_overlap": business_overlapping(bronze, keys), "business_gap": business_gaps(bronze, keys)}
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("check_name"), *keys).orderBy(*keys).limit(most) for n, df in found.items()])


def repair_sentinel(bronze: DataFrame) -> DataFrame:
    """Active versions get the business sentinel where it is missing."""
    fill = (F.col("UdmActiveFlag") == 1) & F.col("UdmSourceEndDate").isNull()
    return bronze.withColumn("UdmSourceEndDate", F.when(fill, _ts(SENTINEL)).otherwise(F.col("UdmSourceEndDate")))


def repair_duplicate_active(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All active versions but the latest are closed when that one began; business end the day before.

    The latest of each key is an aggregate, combined map-side, and is joined back; no key is sorted.
    Null is a key like any other here; of equal load times the highest surrogate key is the latest.
    """
    live = bronze.where("UdmActiveFlag = 1")
    names = [f"__l{i}" for i in range(len(keys))]
    latest = live.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).agg(F.max(F.struct("UdmEffectiveDateTime", "_scd2_key", "UdmSourceBeginDate")).alias("__l"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)])
    ranked = live.join(latest, same).withColumns({"__eff": F.col("__l.UdmEffectiveDateTime"), "__src": F.col("__l.UdmSourceBeginDate")})
    old = ~F.col("_scd2_key").eqNullSafe(F.col("__l._scd2_key"))
    fixed = ranked.withColumns(
        {
            "UdmActiveFlag": F.when(old, 0).otherwise(F.col("UdmActiveFlag")).cast("tinyint"),
            "UdmEndDateTime": F.when(old, F.col("__eff")).otherwise(F.col("UdmEndDateTime")),
            "UdmSourceEndDate": F.when(old, F.col("__src") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("UdmSourceEndDate")),
        }
    ).drop("__l", *names, "__eff", "__src")
    return bronze.where("UdmActiveFlag <> 1 OR UdmActiveFlag IS NULL").unionByName(fixed)


def velocity(bronze: DataFrame, keys: Sequence[str], high: int = 10) -> DataFrame:
    """One row: keys, versions a key has on average and at most, keys with more than ``high``."""
    per = bronze.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count("*").alias("n"))
    return per.agg(
        F.count("*").alias("keys"), F.avg("n").alias("avg_versions"), F.max("n").alias("max_versions"), F.count_if(F.col("n") > high).alias("high_keys")
    )


def version_histogram(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(versions, keys): how many keys have how many versions."""
    per = bronze.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count("*").alias("versions"))
    return per.groupBy("versions").agg(F.count("*").alias("keys"))


def diagnose(stage: DataFrame, bronze: DataFrame, source: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """(keys, verdict) of every key that any of the three knows; ``source`` None: it can't be asked.

    The first rule that holds counts; a key whose source state is unknown is never new nor not found.
    """
    flag = F.col("UdmActiveFlag")
    s = stage.groupBy(*keys).agg(F.count_if(F.col("_cdc_is_current") == 1).alias("__c"), F.max(F.when(F.col("_cdc_is_current") == 1, F.col("_row_hash"))).alias("__sh"))
    b = bronze.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        F.count_if(flag == 1).alias("__a"),
        F.count_if(flag == 2).alias("__d"),
        F.count_if(in_flight()).alias("__i"),
        F.max(F.when(flag == 1, F.col("UdmHash"))).alias("__bh"),
    )
    both = s.join(b, list(keys), "full")
    if source is not None:
        both = both.join(source.select(*keys).distinct().withColumn("__s", F.lit(True)), list(keys), "full")
    known = F.coalesce(F.col("__s"), F.lit(False)) if source is not None else F.lit(None).cast("boolean")
    both = both.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).withColumn("__in", known)
    c, n, a, d, i = (F.coalesce(F.col(x), F.lit(0)) for x in ("__c", "__n", "__a", "__d", "__i"))
    # The names of the verdicts.
    verdict = (
        F.when((c == 1) & (a == 1), F.when(F.col("__sh").eqNullSafe(F.col("__bh")), "HEALTHY_ACTIVE").otherwise("STAGE_BRONZE_HASH_DIVERGE"))
        .when((c == 0) & (d >= 1) & (a == 0), "HEALTHY_DELETED")
        .when(i > 0, "IN_FLIGHT_ORPHAN")
        .when(c > 1, "DUPLICATE_CURRENT_STAGE")
        .when(a > 1, "DUPLICATE_ACTIVE_BRONZE")
        .when((c == 1) & (a == 0) & (d == 0), F.when(n == 0, "STAGE_CURRENT_NO_BRONZE_ROWS").otherwise("STAGE_CURRENT_NO_BRONZE_ACTIVE"))
        .when(
            (c == 0) & (a >= 1),
            F.when(F.col("__in"), "BRONZE_ACTIVE_NO_STAGE_CURRENT_PK_IN_SOURCE").otherwise("BRONZE_ACTIVE_NO_STAGE_CURRENT_PK_NOT_IN_SOURCE"),
        )
        .when((c == 0) & (n == 0) & F.col("__in"), "NEW_PK_NOT_YET_LOADED")
        .when((c == 0) & (n == 0) & ~F.col("__in"), "NOT_FOUND")
        .otherwise("UNKNOWN")
    )
    return both.select(*keys, verdict.alias("verdict"))


def missing_theories(missing: DataFrame, bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, theory): why keys have no active version."""
    flag = F.col("UdmActiveFlag")
    b = bronze.groupBy(*keys).agg(
        F.count_if(flag == 0).alias("__z"), F.count_if(flag == 1).alias("__a"), F.count_if(flag == 2).alias("__d"), F.count_if(in_flight()).alias("__i"), F.count("*").alias("__n")
    )
    z, a, d, i = (F.col(x) for x in ("__z", "__a", "__d", "__i"))
    # The names of the theories.
    theory = (
        F.when(F.col("__n").isNull(), "T3_NEVER_INSERTED")
        .when(i > 0, "T1_IN_FLIGHT_ORPHAN")
        .when((d >= 1) & (z >= 1) & (a == 0), "T5_RESURRECTED_AS_INACTIVE")
        .when((d >= 1) & (a == 0), "T2_DELETED_FROM_SOURCE")
        .when((z >= 1) & (a == 0) & (d == 0), "T4_ALL_CLOSED")
        .otherwise("UNKNOWN")
    )
    return missing.select(*keys).distinct().join(b, list(keys), "left").select(*keys, theory.alias("theory"))


def fk_orphans(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str) -> DataFrame:
    """Facts whose key the dimension doesn't have; facts without a key aren't held against it."""
    dim = dimension.select(F.col(key).alias("__k")).distinct()
    return facts.where(F.col(fact_key).isNotNull()).join(dim, F.col(fact_key) == F.col("__k"), "left_anti")


def versions_at(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, at: str, chunk: str = "month") -> DataFrame:
    """Facts with the number ``__n`` of versions of their key that are valid at their time (begin <= time < end).

    That is the number of begins so far less the number of ends so far, so begins, ends and facts are laid in one
    order and counted along it, in chunks of time: no pair is formed.  An end before its begin counts
    from the begin on.  Facts without key or time have none; an end that is null never comes.
    """
    body = F.struct(*[F.col(f"`{c}`").alias(c) for c in facts.columns])
    begin, end = F.col("UdmEffectiveDateTime").cast("timestamp_ntz"), F.col("UdmEndDateTime").cast("timestamp_ntz")
    f = facts.select(F.col(fact_key).alias("__k"), F.col(at).cast("timestamp_ntz").alias("__t"), F.lit(1).alias("__kind"), F.lit(0).alias("__step"), body.alias("__f"))
    steps = F.array(F.struct(begin.alias("t"), F.lit(1).alias("s")), F.struct(F.when(end.isNotNull(), F.greatest(begin, end)).alias("t"), F.lit(-1).alias("s")))
    d = dimension.where(begin.isNotNull()).select(F.col(key).alias("__k"), F.explode(steps).alias("__x"))
    d = d.groupBy("__k", F.col("__x.t").alias("__t")).agg(F.sum("__x.s").cast("int").alias("__step")).withColumn("__kind", F.lit(0))
    both = f.unionByName(d, allowMissingColumns=True)
    seen = running(both, ["__k"], "__t", [F.col("__t"), F.col("__kind")], {"__n": ("sum", F.col("__step"))}, chunk)
    alone = f.where(F.col("__k").isNull() | F.col("__t").isNull()).select("__f.*", F.lit(0).cast("bigint").alias("__n"))
    return seen.where("__kind = 1").select("__f.*", "__n").unionByName(alone)


def fk_orphans_at(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, at: str) -> DataFrame:
    """Facts without a version of their key at their time; facts without a key aren't held against it."""
    return versions_at(facts.where(F.col(fact_key).isNotNull()), dimension, fact_key, key, at).where("__n = 0").drop("__n")


def fk_ambiguous(facts: DataFrame, dimension: DataFrame, fact_key: str, key: str, at: str, fact_id: str) -> DataFrame:
    """(fact_id, n): facts with more than one version of their key at their time."""
    return versions_at(facts, dimension, fact_key, key, at).where("__n > 1").select(fact_id, F.col("__n").alias("n"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by the order."""
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in order])
