"""Layers and copies held against each other by joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.values import canonical, field_types, same
from .cleaning import one_row
from .integrity import key_checks, latest_per_key
from .scd2 import in_flight


def columns_compare(source: DataFrame, stage: DataFrame, keys: Sequence[str], columns: Sequence[str], *, by_value: bool = False) -> DataFrame:
    """(column_name, mismatches): null-safe, column by column, and 'any column', over common keys.

    With ``by_value`` strings are equal without regard to composition and trailing spaces, and doubles if
    they are closer than a millionth, as in :mod:`strandline.functions.values`.
    """
    kinds = field_types(source, columns)
    if by_value:
        source, stage = canonical(source, columns), canonical(stage, columns)
    s = source.select(*keys, F.struct(*columns).alias("__s"))
    t = stage.select(*keys, F.struct(*columns).alias("__t"))
    differs = {c: ~(same(F.col(f"__s.{c}"), F.col(f"__t.{c}"), kinds[c]) if by_value else F.col(f"__s.{c}").eqNullSafe(F.col(f"__t.{c}"))) for c in columns}
    counts = s.join(t, list(keys)).agg(
        *[F.count_if(d).alias(c) for c, d in differs.items()], F.count_if(reduce(lambda a, b: a | b, differs.values())).alias("any column")
    )
    return counts.unpivot([], [*columns, "any column"], "column_name", "mismatches")


def columns_compare_in(
    source: DataFrame, stage: DataFrame, keys: Sequence[str], columns: Sequence[str], at: str, start: str, end: str, *, by_value: bool = True
) -> DataFrame:
    """As :func:`columns_compare`, for rows whose date lies in the half-open window on their own side; a row
    that is outside on the other side isn't compared."""

    def inside(df: DataFrame) -> DataFrame:
        return df.where((F.col(at) >= F.lit(start).cast("date")) & (F.col(at) < F.lit(end).cast("date")))

    return columns_compare(inside(source), inside(stage), keys, columns, by_value=by_value)


def sample_n(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """n rows, the same wherever they are taken: those whose keys' digests are smallest.  Ties go by key."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    return df.withColumn("__d", digest).orderBy("__d", *keys).limit(n).drop("__d")


def sample_by_key(df: DataFrame, keys: Sequence[str], one_in: int) -> DataFrame:
    """The same share of keys wherever it is taken, so two samples can be compared."""
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(one_in)) == 0)


def ghost_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], alert_above: float = 0.001) -> DataFrame:
    """One row: keys only in ``b`` (ghosts), only in ``a`` (missing), in both, and whether to alert."""
    x = a.select(*keys).distinct().withColumn("__a", F.lit(True))
    y = b.select(*keys).distinct().withColumn("__b", F.lit(True))
    counts = x.join(y, list(keys), "full").agg(
        F.count_if(F.col("__a").isNull()).alias("ghosts"), F.count_if(F.col("__b").isNull()).alias("missing"), F.count_if(F.col("__a") & F.col("__b")).alias("common")
    )
    return counts.withColumn("alert", F.col("ghosts") > (F.col("ghosts") + F.col("common")) * alert_above)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """(layer, row_count)."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("layer"), "row_count") for n, df in layers.items()])


def count_deltas(layers: dict[str, DataFrame], first: str) -> DataFrame:
    """Counts with their difference from the first layer's; null where either layer is empty."""
    # One row per layer, so one partition holds them all.
    base = F.max(F.when(F.col("layer") == first, F.col("row_count"))).over(Window.partitionBy(F.lit(0)))
    both = (F.col("row_count") > 0) & (F.col("__base") > 0)
    counts = layer_counts(layers).withColumn("__base", base)
    return counts.select("layer", "row_count", F.when(both, F.col("row_count") - F.col("__base")).alias("delta"))


def _numbers(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and not f.name.startswith("_")]


def _stats(df: DataFrame, columns: Sequence[str], kinds: dict[str, object]) -> DataFrame:
    """(column_name, one column per statistic) in one pass over the data."""
    stats = df.agg(*[F.struct(*[fn(F.col(c).cast("double")).alias(k) for k, fn in kinds.items()]).alias(c) for c in columns])
    return stats.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), f"{c}.*") for c in columns])).alias("x")).select("x.*")


def aggregate_reconcile(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, tolerance: float = 0.001, *, extremes: bool = False) -> DataFrame:
    """Count and sum of each number on both sides; a mismatch is another count or a sum off by more
    than the tolerance, relative to the first side's.  With ``extremes`` least and greatest values are
    returned too; they decide nothing."""
    columns = list(columns or _numbers(a))
    kinds = {"n": F.count, "total": F.sum} | ({"least": F.min, "greatest": F.max} if extremes else {})
    x, y = _stats(a, columns, kinds), _stats(b, columns, kinds)
    shown = {"n": "count", "total": "sum"} | ({"least": "min", "greatest": "max"} if extremes else {})
    both = x.select("column_name", *[F.col(k).alias(f"a_{v}") for k, v in shown.items()]).join(y.select("column_name", *[F.col(k).alias(f"b_{v}") for k, v in shown.items()]), "column_name")
    off = F.when(F.col("a_sum") != 0, F.abs(F.col("a_sum") - F.col("b_sum")) / F.abs("a_sum")).otherwise(F.when(F.col("b_sum") == 0, 0.0).otherwise(1.0))
    bad = (F.col("a_count") != F.col("b_count")) | F.coalesce(off > tolerance, F.lit(False))
    return both.withColumn("mismatch", bad)


def distribution_shift(base: DataFrame, now: DataFrame, columns: Sequence[str], limit: float = 2.0) -> DataFrame:
    """(column_name, base_mean, base_std, now_mean, shifted): mean moved by more than ``limit`` deviations."""
    kinds = {"mean": F.avg, "std": F.stddev_samp}
    x, y = _stats(base, columns, kinds), _stats(now, columns, kinds)
    both = x.select("column_name", F.col("mean").alias("base_mean"), F.col("std").alias("base_std")).join(
        y.select("column_name", F.col("mean").alias("now_mean")), "column_name"
    )
    z = F.when(F.col("base_std") > 0, F.abs(F.col("now_mean") - F.col("base_mean")) / F.col("base_std"))
    return both.withColumn("shifted", F.coalesce(z > limit, F.lit(False)))


def null_rates(a: DataFrame, b: DataFrame, columns: Sequence[str], limit: float) -> DataFrame:
    """(column_name, a_rate, b_rate, flagged): null rates that differ by more than the limit."""

    def rates(df: DataFrame, name: str) -> DataFrame:
        return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]).unpivot([], list(columns), "column_name", name)

    both = rates(a, "a_rate").join(rates(b, "b_rate"), "column_name")
    return both.withColumn("flagged", F.coalesce(F.abs(F.col("a_rate") - F.col("b_rate")) > limit, F.lit(False)))


def drift(stage: DataFrame, bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, kind): differences between the current log rows and the active versions, by full join."""
    s = latest_per_key(stage.where("_cdc_is_current = 1"), keys, ["_cdc_valid_from", "_row_hash"]).select(*keys, F.col("_row_hash").alias("__s"), F.lit(True).alias("__ins"))
    b = latest_per_key(bronze.where("UdmActiveFlag = 1"), keys, ["UdmEffectiveDateTime", "UdmHash"]).select(*keys, F.col("UdmHash").alias("__b"), F.lit(True).alias("__inb"))
    kind = F.when(F.col("__inb").isNull(), "stage_only").when(F.col("__ins").isNull(), "bronze_only").when(~F.col("__s").eqNullSafe(F.col("__b")), "hash_mismatch")
    return s.join(b, list(keys), "full").where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).withColumn("kind", kind).where("kind IS NOT NULL").select(*keys, "kind")


def stage_against_bronze(stage: DataFrame, bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: duplicate keys of both, orphans, missing, hash mismatches (one null counts, both don't)."""
    d = drift(stage, bronze, keys).agg(
        F.count_if(F.col("kind") == "bronze_only").alias("orphans"),
        F.count_if(F.col("kind") == "stage_only").alias("missing"),
        F.count_if(F.col("kind") == "hash_mismatch").alias("hash_mismatches"),
    )

    def repeated(df: DataFrame, name: str) -> DataFrame:
        some = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        return some.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias(name))

    s = repeated(stage.where("_cdc_is_current = 1"), "stage_duplicates")
    b = repeated(bronze.where("UdmActiveFlag = 1"), "bronze_duplicates")
    return one_row(d, s, b)


def validate_cdc(stage: DataFrame, bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(check_name, n): one report on a change log and its history: duplicates on both, keys on one side only,
    hashes that differ, keys that are active and deleted at once, and versions that never became active."""
    parts = [stage_against_bronze(stage, bronze, keys), key_checks(bronze, keys).select("active_and_deleted", "zero_active"), bronze.agg(F.count_if(in_flight()).alias("in_flight"))]
    return reduce(DataFrame.unionByName, [p.unpivot([], p.columns, "check_name", "n") for p in parts])


def modified_sweep(source: DataFrame, bronze: DataFrame, keys: Sequence[str], modified: str) -> DataFrame:
    """Keys whose source row is newer than the active version, or that have none."""
    b = latest_per_key(bronze.where("UdmActiveFlag = 1"), keys, ["UdmEffectiveDateTime"]).select(*keys, F.col("UdmSourceBeginDate").alias("__b"))
    return source.join(b, list(keys), "left").where(F.col("__b").isNull() | (F.col(modified) > F.col("__b"))).select(*keys)


VERDICTS = ("CLEAN", "DRIFT", "MAJOR_DRIFT", "FATAL")


def count_verdict(snapshot: Column, bronze: Column, tolerance: float = 0.01, major: float = 0.05) -> Column:
    """Parity of two counts; fewer in the snapshot than in the history is always major."""
    off = F.abs(snapshot - bronze) / snapshot
    return (
        F.when((snapshot == 0) & (bronze == 0), "CLEAN")
        .when((snapshot == 0) | (bronze == 0) | (snapshot < bronze), "MAJOR_DRIFT")
        .when(off <= tolerance, "CLEAN")
        .when(off <= major, "DRIFT")
        .otherwise("MAJOR_DRIFT")
    )


def key_hashes(snapshot: DataFrame, bronze: DataFrame, keys: Sequence[str], a_hash: str, b_hash: str) -> DataFrame:
    """One row: keys missing on either side, and common keys with the same and another hash."""
    x = snapshot.select(*keys, F.col(a_hash).alias("__x"), F.lit(True).alias("__a"))
    y = bronze.select(*keys, F.col(b_hash).alias("__y"), F.lit(True).alias("__b"))
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    same = F.coalesce(F.col("__x") == F.col("__y"), F.lit(False))
    return x.join(y, list(keys), "full").agg(
        F.count_if(F.col("__b").isNull()).alias("missing_from_bronze"),
        F.count_if(F.col("__a").isNull()).alias("missing_from_snapshot"),
        F.count_if(both & same).alias("hash_same"),
        F.count_if(both & ~same).alias("hash_differs"),
    )


def hash_verdict(tolerance: float = 0.01, major: float = 0.05) -> Column:
    """Verdict on the row of :func:`key_hashes`."""
    total = F.col("missing_from_bronze") + F.col("hash_same") + F.col("hash_differs")
    share = (F.col("missing_from_bronze") + F.col("hash_differs")) / total
    return (
        F.when(F.col("missing_from_snapshot") > 0, "MAJOR_DRIFT").when(total == 0, "CLEAN").when(share > major, "MAJOR_DRIFT").when(share > tolerance, "DRIFT").otherwise("CLEAN")
    )


def worst(a: Column, b: Column) -> Column:
    """The more severe of two verdicts; unknown ones are the least severe."""
    order = F.create_map(*[x for i, v in enumerate(VERDICTS) for x in (F.lit(v), F.lit(i + 1))])
    rank = [F.coalesce(F.try_element_at(order, c), F.lit(0)) for c in (a, b)]
    return F.when(rank[0] >= rank[1], a).otherwise(b)


def boundary(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows on both sides of a layer boundary, and target keys that the source lacks."""
    orphans = target.select(*keys).join(source.select(*keys).distinct(), list(keys), "left_anti").agg(F.count("*").alias("orphans"))
    s, t = source.agg(F.count("*").alias("source_rows")), target.agg(F.count("*").alias("target_rows"))
    return one_row(s, t, orphans)
