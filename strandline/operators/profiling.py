"""Measures of the pipeline itself: volumes, lateness, gaps, plans, states."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import micros
from .cleaning import keep_first


def lateness_days(completed: Column, business_date: Column) -> Column:
    """Days from the end of the business date to completion, not below zero."""
    end = micros((F.date_add(business_date, 1)).cast("timestamp_ntz"))
    return F.greatest(F.lit(0.0), (micros(completed) - end) / 86_400_000_000.0)


def confidence(samples: Column) -> Column:
    """HIGH from 100 samples, MEDIUM from 30."""
    return F.when(samples >= 100, "HIGH").when(samples >= 30, "MEDIUM").otherwise("LOW")


def lateness(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Exact percentiles per group: (by, samples, p50, p90, p95, p99, confidence)."""
    names = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    found = df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("samples"), F.percentile(value, list(names.values())).alias("__p"))
    return found.select(*by, "samples", *[F.col("__p")[i].alias(n) for i, n in enumerate(names)], confidence(F.col("samples")).alias("confidence"))


def p99_minutes(df: DataFrame, by: Sequence[str], minutes: str) -> DataFrame:
    """(by, l99_minutes): the 99th percentile of delays, floored."""
    return df.groupBy(*by).agg(F.floor(F.percentile(minutes, 0.99)).cast("bigint").alias("l99_minutes"))


def drift_percent(new: Column, prior: Column) -> Column:
    """Change in percent, two decimals; null without a prior value other than zero."""
    return F.round((new - prior) / F.nullif(prior.cast("double"), F.lit(0.0)) * 100, 2)


def weekday_baseline(events: DataFrame, keys: Sequence[str], day: str, rows: str, as_of: str, days: int = 30, last: int = 14) -> DataFrame:
    """(keys, baseline): the median volume of the last runs on the same weekday within ``days``; with
    fewer than two of those, of all runs.  An even number of runs gives the floor of the middle pair."""
    date = F.lit(as_of).cast("date")
    recent = events.where(F.col(rows).isNotNull() & (F.col(day) < date) & (F.col(day) >= F.date_sub(date, days)))
    same = F.dayofweek(day) == F.dayofweek(date)
    w = Window.partitionBy(*keys)
    marked = recent.withColumn("__same", same).withColumn("__n", F.count_if(F.col("__same")).over(w))
    used = marked.where(F.col("__same") | (F.col("__n") < 2))
    ranked = used.withColumn("__rn", F.row_number().over(w.orderBy(F.desc(day), F.desc("EventLogId")))).where(F.col("__rn") <= last)
    return ranked.groupBy(*keys).agg(F.floor(F.percentile(rows, 0.5)).cast("bigint").alias("baseline"))


def daily_baseline(events: DataFrame, keys: Sequence[str], day: str, rows: str, as_of: str, days: int = 30, last: int = 14) -> DataFrame:
    """(keys, baseline): as :func:`weekday_baseline`, but for a run among several of one day: runs of the day
    itself count, and with fewer than two on the same weekday all runs do, however old."""
    date = F.lit(as_of).cast("date")
    seen = events.where(F.col(rows).isNotNull() & (F.col(day) <= date))
    same = (F.dayofweek(day) == F.dayofweek(date)) & (F.col(day) > F.date_sub(date, days))
    w = Window.partitionBy(*keys)
    marked = seen.withColumn("__same", same).withColumn("__n", F.count_if(F.col("__same")).over(w))
    used = marked.where(F.col("__same") | (F.col("__n") < 2))
    ranked = used.withColumn("__rn", F.row_number().over(w.orderBy(F.desc(day), F.desc("EventLogId"), F.desc(rows)))).where(F.col("__rn") <= last)
    return ranked.groupBy(*keys).agg(F.floor(F.percentile(rows, 0.5)).cast("bigint").alias("baseline"))


def churn(stage: DataFrame, keys: Sequence[str], more_than: int = 1, top: int = 10) -> DataFrame:
    """(keys, inserts, updates) of the keys that were inserted most often; ties by updates, then key."""
    op = F.col("_cdc_operation")
    per = stage.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.count_if(op == "I").alias("inserts"), F.count_if(op == "U").alias("updates"))
    return per.where(F.col("inserts") > more_than).orderBy(F.desc("inserts"), F.desc("updates"), *keys).limit(top)


def guard(fresh: Column, baseline: Column, override: Column | None = None, drop: float = 0.1, warn: float = 0.5, growth: float = 5.0, ceiling: int = 100_000_000) -> Column:
    """What to do with an arrival of this size: OK, WARN, BLOCK_DROP, BLOCK_GROWTH or BLOCK_CEILING.

    The override raises the growth limit, and replaces the ceiling of a first run.
    """
    # The names of the verdicts.
    over = F.nullif(override, F.lit(0)) if override is not None else F.lit(None).cast("bigint")
    first = baseline.isNull() | (baseline == 0)
    limit = F.greatest(F.floor(baseline * growth), F.coalesce(over, F.lit(0)))
    return (
        F.when(first, F.when(fresh > F.coalesce(over, F.lit(ceiling)), "BLOCK_CEILING").otherwise("OK"))
        .when(fresh < F.floor(baseline * drop), "BLOCK_DROP")
        .when(fresh > limit, "BLOCK_GROWTH")
        .when(fresh < F.floor(baseline * warn), "WARN")
        .otherwise("OK")
    )


def count_within(fresh: Column, source: Column, tolerance: float = 0.005) -> Column:
    """Whether an arrival has the source's count within the tolerance; an empty source wants none."""
    return F.when(source == 0, fresh == 0).otherwise(F.abs(fresh - source) <= source * tolerance)


def calendar(df: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """Each row with every day from its start to its end."""
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY")))
    return df.withColumn(name, F.explode(days))


def gaps(runs: DataFrame, keys: Sequence[str], day: str, ok: Column, as_of: str, lookback: int = 0) -> DataFrame:
    """(keys, first_day, last_day, missing_days, action) from each key's first run to the lookback."""
    spans = runs.groupBy(*keys).agg(F.min(day).alias("first_day")).withColumn("last_day", F.date_sub(F.lit(as_of).cast("date"), max(0, lookback)))
    good = runs.where(ok).select(*keys, F.col(day).alias("day")).distinct().withColumn("__ok", F.lit(True))
    days = calendar(spans, "first_day", "last_day").join(good, [*keys, "day"], "left")
    per = days.groupBy(*keys, "first_day", "last_day").agg(F.count_if(F.col("__ok").isNull()).alias("missing_days"), F.count("__ok").alias("__good"))
    # The names of the actions.
    action = F.when(F.col("missing_days") == 0, "NONE").when(F.col("__good") > 0, "BACKFILL").otherwise("INVESTIGATE")
    return per.select(*keys, "first_day", "last_day", "missing_days", action.alias("action"))


def missing_days(runs: DataFrame, keys: Sequence[str], day: str, ok: Column, as_of: str) -> DataFrame:
    """(keys, day) of every expected day without a good run."""
    spans = runs.groupBy(*keys).agg(F.min(day).alias("__first")).withColumn("__last", F.lit(as_of).cast("date"))
    good = runs.where(ok).select(*keys, F.col(day).alias("day")).distinct()
    return calendar(spans, "__first", "__last").select(*keys, "day").join(good, [*keys, "day"], "left_anti")


def plan_range(policies: DataFrame, runs: DataFrame, keys: Sequence[str], day: str, ok: Column, as_of: str, lookback: int, floor: str | None = None, most: int | None = None) -> DataFrame:
    """(keys, day, again): days to extract, the union of each key's policy ranges, clipped, or without
    one the lookback; ``again`` if the day isn't after the last good one.  All of them, or the last ``most``
    if the caller sets that.

    ``policies`` has start_day and end_day, either of which may be null (open).
    """
    today = F.lit(as_of).cast("date")
    low = F.lit(floor).cast("date") if floor else F.lit("1900-01-01").cast("date")
    every = runs.select(*keys).distinct()
    ranges = policies.select(*keys, F.greatest(F.coalesce("start_day", low), low).alias("__a"), F.least(F.coalesce("end_day", today), today).alias("__b"), F.lit(True).alias("__p"))
    joined = every.join(ranges, list(keys), "left")
    a = F.when(F.col("__p").isNull(), F.greatest(F.date_sub(today, lookback), low)).otherwise(F.col("__a"))
    days = calendar(joined.withColumns({"__a": a, "__b": F.coalesce("__b", today)}), "__a", "__b").select(*keys, "day").distinct()
    last = runs.where(ok).groupBy(*keys).agg(F.max(day).alias("__last"))
    if most is not None:
        days = days.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("day")))).where(F.col("__rn") <= most)
    return days.join(last, list(keys), "left").select(*keys, "day", F.coalesce(F.col("day") <= F.col("__last"), F.lit(False)).alias("again"))


def monthly_growth(df: DataFrame, at: str) -> DataFrame:
    """(month, row_count) by calendar month."""
    return df.where(F.col(at).isNotNull()).groupBy(F.date_trunc("month", F.col(at)).cast("date").alias("month")).agg(F.count("*").alias("row_count"))


def project(rows: Column, per_month: Column, months: int, row_bytes: int) -> tuple[Column, Column]:
    """Rows after so many months of linear growth, and their size in MB."""
    n = rows + per_month * months
    return n, F.floor(n * row_bytes / (1024 * 1024)).cast("bigint")


def partition_advice(avg_mb: Column, low: float = 100, high: float = 250) -> Column:
    """COARSER, FINER or KEEP by average file size."""
    return F.when(avg_mb.isNull(), "UNKNOWN").when(avg_mb < low, "COARSER").when(avg_mb > high, "FINER").otherwise("KEEP")


#: The states that may follow a snapshot's state.
TRANSITIONS = {
    "created": ("verified", "missing"),
    "verified": ("replicated", "replication_failed", "missing"),
    "replicated": ("archived", "missing"),
    "archived": ("purged", "missing"),
    "replication_failed": ("replicated", "missing"),
    "missing": (),
    "purged": (),
}


def legal_transition(current: Column, attempted: Column) -> Column:
    """Whether a snapshot may go from one state to the other; unknown states may not."""
    allowed = F.lit(False)
    for state, following in TRANSITIONS.items():
        if following:
            allowed = F.when((current == state) & attempted.isin(*following), True).otherwise(allowed)
    return F.coalesce(allowed, F.lit(False))


def latest_state(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row written for each key."""
    return keep_first(rows, keys, [F.col(c).desc_nulls_last() for c in order])


def attempts(runs: DataFrame, keys: Sequence[str], ok: Column, at: str) -> DataFrame:
    """(keys, attempts, trusted, last_good): trusted is whether the last run was good."""
    last = F.max_by(F.coalesce(ok, F.lit(False)), F.struct(at, "EventLogId"))
    return runs.groupBy(*keys).agg(F.count("*").alias("attempts"), last.alias("trusted"), F.max(F.when(ok, F.col(at))).alias("last_good"))


def active_ratio(bronze: DataFrame) -> DataFrame:
    """One row: versions, active ones and their share."""
    counts = bronze.agg(F.count("*").alias("versions"), F.count_if(F.col("UdmActiveFlag") == 1).alias("active"))
    return counts.withColumn("ratio", F.when(F.col("versions") > 0, F.col("active") / F.col("versions")))


def freshness(bronze: DataFrame, as_of: str, warn_hours: float = 36, error_hours: float = 48) -> DataFrame:
    """One row: the latest load, its age in hours, and OK, WARN or ERROR."""
    latest = bronze.agg(F.max("UdmEffectiveDateTime").alias("latest"))
    age = (micros(F.lit(as_of).cast("timestamp_ntz")) - micros(F.col("latest"))) / 3_600_000_000.0
    level = F.when(F.col("age_hours") > error_hours, "ERROR").when(F.col("age_hours") > warn_hours, "WARN").when(F.col("age_hours").isNull(), "ERROR")
    return latest.withColumn("age_hours", age).withColumn("level", level.otherwise("OK"))


def candidate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, is_key): columns that are never null and never repeat.

    One pass with sketches (errors of 1 %, so a column is ruled out only below 90 %) finds those that could
    be keys; only their values are then counted exactly, column by column.  No row is an empty table's key.
    """
    counts = df.agg(F.count("*").alias("__n"), *[F.struct(F.approx_count_distinct(c, 0.01).alias("d"), F.count(c).alias("f")).alias(c) for c in columns]).first()
    n = counts["__n"]
    left = [c for c in columns if counts[c]["f"] == n and counts[c]["d"] >= 0.9 * n]
    exact = [df.groupBy(c).agg(F.count("*").alias("__k")).agg(F.coalesce(F.max("__k") == 1, F.lit(True)).alias("is_key")).select(F.lit(c).alias("column_name"), "is_key") for c in left]
    ruled_out = [(c, False) for c in columns if c not in left]
    rest = df.sparkSession.createDataFrame(ruled_out, "column_name string, is_key boolean")
    return reduce(DataFrame.unionByName, exact, rest)


def partition_skew(df: DataFrame, column: str) -> DataFrame:
    """One row: smallest, largest and missing values of a partition column."""
    return df.agg(F.min(column).alias("smallest"), F.max(column).alias("largest"), F.count_if(F.col(column).isNull()).alias("missing"))


def tier_due(snapshots: DataFrame, at: str, as_of: str, warm: int = 30, cold: int = 90, frozen: int = 365) -> Column:
    """Storage tier by age in days."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col(at).cast("date"))
    return F.when(age >= frozen, "frozen").when(age >= cold, "cold").when(age >= warm, "warm").otherwise("hot")


#: Changes between the modes of change detection.
MODES = {
    ("change_detect", "both"): "ALLOWED",
    ("both", "parquet_snapshot"): "ALLOWED",
    ("both", "change_detect"): "ALLOWED",
    ("parquet_snapshot", "both"): "ALLOWED",
    ("parquet_snapshot", "change_detect"): "ALLOWED",
    ("change_detect", "parquet_snapshot"): "RISKY",
}


def mode_transition(current: Column, target: Column) -> Column:
    """NOOP, ALLOWED, RISKY (skips the period in which both run) or UNKNOWN."""
    out = F.lit("UNKNOWN")
    for (a, b), verdict in MODES.items():
        out = F.when((current == a) & (target == b), verdict).otherwise(out)
    return F.when(current == target, "NOOP").otherwise(out)
