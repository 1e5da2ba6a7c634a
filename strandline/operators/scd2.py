"""Type-2 history kept from one arrival to the next.

``apply`` is a function from the stored history and the current rows to the new history; nothing is
updated in place.  Flags: 1 active, 0 replaced, 2 deleted at the source.  Load times are open (null)
while a version is active; business times end at 2999-12-31, and a replaced version ends the day
before its successor begins, even if that is before its own begin.  An empty arrival deletes nothing:
it is taken for a failed extract unless the caller says that the source may be empty.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..plans.storage import new_path
from .cleaning import keep_first
from .ordered import running

SENTINEL = "2999-12-31 00:00:00"
META = ["UdmHash", "UdmEffectiveDateTime", "UdmEndDateTime", "UdmSourceBeginDate", "UdmSourceEndDate", "UdmActiveFlag", "UdmScd2Operation"]


def _ts(text: str | None) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def source_begin(df: DataFrame, columns: Sequence[str], default: str | None, batch: str) -> Column:
    """The first filled of the columns, else the default, else the batch's time, cut to milliseconds."""
    tries = [F.col(c).try_cast("timestamp_ntz") for c in columns if c in df.columns]
    return F.date_trunc("MILLISECOND", F.coalesce(*tries, _ts(default), _ts(batch)).cast("timestamp")).cast("timestamp_ntz")


def active(bronze: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The active version of each key; of several, the latest."""
    return keep_first(bronze.where("UdmActiveFlag = 1"), keys, [F.col("UdmEffectiveDateTime").desc_nulls_last(), F.col("UdmHash").desc_nulls_last()])


def in_flight() -> Column:
    """A version that was written but never made active."""
    return (
        (F.col("UdmActiveFlag") == 0)
        & F.col("UdmScd2Operation").isin("U", "R")
        & F.col("UdmEndDateTime").isNull()
        & F.col("UdmSourceEndDate").isNull()
    )


def drop_in_flight(bronze: DataFrame) -> DataFrame:
    """History without versions that were never made active."""
    return bronze.where(~F.coalesce(in_flight(), F.lit(False)))


#: Parts in which new surrogate keys are counted; one task numbers the rows of some of them.
PARTS = 4096


def add_surrogate(rows: DataFrame, keys: Sequence[str], after: int = 0, name: str = "_scd2_key") -> DataFrame:
    """``rows`` numbered from ``after`` + 1 without gaps, the same whenever it is done again.

    Rows are counted in parts by key hash; the parts' counts give each part its first number, so no task
    orders more than its parts.  Rows of one key and load time are ordered by their other columns' hash.
    """
    rest = [F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])]
    order = [*keys, *(["UdmEffectiveDateTime"] if "UdmEffectiveDateTime" in rows.columns else []), *rest]
    parts = rows.withColumn("__part", F.pmod(F.xxhash64(*keys), F.lit(PARTS)))
    # One row per part, 4,096 at most.
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.groupBy("__part").agg(F.count("*").alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    numbered = parts.withColumn("__place", place).join(F.broadcast(first), "__part")
    return numbered.withColumn(name, (F.col("__first") + F.col("__place") + after).cast("bigint")).drop("__part", "__place", "__first")


def verified(gone: DataFrame, verifier: Callable[[DataFrame], DataFrame | None] | None, strict: bool = True) -> DataFrame:
    """The keys to close as deleted: those that the verifier returns, all if it returns None.

    If it fails, ``strict`` closes none; otherwise the failure is ignored and all are closed.
    """
    if verifier is None:
        return gone
    try:
        found = verifier(gone)
    except Exception:
        return gone.limit(0) if strict else gone
    return gone if found is None else found.select(*gone.columns)


def apply(
    bronze: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    begin: Column | None = None,
    deleted: DataFrame | None = None,
    hash_column: str = "_row_hash",
    may_be_empty: bool = False,
    verifier: Callable[[DataFrame], DataFrame | None] | None = None,
    strict: bool = True,
    surrogate: str | None = None,
) -> DataFrame:
    """The history after an arrival.

    ``current`` has the whole of what the source holds now, with its hash; keys that it lacks are
    deleted.  If ``deleted`` is given, ``current`` is only a part (a window), and exactly the keys in
    ``deleted`` are deleted; they are closed even if ``current`` is empty.  A key that is new now but
    has a deleted version comes back with operation R.  ``verifier`` and ``strict`` are those of
    :func:`verified`, over the active keys about to be deleted.  ``surrogate`` names the column in which
    new versions are numbered after the highest number so far.
    """
    if deleted is None and not may_be_empty and current.isEmpty():
        return drop_in_flight(bronze)
    when = _ts(at)
    begin = begin if begin is not None else when
    columns = [c for c in current.columns if not c.startswith("_")]
    values = [c for c in columns if c not in keys]
    clean = drop_in_flight(bronze)
    fresh = current.select(
        *keys, F.struct(*[F.col(c) for c in values], begin.alias("__begin")).alias("__row"), F.col(hash_column).alias("__fh"), F.lit(True).alias("__f")
    )
    known = clean.groupBy(*keys).agg(
        F.max(F.when(F.col("UdmActiveFlag") == 1, F.struct("UdmEffectiveDateTime", "UdmHash"))).alias("__a"),
        F.max(F.col("UdmActiveFlag") == 2).alias("__was_deleted"),
    )
    joined = known.join(fresh, list(keys), "full")
    if deleted is not None:
        joined = joined.join(deleted.select(*keys).distinct().withColumn("__d", F.lit(True)), list(keys), "left")
        gone = F.col("__d") & F.col("__f").isNull()
    else:
        gone = F.col("__f").isNull()
    is_active = F.col("__a").isNotNull()
    changed = F.coalesce(F.col("__a.UdmHash") != F.col("__fh"), F.lit(True))
    op = (
        F.when(F.col("__f").isNotNull() & ~is_active, F.when(F.col("__was_deleted"), "R").otherwise("I"))
        .when(F.col("__f").isNotNull() & changed, "U")
        .when(is_active & gone, "D")
    )
    plan = joined.withColumn("__op", op).where("__op IS NOT NULL")
    if verifier:
        closing = verified(plan.where("__op = 'D'").select(*keys), verifier, strict).distinct().withColumn("__ok", F.lit(True))
        plan = plan.join(closing, list(keys), "left").where("__op <> 'D' OR __ok").drop("__ok")
    ends = plan.where("__op IN ('U', 'D')").select(*keys, F.col("__op").alias("__close"), F.col("__row.__begin").alias("__next"))
    closing = F.col("__close").isNotNull() & (F.col("UdmActiveFlag") == 1)
    kept = clean.join(ends, list(keys), "left").withColumns(
        {
            "UdmEndDateTime": F.when(closing, when).otherwise(F.col("UdmEndDateTime")),
            "UdmSourceEndDate": F.when(closing & (F.col("__close") == "U"), F.col("__next") - F.expr("INTERVAL 1 DAY"))
            .when(closing, when)
            .otherwise(F.col("UdmSourceEndDate")),
            "UdmActiveFlag": F.when(closing, F.when(F.col("__close") == "D", 2).otherwise(0)).otherwise(F.col("UdmActiveFlag")).cast("tinyint"),
        }
    ).drop("__close", "__next")
    new = plan.where("__op IN ('I', 'U', 'R')").select(
        *keys,
        *[F.col(f"__row.{c}").alias(c) for c in values],
        F.col("__fh").alias("UdmHash"),
        when.alias("UdmEffectiveDateTime"),
        F.lit(None).cast("timestamp_ntz").alias("UdmEndDateTime"),
        F.col("__row.__begin").alias("UdmSourceBeginDate"),
        _ts(SENTINEL).alias("UdmSourceEndDate"),
        F.lit(1).cast("tinyint").alias("UdmActiveFlag"),
        F.col("__op").alias("UdmScd2Operation"),
    )
    if surrogate:
        highest = bronze.agg(F.max(surrogate).alias("m")).first()["m"] if surrogate in bronze.columns else None
        new = add_surrogate(new, keys, highest or 0, surrogate)
    return kept.unionByName(new, allowMissingColumns=True)


def first_load(
    current: DataFrame, keys: Sequence[str], at: str, *, begin: Column | None = None, hash_column: str = "_row_hash", surrogate: str | None = None
) -> DataFrame:
    """The history of a first arrival: every row an insert, numbered in the column ``surrogate`` if that is given."""
    when = _ts(at)
    columns = [c for c in current.columns if not c.startswith("_")]
    first = current.select(
        *columns,
        F.col(hash_column).alias("UdmHash"),
        when.alias("UdmEffectiveDateTime"),
        F.lit(None).cast("timestamp_ntz").alias("UdmEndDateTime"),
        (begin if begin is not None else when).alias("UdmSourceBeginDate"),
        _ts(SENTINEL).alias("UdmSourceEndDate"),
        F.lit(1).cast("tinyint").alias("UdmActiveFlag"),
        F.lit("I").alias("UdmScd2Operation"),
    )
    return add_surrogate(first, keys, 0, surrogate) if surrogate else first


class HistoryStore:
    """A history in buckets of keys, of which an arrival rewrites only those that hold its keys.

    ``buckets`` is fixed when the store is made; choose it so that a bucket is a few hundred MB.  A
    bucket's rows lie in a folder of their own and are replaced by pointing to a new one, so readers of
    the old version aren't disturbed.
    """

    def __init__(self, spark: SparkSession, keys: Sequence[str], buckets: int = 64, paths: dict[int, str] | None = None, schema: T.StructType | None = None) -> None:
        self.spark, self.keys, self.buckets, self.paths, self.schema = spark, list(keys), buckets, dict(paths or {}), schema

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, some: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of some buckets, or of all; None if nothing was ever written."""
        paths = [p for b, p in sorted(self.paths.items()) if some is None or b in some]
        if self.schema is None:
            return None
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame) -> HistoryStore:
        """The store with these rows in place of those in their buckets."""
        root = new_path(self.spark, "history")
        placed = rows.withColumn("__bucket", self._bucket())
        placed.hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(root)
        written = self.spark.read.schema(placed.schema).parquet(root).select("__bucket").distinct().collect()
        new = {r["__bucket"]: f"{root}/__bucket={r['__bucket']}" for r in written}
        return HistoryStore(self.spark, self.keys, self.buckets, self.paths | new, rows.schema)

    def apply_targeted(self, part: DataFrame, deleted: DataFrame, at: str, **how: object) -> HistoryStore:
        """The store after :func:`apply` of a part of the source and the keys that are gone from it."""
        touched = part.select(*self.keys).unionByName(deleted.select(*self.keys)).select(self._bucket().alias("b")).distinct()
        # At most as many numbers as there are buckets.
        here = [r["b"] for r in touched.collect()]
        old = self.read(here)
        if old is None:
            fresh = first_load(part, self.keys, at, **{k: v for k, v in how.items() if k in ("begin", "hash_column", "surrogate")})
            return self.write(fresh)
        return self.write(apply(old, part, self.keys, at, deleted=deleted, **how))


def from_states(states: DataFrame, keys: Sequence[str], at: str, hash_column: str, chunk: str = "month") -> DataFrame:
    """Versions of many states at once: (keys, hash, begin, end, active), end null while open.

    A key's states are compared in chunks of time, see :mod:`ordered`, so no task sorts a whole hot key.
    """
    one = states.select(*keys, hash_column, at, F.struct(F.col(hash_column).alias("h")).alias("__s"))
    seen = running(one, keys, at, [F.col(at)], {"__before": ("last", F.col("__s"))}, chunk)
    change = F.col("__before").isNull() | F.coalesce(F.col(hash_column) != F.col("__before.h"), F.lit(True))
    points = seen.where(change).select(*keys, hash_column, at)
    ends = running(points, keys, at, [F.col(at)], {"end": ("last", F.col(at))}, chunk, backwards=True)
    return ends.select(*keys, hash_column, F.col(at).alias("begin"), "end", F.col("end").isNull().cast("int").alias("active"))


def retention(bronze: DataFrame, candidates: DataFrame, keys: Sequence[str], as_of: str, days: int) -> DataFrame:
    """Ages of the active versions about to be deleted: within, exceeds, unknown, min_age, max_age.

    The age counts from the business begin to ``as_of``.
    """
    rows = bronze.where("UdmActiveFlag = 1").join(candidates.select(*keys).distinct(), list(keys))
    age = F.datediff(F.lit(as_of).cast("date"), F.col("UdmSourceBeginDate").cast("date"))
    return rows.withColumn("age", age).agg(
        F.count_if(F.col("age") <= days).alias("within"),
        F.count_if(F.col("age") > days).alias("exceeds"),
        F.count_if(F.col("age").isNull()).alias("unknown"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
    )


def seed(legacy: DataFrame, begin_columns: Sequence[str] = (), default: str | None = None) -> DataFrame:
    """A legacy history with business times and operations: active I until the sentinel, deleted D and
    replaced U until their load end."""
    tries = [F.col(c).try_cast("timestamp_ntz") for c in begin_columns if c in legacy.columns]
    begin = F.coalesce(*tries, F.col("UdmEffectiveDateTime").cast("timestamp_ntz"), _ts(default or "1900-01-01 00:00:00"))
    flag = F.col("UdmActiveFlag")
    return legacy.withColumns(
        {
            "UdmSourceBeginDate": begin,
            "UdmSourceEndDate": F.when(flag == 1, _ts(SENTINEL)).otherwise(F.col("UdmEndDateTime").cast("timestamp_ntz")),
            "UdmScd2Operation": F.when(flag == 1, "I").when(flag == 2, "D").otherwise("U"),
            "UdmModifiedBy": F.lit("legacy_seed"),
        }
    )
