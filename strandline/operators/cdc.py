"""Changes between what is stored and what arrives.

One full outer join on the key classifies everything in a single shuffle.  A key that is only stored
is a delete, one that is only fresh an insert; a changed hash, or one that is null on either side, is
an update.  Keys must be unique and whole; :mod:`cleaning` makes them so.  An empty arrival gives no
deletes: it is taken for a failed extract unless the caller says that the source may be empty.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from .cleaning import add_cdc_columns, keep_first, one_row

HASH = "_row_hash"


def classify(existing: DataFrame, fresh: DataFrame, keys: Sequence[str], hash_column: str = HASH, *, may_be_empty: bool = False) -> DataFrame:
    """(keys, change): I, U, D or S (same); no rows at all if nothing arrived, unless it ``may_be_empty``."""
    if not may_be_empty and fresh.isEmpty():
        existing = existing.limit(0)
    e = existing.select(*keys, F.col(hash_column).alias("__eh"), F.lit(True).alias("__e"))
    f = fresh.select(*keys, F.col(hash_column).alias("__fh"), F.lit(True).alias("__f"))
    changed = F.coalesce(F.col("__eh") != F.col("__fh"), F.lit(True))
    change = F.when(F.col("__e").isNull(), "I").when(F.col("__f").isNull(), "D").when(changed, "U").otherwise("S")
    return e.join(f, list(keys), "full").select(*keys, change.alias("change"))


def change_counts(changes: DataFrame) -> DataFrame:
    """One row: inserts, updates, deletes, unchanged."""
    n = {"inserts": "I", "updates": "U", "deletes": "D", "unchanged": "S"}
    return changes.agg(*[F.count_if(F.col("change") == v).alias(k) for k, v in n.items()])


def counts_hold(changes: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row: rows that arrived, rows classified as inserted, updated or unchanged, and whether they agree."""
    n = one_row(fresh.agg(F.count("*").alias("arrived")), changes.agg(F.count_if(F.col("change") != "D").alias("classified")))
    return n.withColumn("holds", F.col("arrived") == F.col("classified"))


def classify_window(
    existing: DataFrame, fresh: DataFrame, keys: Sequence[str], date_column: str, start: str, end: str, hash_column: str = HASH, *, may_be_empty: bool = False
) -> DataFrame:
    """As :func:`classify`, inside the half-open window only: stored rows outside are never deletes."""

    def inside(df: DataFrame) -> DataFrame:
        return df.where((F.col(date_column) >= F.lit(start).cast("timestamp_ntz")) & (F.col(date_column) < F.lit(end).cast("timestamp_ntz")))

    return classify(inside(existing), inside(fresh), keys, hash_column, may_be_empty=may_be_empty)


def verify_deletes(
    changes: DataFrame, source_keys: DataFrame | None, keys: Sequence[str], *, windowed: bool = False, limit: int = 0, strict: bool = False
) -> DataFrame:
    """``changes`` without deletes of keys that the source still has.

    Windows aren't verified, nor, where a ``limit`` above 0 is given, more deletes than that; if ``strict``, unverified deletes are
    dropped instead of let through.  ``source_keys`` is None where the source can't be asked.
    """
    dropped = changes.where("change <> 'D'") if strict else changes
    if windowed:
        return changes
    if source_keys is None:
        return dropped
    deletes = changes.where("change = 'D'")
    if limit and deletes.limit(limit + 1).count() > limit:
        return dropped
    gone = deletes.join(source_keys.select(*keys).distinct(), list(keys), "left_anti")
    return changes.where("change <> 'D'").unionByName(gone)


def split_deletes(changes: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, still_there) of every delete: whether the source still has the key."""
    there = source_keys.select(*keys).distinct().withColumn("__t", F.lit(True))
    return changes.where("change = 'D'").join(there, list(keys), "left").select(*keys, F.col("__t").isNotNull().alias("still_there"))


def stage_current(stage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The current row of each key; of several, the latest by time, batch and hash."""
    order = [F.col("_cdc_valid_from").desc_nulls_last(), F.col("_cdc_batch_id").desc_nulls_last(), F.col(HASH).desc_nulls_last()]
    return keep_first(stage.where("_cdc_is_current = 1"), keys, order)


def apply_to_stage(
    stage: DataFrame, fresh: DataFrame, keys: Sequence[str], at: str, batch_id: int, verify: Callable[[DataFrame], DataFrame] | None = None, *, may_be_empty: bool = False
) -> DataFrame:
    """The change log after an arrival: new and changed rows are appended, what they replace and what
    is gone is expired.  A removed key leaves no row of its own; a key that comes back is an insert."""
    changes = classify(stage_current(stage, keys), fresh, keys, may_be_empty=may_be_empty)
    if verify:
        changes = verify(changes)
    ending = changes.where("change IN ('U', 'D')").select(*keys, F.lit(True).alias("__end"))
    when = F.lit(at).cast("timestamp_ntz")
    expire = F.col("__end") & (F.col("_cdc_is_current") == 1) & (F.col("_cdc_valid_from") < when)
    kept = stage.join(ending, list(keys), "left").withColumns(
        {
            "_cdc_valid_to": F.when(expire, when).otherwise(F.col("_cdc_valid_to")),
            "_cdc_is_current": F.when(expire, F.lit(0)).otherwise(F.col("_cdc_is_current")).cast("tinyint"),
        }
    ).drop("__end")
    new = fresh.join(changes.where("change IN ('I', 'U')"), list(keys))
    rows = add_cdc_columns(new, F.col("change"), at, batch_id).drop("change")
    return kept.unionByName(rows, allowMissingColumns=True)


def append_only(fresh: DataFrame, at: str, batch_id: int) -> DataFrame:
    """Rows of a table without key: each is appended with operation A."""
    return add_cdc_columns(fresh, "A", at, batch_id)


def snapshot_deletes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the earlier snapshot that the later one lacks; none if the later one is empty."""
    found = before.select(*keys).distinct().join(after.select(*keys), list(keys), "left_anti")
    return found.limit(0) if after.isEmpty() else found


def phantom_updates(counts: DataFrame, ratio: float = 0.5, least: int = 1000) -> DataFrame:
    """``counts`` with update_ratio and alarm: too many updates at once point at the hash, not the data."""
    seen = F.col("inserts") + F.col("updates") + F.col("unchanged")
    r = F.when(seen > 0, F.col("updates") / seen).otherwise(0.0)
    return counts.withColumn("update_ratio", r).withColumn("alarm", (F.col("update_ratio") > ratio) & (F.col("updates") > least))


def purge_expired(stage: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """The change log without rows that expired more than ``days`` before."""
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return stage.where(~F.coalesce((F.col("_cdc_is_current") == 0) & (F.col("_cdc_valid_to") < limit), F.lit(False)))
