"""What changed between full snapshots, for any number of snapshots in one pass.

The snapshots are numbered in order.  Each key's rows are windowed by that number: the hash of the
row before tells a change, and a gap in the numbers tells a removal and, where the key comes back, an
addition.  A window partition holds one row per snapshot of one key, never a key's repeated rows:
repeats are aggregated away before the shuffle, so a key with a third of all rows is as small as any.

Only hashes of the discrete fields and the doubles themselves travel; doubles are compared with
their tolerance, so equal values in neighbouring hash cells are no change.

Defined results
- Rows with a null key part or a null snapshot id belong to no snapshot; so do rows whose current
  flag isn't 1.
- Repeated rows count once; contradicting repeats count as their greatest row.
- The first snapshot has no changes; an empty table gives no rows.
- A snapshot of which no row is current isn't seen, so the next is compared with the one before it.
- Extra columns are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.values import canonical, field_types, same, value_hash
from ..plans.storage import materialise

#: Snapshot ids are broadcast up to this number.
BROADCAST_SNAPSHOTS = 100_000


def snapshot_numbers(rows: DataFrame, snapshot: str) -> DataFrame:
    """(snapshot, __n, __next): dense numbers from 1, and the id that follows.

    One row per snapshot; the window runs over these ids alone.
    """
    ids = rows.select(snapshot).distinct()
    # The number of snapshots is small next to the rows, but nothing bounds it; one task sorts the ids.
    w = Window.partitionBy(F.lit(0)).orderBy(snapshot)
    return ids.select(snapshot, F.row_number().over(w).alias("__n"), F.lead(snapshot).over(w).alias("__next"))


def snapshot_changes(
    rows: DataFrame, keys: list[str], snapshot: str, fields: list[str], current: str | None = None
) -> DataFrame:
    """(snapshot, keys, op): per snapshot after the first, I, U or D against the one before."""
    kinds = field_types(rows, fields)
    doubles = [f for f in fields if isinstance(kinds[f], (T.DoubleType, T.FloatType))]
    discrete = [f for f in fields if f not in doubles]
    here = rows.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, snapshot]))
    if current:
        here = here.where(F.col(current) == 1)
    # Written, so the rows are scanned once for their ids and once for their values.
    numbers = materialise(snapshot_numbers(here, snapshot), "snapshots")
    narrow = canonical(here.select(snapshot, *keys, *fields), fields).select(
        F.col(snapshot).alias("__snap"),
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        value_hash((F.col(f), kinds[f]) for f in discrete).alias("__h"),
        *[F.col(f).alias(f"__v{i}") for i, f in enumerate(doubles)],
    )
    names = [f"__k{i}" for i in range(len(keys))]
    body = ["__h", *[f"__v{i}" for i in range(len(doubles))]]
    once = narrow.groupBy("__snap", *names).agg(F.max(F.struct(*body)).alias("__b"))
    if numbers.count() <= BROADCAST_SNAPSHOTS:
        numbers = F.broadcast(numbers)
    numbered = once.join(numbers.withColumnRenamed(snapshot, "__snap"), "__snap").select(*names, "__snap", "__n", "__next", "__b.*")
    w = Window.partitionBy(*names).orderBy("__n")
    lagged = numbered.select(
        "*",
        F.lag("__n").over(w).alias("__pn"),
        F.lead("__n").over(w).alias("__nn"),
        *[F.lag(c).over(w).alias(f"__p{c}") for c in body],
    )
    equal = F.col("__h") == F.col("__p__h")
    for i, f in enumerate(doubles):
        equal = equal & same(F.col(f"__v{i}"), F.col(f"__p__v{i}"), kinds[f])
    follows = F.col("__pn") == F.col("__n") - 1
    arrival = (
        F.when((F.col("__n") > 1) & F.coalesce(~follows, F.lit(True)), F.lit("I"))
        .when(follows & ~equal, F.lit("U"))
    )
    leaves = F.col("__next").isNotNull() & F.coalesce(F.col("__nn") > F.col("__n") + 1, F.lit(True))
    events = F.array_compact(
        F.array(
            F.when(arrival.isNotNull(), F.struct(F.col("__snap").alias("s"), arrival.alias("op"))),
            F.when(leaves, F.struct(F.col("__next").alias("s"), F.lit("D").alias("op"))),
        )
    )
    out = lagged.select(*names, F.explode(events).alias("__e"))
    return out.select(
        F.col("__e.s").alias(snapshot), *[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], F.col("__e.op").alias("op")
    )


def account_changes(snapshots: DataFrame) -> DataFrame:
    """(batch_id, sourcename, acctnbr, op) of the account snapshots."""
    fields = ["acctname", "acctstatcd", "mjaccttypcd", "branchnbr", "curbal", "intrate", "note"]
    found = snapshot_changes(snapshots, ["sourcename", "acctnbr"], "_cdc_batch_id", fields, "_cdc_is_current")
    return found.withColumnRenamed("_cdc_batch_id", "batch_id")
