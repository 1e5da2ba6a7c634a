"""What came before a row in the order of its key, without a task that sorts a whole key.

Rows are cut into chunks of time (a calendar unit), and a window runs inside each (key, chunk).  What
goes on from one chunk to the next is one small row per (key, chunk): an aggregate that is combined
map-side, carried along the chunks by a second window and joined back.  So a key that holds a third of
all rows lies in as many pieces as its rows span chunks; the second window sees a row per chunk only.

Defined results
- Rows with a null key or time are no rows of any order and aren't returned.
- The order must be total inside a key for a result that doesn't depend on chance; it must agree with
  the time, which cuts the chunks.
- An empty table gives no rows; columns that begin with ``__o_`` are the operator's own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def running(
    rows: DataFrame, keys: Sequence[str], at: str, order: Sequence[Column], wanted: dict[str, tuple[str, Column]], chunk: str = "month", *, backwards: bool = False
) -> DataFrame:
    """``rows`` with a column per entry of ``wanted``: an aggregate over the rows of its key before it.

    An entry is (kind, value): 'last' is the last value that isn't null, 'max' the largest, 'sum' the
    sum, 0 if there is none.  'rare' is 'last' where most rows have no value: only those that have one are
    sorted for what is carried on.  The rows of a key are sorted by ``order``, or, if ``backwards``, by its
    opposite, so that 'last' is the next value.
    """
    some = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, at]])
    cut = rows.where(some).withColumn("__o_chunk", F.date_trunc(chunk, F.col(at).cast("timestamp_ntz").cast("timestamp")))
    cut = cut.withColumns({f"__o_v{i}": value for i, (_, value) in enumerate(wanted.values())} | {f"__o_s{i}": c for i, c in enumerate(order)})
    names, kinds = [*keys, "__o_chunk"], [kind for kind, _ in wanted.values()]
    way = F.desc if backwards else F.asc
    sort = [f"__o_s{i}" for i in range(len(order))]
    inside = Window.partitionBy(*names).orderBy(*map(way, sort)).rowsBetween(Window.unboundedPreceding, -1)
    chunks = Window.partitionBy(*keys).orderBy(way("__o_chunk")).rowsBetween(Window.unboundedPreceding, -1)

    def over(kind: str, value: str, w) -> Column:
        if kind in ("last", "rare"):
            return F.last(value, ignorenulls=True).over(w)
        return (F.max(value) if kind == "max" else F.sum(value)).over(w)

    def total(kind: str, v: Column) -> Column:
        if kind in ("last", "rare"):
            return (F.min_by if backwards else F.max_by)(v, F.when(v.isNotNull(), F.struct(*sort)))
        return F.max(v) if kind == "max" else F.sum(v)

    found = cut.withColumns({f"__o_in{i}": over(k, f"__o_v{i}", inside) for i, k in enumerate(kinds)})
    totals = {i: total(k, F.col(f"__o_v{i}")).alias(f"__o_t{i}") for i, k in enumerate(kinds)}
    dense = [t for i, t in totals.items() if kinds[i] != "rare"]
    carried = cut.groupBy(*names).agg(*dense) if dense else cut.select(*names).distinct()
    for i, kind in enumerate(kinds):
        if kind == "rare":
            carried = carried.join(cut.where(F.col(f"__o_v{i}").isNotNull()).groupBy(*names).agg(totals[i]), names, "left")
    carried = carried.select(*names, *[over(k, f"__o_t{i}", chunks).alias(f"__o_c{i}") for i, k in enumerate(kinds)])
    joined = found.join(carried, names)
    out = {}
    for i, (name, (kind, _)) in enumerate(wanted.items()):
        a, b = F.col(f"__o_in{i}"), F.col(f"__o_c{i}")
        if kind == "sum":
            out[name] = F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        else:
            out[name] = F.greatest(a, b) if kind == "max" else F.coalesce(a, b)
    return joined.withColumns(out).select(*rows.columns, *[n for n in wanted if n not in rows.columns])
