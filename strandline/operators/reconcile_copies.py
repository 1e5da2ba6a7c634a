"""Differences between two copies of data by invertible Bloom lookup tables.

Every row becomes a pair (64-bit key hash, 64-bit hash of its values).  Rows of a partition column
(``bucket_by``, a batch here) share a small table of cells; each pair is added to three cells of its
bucket, chosen by key and values, so that the two pairs of a changed row don't hide each other, with sign +1 from the source and -1 from the target.  Equal rows cancel, so after summing
only differences remain, and peeling cells that hold a single pair reveals their keys.  The rows of
those keys, and only those, are then fetched from both copies and compared field by field.

A cell holds sums, not exclusive ors, and signed counts, so whatever doesn't cancel stays to be seen.
Buckets larger than ``ROWS`` keys are split by key hash, so one hot batch becomes many buckets.  A bucket with
more differences than its cells can hold doesn't peel; all its rows are fetched and compared, which is
exact and just as distributed.

Pairs are moved once.  Rows are thinned to key and hash and repeats dropped inside each task; the
pairs meet by bucket, where keys are made distinct, counted, and summed into cells without moving
again, because a bucket's pairs lie together.  A key whose repeats in one copy contradict each other gets a
hash that never cancels.

Defined results
- Keys with a null part are no records.
- A key repeated in a copy counts once; contradicting repeats count as their greatest row.
- Values compare as in :mod:`strandline.functions.values`.
- Two empty copies, or equal ones, give no rows; extra columns beyond ``keys`` and ``fields`` are
  ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.values import canonical, field_types, same, value_hash
from ..plans.storage import materialise

#: Keys of a bucket, about.
ROWS = 192
#: Cells of each of a bucket's three subtables: enough for changes in about a fifth of its keys.
WIDTH = 32
#: Buckets or suspects are broadcast up to this many rows of about 32 bytes.
BROADCAST_ROWS = 200_000
#: Beyond that, parts into which a bucket's rows are divided for the join with its size or suspects.
SALTS = 32
_LOW = 0xFFFFFFFF
_MASK31 = 0x7FFFFFFF


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_LOW).cast("bigint"))


def _check(k: Column, h: Column) -> Column:
    """A check of a pair that is not linear in it, so sums of several pairs don't satisfy it."""
    m = F.lit(_MASK31).cast("bigint")
    p = (k.bitwiseAND(m) * h.bitwiseAND(m)).bitwiseXOR(F.shiftright(k, 32).bitwiseAND(m) * F.shiftright(h, 32).bitwiseAND(m))
    return _low(F.shiftright(p, 15))


def _np_check(k: np.ndarray, h: np.ndarray) -> np.ndarray:
    p = ((k & _MASK31) * (h & _MASK31)) ^ (((k >> 32) & _MASK31) * ((h >> 32) & _MASK31))
    return (p >> 15) & _LOW


def _slot(kh: Column, j: int) -> Column:
    """One of three cells of a pair, from the exclusive or of its two hashes."""
    return F.pmod(F.shiftright(kh, 20 * j).bitwiseAND(F.lit(0xFFFFF).cast("bigint")), F.lit(WIDTH)).cast("int") + j * WIDTH


def _np_slot(kh: np.ndarray, j: int) -> np.ndarray:
    return ((kh >> (20 * j)) & 0xFFFFF) % WIDTH + j * WIDTH


def peel(bucket: np.ndarray, cells: dict[str, np.ndarray], count: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Peels many buckets at once.

    ``bucket`` numbers the bucket of each cell row from 0 and ``cells`` has slot, n and the sums; ``count`` is the
    number of buckets, if some may have no cell.
    Returns bucket and key hash of every revealed pair, and a flag per bucket: whether it is empty now.
    """
    size = 3 * WIDTH
    count = count if count is not None else int(bucket.max()) + 1 if len(bucket) else 0
    at = bucket * size + cells["slot"]
    table = {c: np.zeros(count * size, np.int64) for c in ("n", "kl", "kh", "hl", "hh", "ck")}
    for c, v in table.items():
        v[at] = cells[c]
    found_b, found_k = [], []
    while True:
        i = np.flatnonzero(table["n"])
        m = table["n"][i]
        whole = np.ones(len(i), bool)
        part = {}
        for c in ("kl", "kh", "hl", "hh", "ck"):
            v = table[c][i]
            part[c] = v // m
            whole &= part[c] * m == v
        for c in ("kl", "hl", "ck"):
            whole &= (part[c] >= 0) & (part[c] <= _LOW)
        for c in ("kh", "hh"):
            whole &= (part[c] >= -(1 << 31)) & (part[c] < 1 << 31)
        i, m, part = i[whole], m[whole], {c: v[whole] for c, v in part.items()}
        k, h = (part["kh"] << 32) | part["kl"], (part["hh"] << 32) | part["hl"]
        b, slot = i // size, i % size
        own = np.choose(slot // WIDTH, [_np_slot(k ^ h, j) for j in range(3)]) == slot
        pure = own & (_np_check(k, h) == part["ck"])
        if not pure.any():
            break
        b, k, h, m = b[pure], k[pure], h[pure], m[pure]
        _, first = np.unique(np.stack([b, k, h]), axis=1, return_index=True)
        b, k, h, m = b[first], k[first], h[first], m[first]
        found_b.append(b)
        found_k.append(k)
        parts = {"n": np.ones_like(k), "kl": k & _LOW, "kh": k >> 32, "hl": h & _LOW, "hh": h >> 32, "ck": _np_check(k, h)}
        for j in range(3):
            to = b * size + _np_slot(k ^ h, j)
            for c, v in parts.items():
                np.subtract.at(table[c], to, v * m)
    left = np.zeros(count * size, bool)
    for v in table.values():
        left |= v != 0
    clean = ~left.reshape(count, size).any(axis=1)
    none = np.zeros(0, np.int64)
    return np.concatenate(found_b or [none]), np.concatenate(found_k or [none]), clean


#: The slot after a bucket's cells, in which its keys are counted: n of the source, kl of the target.
COUNT_SLOT = 3 * WIDTH
_FIELDS = ("slot", "n", "kl", "kh", "hl", "hh", "ck")


def _peel_batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per bucket a row with its counts, and a row per suspect: a key hash, or null for all of its rows."""
    for pdf in it:
        if not len(pdf):
            continue
        lengths = pdf["cells"].map(len).to_numpy()
        flat = [c for row in pdf["cells"] for c in row]
        cells = {f: np.fromiter((c[f] for c in flat), np.int64, len(flat)) for f in _FIELDS}
        of = np.repeat(np.arange(len(pdf)), lengths)
        counting = cells["slot"] == COUNT_SLOT
        counts = [np.zeros(len(pdf), np.int64) for _ in range(2)]
        for c, f in zip(counts, ("n", "kl"), strict=True):
            c[of[counting]] = cells[f][counting]
        found, k, clean = peel(of[~counting], {f: v[~counting] for f, v in cells.items()}, len(pdf))
        ok = clean[found]
        failed = np.flatnonzero(~clean)
        rows = np.concatenate([np.arange(len(pdf)), found[ok], failed])
        suspect = np.arange(len(rows)) >= len(pdf)
        keys = pd.array(np.concatenate([np.zeros(len(pdf), np.int64), k[ok], np.zeros(len(failed), np.int64)]), dtype="Int64")
        keys[: len(pdf)] = pd.NA
        keys[len(rows) - len(failed) :] = pd.NA
        out = {"__bucket": pdf["__bucket"].to_numpy()[rows], "__sub": pdf["__sub"].to_numpy()[rows], "__key": keys, "__suspect": suspect}
        yield pd.DataFrame(out | {f"__{n}": np.where(suspect, 0, c[rows]) for n, c in zip(("s", "t"), counts, strict=True)})


#: Rows of a task among which repeats are dropped before they are moved.
THIN_ROWS = 200_000


def _thin(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without repeats, so far as these lie near each other."""

    def distinct(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        return t.group_by(t.column_names).aggregate([]).select(t.column_names).to_batches()

    held, rows = [], 0
    for batch in it:
        held.append(batch)
        rows += batch.num_rows
        if rows >= THIN_ROWS:
            yield from distinct(held)
            held, rows = [], 0
    if held:
        yield from distinct(held)


def bucket_sizes(source: DataFrame, target: DataFrame, keys: list[str], bucket_by: str) -> DataFrame:
    """(__bucket, __n): rows of each bucket in the copy that has more, repeats included; one column is read."""
    some = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    both = source.where(some).select(F.col(bucket_by).alias("__bucket"), F.lit(1).alias("__s")).unionByName(target.where(some).select(F.col(bucket_by).alias("__bucket"), F.lit(0).alias("__s")))
    return both.groupBy("__bucket").agg(F.greatest(F.sum("__s"), F.sum(1 - F.col("__s"))).alias("__n"))


def _salted(few: DataFrame, small: bool) -> DataFrame:
    """``few`` ready for a join with rows that have a ``__salt``: broadcast, or a row for each salt."""
    salts = [0] if small else range(SALTS)
    out = few.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in salts])))
    return F.broadcast(out) if small else out


def _pairs(df: DataFrame, keys: list[str], fields: list[str], bucket_by: str, large: DataFrame, small: bool) -> DataFrame:
    """Canonical rows with bucket, key hash and value hash.

    Where the buckets' sizes can't be broadcast, the join divides a bucket's rows by key hash, so a bucket
    with a third of all rows isn't one task.
    """
    kinds = field_types(df, fields)
    some = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    rows = canonical(df.where(some).select(*keys, *fields), fields)
    rows = rows.withColumns(
        {"__k": F.xxhash64(*keys), "__h": value_hash((F.col(f), kinds[f]) for f in fields), "__bucket": F.col(bucket_by)}
    )
    subs = F.when(F.col("__subs").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("__k"), F.col("__subs")))
    rows = rows.withColumn("__salt", F.lit(0) if small else F.pmod(F.xxhash64("__k"), F.lit(SALTS)).cast("int"))
    return rows.join(large, ["__bucket", "__salt"], "left").withColumn("__sub", subs.cast("int")).drop("__subs", "__salt")


def sketches(source: DataFrame, target: DataFrame, keys: list[str], bucket_by: str) -> DataFrame:
    """(__bucket, __sub, cells): cells of the source's tables minus the target's that aren't empty, with the
    distinct keys of both counted in one cell more."""
    other = [k for k in keys if k != bucket_by]
    signed = source.select("__bucket", "__sub", *other, "__h", F.lit(True).alias("__src")).unionByName(target.select("__bucket", "__sub", *other, "__h", F.lit(False).alias("__src")))
    near = signed.mapInArrow(_thin, signed.schema).repartition("__bucket", "__sub")
    once = near.groupBy("__bucket", "__sub", *other, "__src").agg(F.min("__h").alias("__lo"), F.max("__h").alias("__hi"))
    pairs = once.select(
        "__bucket", "__sub", F.xxhash64(*[F.col("__bucket" if c == bucket_by else c) for c in keys]).alias("__k"),
        F.when(F.col("__lo") == F.col("__hi"), F.col("__lo")).otherwise(F.xxhash64("__lo", "__hi", "__src")).alias("__h"), F.when(F.col("__src"), 1).otherwise(-1).cast("bigint").alias("__sign"),
    )
    k, h, s = F.col("__k"), F.col("__h"), F.col("__sign")
    parts = {"n": s, "kl": s * _low(k), "kh": s * F.shiftright(k, 32), "hl": s * _low(h), "hh": s * F.shiftright(h, 32), "ck": s * _check(k, h)}
    zero = F.lit(0).cast("bigint")
    counted = {"n": F.when(s > 0, 1).otherwise(0).cast("bigint"), "kl": F.when(s < 0, 1).otherwise(0).cast("bigint")}
    cells = [F.struct(_slot(k.bitwiseXOR(h), j).alias("slot"), *[v.alias(c) for c, v in parts.items()]) for j in range(3)]
    cells.append(F.struct(F.lit(COUNT_SLOT).alias("slot"), *[counted.get(c, zero).alias(c) for c in parts]))
    spread = pairs.select("__bucket", "__sub", F.explode(F.array(*cells)).alias("c")).select("__bucket", "__sub", "c.*")
    summed = spread.groupBy("__bucket", "__sub", "slot").agg(*[F.sum(c).alias(c) for c in parts])
    left = summed.where(" OR ".join(f"{c} <> 0" for c in parts))
    return left.groupBy("__bucket", "__sub").agg(F.collect_list(F.struct("slot", *parts)).alias("cells"))


def differing_rows(source: DataFrame, target: DataFrame, keys: list[str], fields: list[str], bucket_by: str) -> tuple[DataFrame, DataFrame]:
    """One row per key missing from a copy or differing in a field, keys and the list ``names``; and (bucket_by,
    source_rows, target_rows), the distinct keys of each bucket.

    ``names`` holds 'source_only', 'target_only' or the differing fields.
    """
    kinds = field_types(source, fields)
    sizes = materialise(bucket_sizes(source, target, keys, bucket_by).where(F.col("__n") > ROWS), "sizes")
    large = sizes.select("__bucket", F.ceil(F.col("__n") / ROWS).cast("bigint").alias("__subs"))
    few = large.count() <= BROADCAST_ROWS
    large = _salted(large, few)
    s, t = (_pairs(x, keys, fields, bucket_by, large, few) for x in (source, target))
    bucket_type = source.schema[bucket_by].dataType.simpleString()
    schema = f"__bucket {bucket_type}, __sub int, __key bigint, __suspect boolean, __s bigint, __t bigint"
    peeled = materialise(sketches(s, t, keys, bucket_by).mapInPandas(_peel_batches, schema), "peeled")
    counts = peeled.where("NOT __suspect").groupBy(F.col("__bucket").alias(bucket_by)).agg(F.sum("__s").alias("source_rows"), F.sum("__t").alias("target_rows"))
    suspects = peeled.where("__suspect").select(F.col("__bucket").alias("__b"), F.col("__sub").alias("__u"), "__key")
    if suspects.count() <= BROADCAST_ROWS:
        suspects = F.broadcast(suspects)
    hit = (
        F.col("__bucket").eqNullSafe(F.col("__b"))
        & (F.col("__sub") == F.col("__u"))
        & (F.col("__key").isNull() | (F.col("__key") == F.col("__k")))
    )
    body = F.struct(*fields)
    fetched = s.join(suspects, hit, "left_semi").select(*keys, body.alias("__src"), F.lit(None).cast(s.select(body).schema[0].dataType).alias("__tgt"))
    fetched = fetched.unionByName(
        t.join(suspects, hit, "left_semi").select(*keys, F.lit(None).cast(t.select(body).schema[0].dataType).alias("__src"), body.alias("__tgt"))
    )
    per_key = fetched.groupBy(*keys).agg(F.max("__src").alias("__src"), F.max("__tgt").alias("__tgt"))
    differing = F.array_compact(
        F.array(*[F.when(~same(F.col(f"__src.{f}"), F.col(f"__tgt.{f}"), kinds[f]), F.lit(f)) for f in fields])
    )
    names = (
        F.when(F.col("__tgt").isNull(), F.array(F.lit("source_only")))
        .when(F.col("__src").isNull(), F.array(F.lit("target_only")))
        .otherwise(differing)
    )
    return per_key.select(*keys, names.alias("names")).where(F.size("names") > 0), counts


COUNTS = ("SourceRows", "TargetRows", "MismatchedRows", "SourceOnlyRows", "TargetOnlyRows")


def log_findings(log: DataFrame, counts: DataFrame, found: DataFrame, bucket_by: str) -> DataFrame:
    """(bucket_by, field_name): counts of each bucket's latest log row that are null or wrong.

    Buckets without a log row give nothing; a log row of a bucket that no copy has is held against
    zeros.  Of equal dates the highest Id counts.
    """
    latest = log.where("BatchId IS NOT NULL").groupBy(F.col("BatchId").alias(bucket_by)).agg(F.max(F.struct("RunDate", "Id", *COUNTS)).alias("__l"))
    kind = F.element_at("names", 1)
    tally = found.groupBy(bucket_by).agg(
        F.count_if(kind == "source_only").alias("__so"),
        F.count_if(kind == "target_only").alias("__to"),
        F.count_if(~kind.isin("source_only", "target_only")).alias("__mm"),
    )
    true = {"SourceRows": "source_rows", "TargetRows": "target_rows", "MismatchedRows": "__mm", "SourceOnlyRows": "__so", "TargetOnlyRows": "__to"}
    joined = latest.join(counts, bucket_by, "left").join(tally, bucket_by, "left")
    wrong = F.array_compact(
        F.array(*[F.when(~F.col(f"__l.{c}").eqNullSafe(F.coalesce(F.col(v), F.lit(0))), F.lit(c)) for c, v in true.items()])
    )
    return joined.select(bucket_by, F.explode(wrong).alias("field_name"))


ACCOUNT_KEYS = ["batch_id", "acctnbr"]
ACCOUNT_FIELDS = ["branchnbr", "mjaccttypcd", "acctstatcd", "acctname", "curbal", "intrate", "opendate", "note"]


def account_findings(spark: SparkSession, source: DataFrame, target: DataFrame, log: DataFrame) -> DataFrame:
    """(batch_id, acctnbr, field_name) of the two account copies and the log of earlier runs."""
    fields = ACCOUNT_FIELDS
    found, counts = differing_rows(source, target, ACCOUNT_KEYS, fields, "batch_id")
    found = materialise(found, "differences")
    rows = found.select("batch_id", "acctnbr", F.explode("names").alias("field_name"))
    wrong = log_findings(log, counts, found, "batch_id")
    return rows.unionByName(wrong.select("batch_id", F.lit(-1).cast("bigint").alias("acctnbr"), "field_name"))
