"""Applying a stream of inserts, updates and deletes with delete vectors.

A :class:`ChangeTable` is a set of immutable image files, an index from key and change to the file and
position of the change's lowest batch, and one bitmap per block of 32,768 positions of a file whose set
bits mark superseded rows.  A batch of changes never rewrites an image: its rows are appended (or, if
they lie in Parquet files already, registered in place), the index finds what they supersede, those
bits are set, and a read drops the marked positions while it scans.  The index keeps the changes that
lost too: one of them can be delivered again with a higher batch, which mustn't make it win.

What a batch costs follows the batch, not the table.  Index and vectors are logs of segments, to which
a batch adds one: its own changes, in folders by key bucket, and the vectors of its own files and of the
older blocks in which a bit changes.  Of the older index only the touched buckets are read, for the
batch's keys alone.  After ``merge_every`` segments they are merged into one.

Order: changes apply by (time, batch, change id).  A change is told apart by its id; however often it
is delivered, in one batch or in several, it counts once, with its lowest batch.

Defined results
- A row without key, change id or time is no change; it is never read back.
- An operation counts by its first letter after trimming, in any case: I, A, U, R put the row in
  place, D removes it.  Any other operation, null and blank included, is no change.
- A null batch counts as higher than every other.
- Deliveries of one change id that contradict each other: the one with the lowest batch holds, then
  the lowest file id and position.
- An empty feed gives an empty table; extra columns are carried through, and one that is named like a
  column of the operator's own (``__file``, ``__pos``, ``__vf``, ``__vb``, ``__bits``) gets a ``_`` more.
- However a feed is divided into batches, and whatever their order, the table is the same.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import bitmaps
from ..plans.storage import materialise, new_path

_WHITE = " \t\n\r\f\x0b 　"
_LAST = (1 << 63) - 1
_OWN = ("__file", "__pos", "__vf", "__vb", "__bits")


@dataclass(frozen=True)
class FeedColumns:
    """Names of the columns that order a feed."""

    key: tuple[str, ...]
    change_id: str
    time: str
    batch: str
    operation: str


@dataclass(frozen=True)
class ChangeTable:
    """One version of a table: where its images, index and vectors lie.  Never changed in place."""

    columns: FeedColumns
    images: tuple[str, ...] = ()
    #: Segments of the index and of the vectors under the table's folder, oldest first.
    index: tuple[str, ...] = ()
    vectors: tuple[str, ...] = ()
    vector_blocks: int = 0
    root: str | None = None
    #: Key buckets of the index; fixed once there is one.  A bucket of a segment should be some hundred MB.
    buckets: int = 16
    #: Segments after which index and vectors are merged.
    merge_every: int = field(default=16, compare=False)
    #: Vectors are broadcast up to this many bytes; beyond it they are joined by (file, block).
    broadcast_bytes: int = field(default=16 << 20, compare=False)


def operation_letter(col: Column) -> Column:
    """First letter of the trimmed operation in upper case; null if there is none."""
    return F.upper(F.substring(F.btrim(col, F.lit(_WHITE)), 1, 1))


def _scan(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    """Image rows with the hash of their file's path and their position in it."""
    df = spark.read.parquet(*paths)
    return df.select(
        *[F.col(f"`{c}`").alias(f"{c}_" if c.lower() in _OWN else c) for c in df.columns],
        F.xxhash64("_metadata.file_path").alias("__file"),
        F.col("_metadata.row_index").alias("__pos"),
    )


def _check_file_ids(df: DataFrame) -> None:
    """Paths are known to the driver; two of them with one hash would mix up their positions."""
    files = df.inputFiles()
    if len(files) < 1000:
        return
    names = df.sparkSession.createDataFrame([(f,) for f in files], "f string")
    distinct = names.agg(F.count_distinct(F.xxhash64("f")).alias("n")).first()["n"]
    if distinct != len(set(files)):
        raise ValueError("two image files share a path hash; move one of them")


def _entries(images: DataFrame, c: FeedColumns) -> DataFrame:
    """Per key and change among ``images``, its delivery with the lowest batch.

    The aggregation starts before the shuffle, so a change id with a third of all rows sends one row per
    task.
    """
    key = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(c.key)]
    names = [f"__k{i}" for i in range(len(c.key))]
    rows = images.select(
        *key,
        F.col(f"`{c.change_id}`").alias("__change"),
        F.col(f"`{c.time}`").alias("__time"),
        F.coalesce(F.col(f"`{c.batch}`").cast("bigint"), F.lit(_LAST)).alias("__batch"),
        operation_letter(F.col(f"`{c.operation}`")).alias("__op"),
        "__file",
        "__pos",
    ).where(
        " AND ".join(f"{n} IS NOT NULL" for n in [*names, "__change", "__time"]) + " AND __op IN ('I', 'A', 'U', 'R', 'D')"
    )
    return rows.groupBy(*names, "__change").agg(F.min(F.struct("__batch", "__file", "__pos", "__time", "__op")).alias("__d"))


def _names(table: ChangeTable) -> list[str]:
    return [f"__k{i}" for i in range(len(table.columns.key))]


def _segments(spark: SparkSession, table: ChangeTable, kind: str, ids: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """Rows of some segments; one that a batch left empty has none."""
    base = f"{table.root}/{kind}"
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/seg={i}" for i in ids])


def _write_index(entries: DataFrame, table: ChangeTable, names: list[str], seg: str) -> T.StructType:
    """Writes a segment of the index by key bucket and returns what its rows look like.

    Buckets are balanced by size on the way, so a bucket with a hot key becomes several files.
    """
    bucketed = entries.withColumn("__kb", F.pmod(F.xxhash64(*names), F.lit(table.buckets)).cast("int"))
    bucketed.hint("rebalance", "__kb").write.partitionBy("__kb").parquet(f"{table.root}/index/seg={seg}")
    return _index_schema(entries)


def _index_schema(entries: DataFrame) -> T.StructType:
    return T.StructType([*entries.schema.fields, T.StructField("__kb", T.IntegerType()), T.StructField("seg", T.StringType())])


def _place(d: Column, change: Column, *more: Column) -> Column:
    """What orders the changes of a key, with the delivery's place."""
    return F.struct(d["__time"].alias("__time"), d["__batch"].alias("__batch"), change, d["__op"].alias("__op"), d["__file"].alias("__file"), d["__pos"].alias("__pos"), *more)


def _moves(spark: SparkSession, table: ChangeTable, names: list[str], seg: str, schema: T.StructType) -> DataFrame:
    """(__file, __pos, __kind): SET for positions that the batch supersedes in older files, CLEAR for those that
    hold again, LIVE for those that hold in its own files.

    The index is asked for the batch's keys only; a key with a third of all changes sends one row per task.
    """
    new = _segments(spark, table, "index", (seg,), schema)
    change, d = F.col("__change"), F.col("__d")
    if table.index:
        # At most as many numbers as there are buckets.
        touched = [r["__kb"] for r in new.select("__kb").distinct().collect()]
        old = _segments(spark, table, "index", table.index, schema).where(F.col("__kb").isin(touched))
        old = old.join(new.select(*names).distinct(), names, "left_semi")
        both = old.select(*names, "__change", "__d", d.alias("__o")).unionByName(new.select(*names, "__change", "__d"), allowMissingColumns=True)
        per_change = both.groupBy(*names, "__change").agg(F.min("__o").alias("__o"), F.min("__d").alias("__d"))
        fresh = ~d.eqNullSafe(F.col("__o"))
        was = F.max(F.when(F.col("__o").isNotNull(), _place(F.col("__o"), change)))
        decided = per_change.groupBy(*names).agg(was.alias("__was"), F.max(_place(d, change, fresh.alias("__fresh"))).alias("__now"))
    else:
        decided = new.groupBy(*names).agg(F.max(_place(d, change, F.lit(True).alias("__fresh"))).alias("__now")).withColumn("__was", F.lit(None).cast("struct<__op: string, __file: bigint, __pos: bigint>"))
    w, n = F.col("__was"), F.col("__now")
    w_live, n_live = F.coalesce(w["__op"] != "D", F.lit(False)), n["__op"] != "D"
    stays = w_live & n_live & (w["__file"] == n["__file"]) & (w["__pos"] == n["__pos"])

    def move(x: Column, kind: Column) -> Column:
        return F.struct(x["__file"].alias("__file"), x["__pos"].alias("__pos"), kind.alias("__kind"))

    moves = F.array_compact(
        F.array(
            F.when(w_live & ~stays, move(w, F.lit(SET))),
            F.when(n_live & ~stays, move(n, F.when(n["__fresh"], F.lit(LIVE)).otherwise(F.lit(CLEAR)))),
        )
    )
    return decided.select(F.explode(moves).alias("__m")).select("__m.*")


SET, CLEAR, LIVE = 0, 1, 2
_VECTOR = T.StructType([T.StructField(n, k) for n, k in (("__file", T.LongType()), ("__block", T.LongType()), ("__bits", T.BinaryType()), ("__n", T.IntegerType()), ("__own", T.BooleanType()), ("seg", T.StringType()))])


def vectors(spark: SparkSession, table: ChangeTable, blocks: DataFrame | None = None) -> DataFrame:
    """(__file, __block, __bits): a set bit is a row that no longer holds; of all blocks or of those given."""
    rows = _segments(spark, table, "vectors", table.vectors, _VECTOR)
    if blocks is not None:
        rows = rows.join(blocks.select("__file", "__block"), ["__file", "__block"], "left_semi")
    if len(table.vectors) > 1:
        rows = rows.groupBy("__file", "__block").agg(F.max_by("__bits", "__n").alias("__bits"))
    return rows.select("__file", "__block", "__bits")


def _changed_blocks(old: DataFrame, bits: DataFrame) -> DataFrame:
    """The vectors of the older blocks in ``bits`` after setting and clearing."""
    here = old.join(bits.select("__file", "__block", "__set", "__clear"), ["__file", "__block"])
    either = here.select("__file", "__block", "__clear", F.explode(F.array("__bits", "__set")).alias("__b"))
    either = either.groupBy("__file", "__block").agg(F.bitmap_or_agg("__b").alias("__b"), F.first("__clear").alias("__clear"))
    each = either.select("__file", "__block", F.explode(F.array("__b", bitmaps.invert(F.col("__clear")))).alias("__b"))
    return each.groupBy("__file", "__block").agg(F.bitmap_and_agg("__b").alias("__bits"))


def _write_vectors(spark: SparkSession, table: ChangeTable, fresh: DataFrame, moves: DataFrame, seg: str) -> None:
    """Writes the vectors of the batch's own blocks, in which all but the live rows are superseded, and of
    the older blocks in which a bit changes."""

    def collected(kind: int) -> Column:
        return F.expr(f"bitmap_construct_agg(__bit) FILTER (WHERE __kind = {kind})")

    placed = moves.select("__file", bitmaps.block_of(F.col("__pos")).alias("__block"), bitmaps.bit_of(F.col("__pos")).alias("__bit"), "__kind")
    bits = placed.groupBy("__file", "__block").agg(collected(SET).alias("__set"), collected(CLEAR).alias("__clear"), collected(LIVE).alias("__live"))
    sizes = fresh.groupBy("__file").agg(F.max("__pos").alias("__max"))
    blocks = sizes.select("__file", F.explode(F.sequence(F.lit(0).cast("bigint"), bitmaps.block_of(F.col("__max")))).alias("__block"))
    if table.vectors:
        bits = materialise(bits, "moves")
    own = blocks.join(bits, ["__file", "__block"], "left").select("__file", "__block", F.coalesce(bitmaps.invert(F.col("__live")), bitmaps.full()).alias("__bits"), F.lit(True).alias("__own"))
    if table.vectors:
        own = own.unionByName(_changed_blocks(vectors(spark, table, bits), bits).withColumn("__own", F.lit(False)))
    # Segments are told apart by their number: of a block's vectors the last counts.
    own.withColumn("__n", F.lit(len(table.vectors))).write.parquet(f"{table.root}/vectors/seg={seg}")


def compact(spark: SparkSession, table: ChangeTable) -> ChangeTable:
    """The same table with its index and vectors in one segment each."""
    names, seg = _names(table), uuid.uuid4().hex[:12]
    kinds = _index_schema(_entries(_scan(spark, table.images[:1]), table.columns))
    merged = _segments(spark, table, "index", table.index, kinds).groupBy(*names, "__change").agg(F.min("__d").alias("__d"))
    _write_index(merged, table, names, seg)
    vectors(spark, table).withColumns({"__n": F.lit(0), "__own": F.lit(True)}).write.parquet(f"{table.root}/vectors/seg={seg}")
    return replace(table, index=(seg,), vectors=(seg,))


def apply_files(spark: SparkSession, table: ChangeTable, paths: list[str]) -> ChangeTable:
    """The table after the changes in the Parquet files at ``paths``, which become images in place."""
    table = table if table.root else replace(table, root=new_path(spark, "table"))
    names, seg = _names(table), uuid.uuid4().hex[:12]
    fresh = _scan(spark, tuple(paths))
    _check_file_ids(fresh)
    schema = _write_index(_entries(fresh, table.columns), table, names, seg)
    _write_vectors(spark, table, fresh, _moves(spark, table, names, seg, schema), seg)
    added = _segments(spark, table, "vectors", (seg,), _VECTOR).where("__own").count()
    out = replace(table, images=(*table.images, *paths), index=(*table.index, seg), vectors=(*table.vectors, seg), vector_blocks=table.vector_blocks + added)
    return compact(spark, out) if len(out.index) >= out.merge_every else out


def apply_changes(spark: SparkSession, table: ChangeTable, feed: DataFrame) -> ChangeTable:
    """The table after ``feed``, whose rows are appended as new image files."""
    table = table if table.root else replace(table, root=new_path(spark, "table"))
    path = f"{table.root}/images/{uuid.uuid4().hex[:12]}"
    feed.write.parquet(path)
    return apply_files(spark, table, [path])


def read_table(spark: SparkSession, table: ChangeTable) -> DataFrame:
    """The rows that hold now: the images without the positions marked in their file's vectors."""
    images = _scan(spark, table.images)
    own = images.columns[:-2]
    marks = vectors(spark, table).select(F.col("__file").alias("__vf"), F.col("__block").alias("__vb"), "__bits")
    small = table.vector_blocks * (bitmaps.BLOCK // 8) <= table.broadcast_bytes
    marks = F.broadcast(marks) if small else marks.hint("shuffle_hash")
    marked = (
        (F.col("__file") == F.col("__vf"))
        & (bitmaps.block_of(F.col("__pos")) == F.col("__vb"))
        & bitmaps.is_set(F.col("__bits"), F.col("__pos"))
    )
    return images.join(marks, marked, "left_anti").select(*[F.col(f"`{c}`") for c in own])


ACCOUNT_FEED = FeedColumns(("acctnbr",), "change_id", "_cdc_valid_from", "_cdc_batch_id", "_cdc_operation")


def accounts_at_end(spark: SparkSession, path: str) -> DataFrame:
    """The account rows that exist after all changes of the feed at ``path``."""
    return read_table(spark, apply_files(spark, ChangeTable(ACCOUNT_FEED), [path]))


def accounts_after_batches(spark: SparkSession, feed: DataFrame, batches: int = 4) -> DataFrame:
    """The same rows, with the feed's deliveries divided among several batches that are applied one after the other."""
    turn = F.pmod(F.xxhash64(*[F.col(c) for c in ("change_id", "acctnbr", "_extracted_at", "_cdc_batch_id")]), F.lit(batches))
    table = ChangeTable(ACCOUNT_FEED)
    for i in range(batches):
        table = apply_changes(spark, table, feed.where(turn == i))
    return read_table(spark, table)
