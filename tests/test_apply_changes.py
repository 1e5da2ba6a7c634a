import random
from datetime import datetime, timedelta

from strandline.functions import bitmaps
from hypothesis import given, settings, strategies as st

from strandline.operators.apply_changes import ACCOUNT_FEED, ChangeTable, apply_changes, apply_files, compact, read_table
from pyspark.sql import functions as F

SCHEMA = "change_id bigint, acctnbr bigint, name string, _cdc_operation string, _cdc_valid_from timestamp_ntz, _cdc_batch_id bigint, __file string"
T0 = datetime(2026, 1, 1)
OPS = ["I", "U", " u", "UPDATE", "d", "DELETE ", "R", "A", "x", None, ""]


def feed(seed, rows, keys):
    r = random.Random(seed)
    out, by_id = [], {}
    for i in range(rows):
        cid = r.randrange(rows // 2)
        if cid not in by_id:
            # One key holds a third of all changes.
            key = 1 if r.random() < 0.33 else r.randrange(keys)
            at = None if r.random() < 0.05 else T0 + timedelta(seconds=r.randrange(20), microseconds=r.randrange(3))
            by_id[cid] = (None if r.random() < 0.05 else key, f"n{cid}", r.choice(OPS), at)
        k, n, op, at = by_id[cid]
        out.append((cid if r.random() > 0.02 else None, k, n, op, at, None if r.random() < 0.03 else r.randrange(9), "x"))
    return out


def brute(rows):
    changes = {}
    for cid, k, n, op, at, batch, _ in rows:
        letter = (op or "").strip()[:1].upper()
        if cid is None or k is None or at is None or letter not in tuple("IAURD"):
            continue
        b = batch if batch is not None else 1 << 62
        if (k, cid) not in changes or b < changes[k, cid][1]:
            changes[k, cid] = (at, b, cid, letter)
    last = {}
    for (k, _), c in changes.items():
        last[k] = max(last.get(k, c), c)
    return {(k, c[2]) for k, c in last.items() if c[3] != "D"}


def found(spark, table):
    return {(r["acctnbr"], r["change_id"]) for r in read_table(spark, table).select("acctnbr", "change_id").collect()}


def test_one_batch_and_several_agree_with_brute_force(spark):
    rows = feed(1, 600, 40)
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(spark, apply_changes(spark, ChangeTable(ACCOUNT_FEED), df)) == want
    table = ChangeTable(ACCOUNT_FEED)
    for i in range(3):
        table = apply_changes(spark, table, spark.createDataFrame(rows[i * 200 : (i + 1) * 200], SCHEMA))
    assert found(spark, table) == want
    again = apply_changes(spark, table, spark.createDataFrame(rows[100:300], SCHEMA))
    assert found(spark, again) == want


def test_redelivery_with_tied_times_over_several_batches(spark):
    row = lambda cid, key, op, batch: (cid, key, f"n{cid}", op, T0, batch, "x")
    batches = [
        [row(1, 1, "I", 1), row(2, 1, "U", 2), row(11, 2, "D", 1), row(12, 2, "I", 2)],
        # The losers come again with higher batches; so does one beside a fresh change that it would hide.
        [row(1, 1, "I", 3), row(11, 2, "D", 5), row(21, 3, "U", 4)],
        [row(22, 3, "U", 5), row(23, 3, "U", 6)],
        [row(21, 3, "U", 8), row(22, 3, "U", 9), row(24, 3, "U", 7)],
    ]
    table = ChangeTable(ACCOUNT_FEED)
    for b in batches:
        table = apply_changes(spark, table, spark.createDataFrame(b, SCHEMA))
    assert found(spark, table) == {(1, 2), (2, 12), (3, 24)} == brute(sum(batches, []))


def run(spark, batches, **how):
    table = ChangeTable(ACCOUNT_FEED, **how)
    for b in batches:
        table = apply_changes(spark, table, spark.createDataFrame(b, SCHEMA))
    return table


def test_losers_that_come_again(spark):
    row = lambda cid, op, batch: (cid, 1, f"n{cid}", op, T0, batch, "x")
    for first, again in (
        ([row(1, "U", 2), row(2, "U", 5)], row(1, "U", 9)),
        # A winner delivered with a lower batch makes another change of the first batch hold again.
        ([row(1, "U", 5), row(2, "U", 4)], row(1, "U", 3)),
        ([row(1, "D", 2), row(2, "U", 5)], row(1, "D", 9)),
        ([row(1, "D", 5), row(2, "U", 4)], row(1, "D", 3)),
    ):
        assert found(spark, run(spark, [first, [again]])) == brute([*first, again])


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 1000), st.lists(st.integers(0, 60), max_size=3), st.sampled_from([2, 16]))
def test_any_split_into_batches_gives_the_same(spark, seed, cuts, merge):
    # Few times and keys: most changes are tied with others.
    r = random.Random(seed)
    rows = [(c := r.randrange(25), c % 4, f"n{c}", "IUD"[c % 3], T0 + timedelta(seconds=c % 2), r.randrange(6), "x") for _ in range(60)]
    ends = sorted({0, 60, *cuts})
    assert found(spark, run(spark, [rows[a:b] for a, b in zip(ends, ends[1:], strict=False)], merge_every=merge, buckets=3)) == brute(rows)


def test_a_batch_writes_only_what_it_touches(spark):
    rows = [(i, i, "n", "I", T0, 1, "x") for i in range(200)]
    one = run(spark, [rows], buckets=8)
    two = apply_changes(spark, one, spark.createDataFrame([(900, 7, "n", "U", T0 + timedelta(1), 2, "x")], SCHEMA))
    assert two.index[:-1] == one.index and two.vectors[:-1] == one.vectors
    seg = lambda kind, t: spark.read.parquet(f"{t.root}/{kind}/seg={getattr(t, kind)[-1]}")
    assert seg("index", two).count() == 1 and seg("vectors", two).where("NOT __own").count() == 1
    assert found(spark, compact(spark, two)) == found(spark, two) == {(i, i) for i in range(200) if i != 7} | {(7, 900)}


def test_files_in_place_and_without_broadcast(spark, tmp_path):
    rows = feed(2, 400, 30)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "f"))
    table = apply_files(spark, ChangeTable(ACCOUNT_FEED, broadcast_bytes=0), [str(tmp_path / "f")])
    assert found(spark, table) == brute(rows)
    assert "__file_" in read_table(spark, table).columns


def test_empty_batches(spark):
    empty = spark.createDataFrame([], SCHEMA)
    table = ChangeTable(ACCOUNT_FEED, merge_every=2)
    for _ in range(3):
        table = apply_changes(spark, table, empty)
    table = apply_changes(spark, table, spark.createDataFrame([(1, 1, "n", "I", T0, 1, "x")], SCHEMA))
    assert found(spark, apply_changes(spark, table, empty)) == {(1, 1)}


def test_empty_feed(spark):
    table = apply_changes(spark, ChangeTable(ACCOUNT_FEED), spark.createDataFrame([], SCHEMA))
    assert found(spark, table) == set()


def test_bitmaps(spark):
    pos = [0, 7, 8, 32767, 32768, 40000]
    df = spark.createDataFrame([(p,) for p in pos], "p bigint")
    maps = df.groupBy(bitmaps.block_of(F.col("p")).alias("b")).agg(bitmaps.collect_bits(F.col("p")).alias("m"))
    probe = spark.range(0, 41000).withColumnRenamed("id", "q")
    hit = probe.join(maps, bitmaps.block_of(F.col("q")) == F.col("b")).where(bitmaps.is_set(F.col("m"), F.col("q")))
    assert sorted(r["q"] for r in hit.collect()) == pos
    assert maps.select(F.bitmap_count(bitmaps.invert(F.col("m"))).alias("n"), "b").orderBy("b").collect()[0]["n"] == bitmaps.BLOCK - 4
