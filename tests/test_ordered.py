import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strandline.operators import cdc, integrity, reads, scd2
from strandline.operators.ordered import running
from strandline.functions.hashing import add_row_hash, rewrite_strings

T0 = datetime(2026, 1, 1)


def events(seed, n):
    """One key holds a third of all rows, over several months."""
    r = random.Random(seed)
    return [(i, None if r.random() < 0.03 else 1 if r.random() < 0.33 else r.randrange(2, 8), None if r.random() < 0.03 else T0 + timedelta(hours=r.randrange(3000)), r.choice([None, *range(9)])) for i in range(n)]


def test_running_against_brute_force(spark):
    rows = events(1, 400)
    df = spark.createDataFrame(rows, "id bigint, k bigint, at timestamp_ntz, v int")
    wanted = {"l": ("last", F.col("v")), "m": ("max", F.col("v")), "s": ("sum", F.col("v")), "r": ("rare", F.when(F.col("v") > 6, F.col("v")))}
    for back in (False, True):
        got = {r["id"]: (r["l"], r["m"], r["s"], r["r"]) for r in running(df, ["k"], "at", [F.col("at"), F.col("id")], wanted, "week", backwards=back).collect()}
        want, by = {}, {}
        for i, k, at, v in sorted((x for x in rows if x[1] is not None and x[2]), key=lambda x: (x[2], x[0]), reverse=back):
            seen = [x for x in by.setdefault(k, []) if x is not None]
            rare = [x for x in seen if x > 6]
            want[i] = (seen[-1] if seen else None, max(seen, default=None), sum(seen), rare[-1] if rare else None)
            by[k].append(v)
        assert got == want
    assert running(df.limit(0), ["k"], "at", [F.col("at")], wanted).count() == 0


def test_a_hot_key_is_in_many_tasks(spark):
    r = random.Random(8)
    rows = [(i, 1 if i % 3 == 0 else r.randrange(2, 300), T0 + timedelta(hours=r.randrange(24 * 730))) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id bigint, k bigint, at timestamp_ntz").repartition(4)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running(df, ["k"], "at", [F.col("at"), F.col("id")], {"n": ("sum", F.lit(1))})
        per = sorted(x["count"] for x in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(per) == len(rows) and per[-1] <= 3 * per[len(per) // 2]


def history(seed, n):
    r = random.Random(seed)
    out = []
    for i in range(n):
        b = None if r.random() < 0.03 else T0 + timedelta(hours=r.randrange(3000))
        e = None if r.random() < 0.2 else (b or T0) + timedelta(hours=r.randrange(-5, 400))
        out.append((i, 1 if r.random() < 0.33 else r.randrange(2, 8), b, e, f"s{i}"))
    return out


HISTORY = "_scd2_key bigint, k bigint, UdmEffectiveDateTime timestamp_ntz, UdmEndDateTime timestamp_ntz, name string"


def test_versions_at_a_time(spark):
    facts, versions = events(2, 300), history(3, 120)
    f = spark.createDataFrame(facts, "id bigint, k bigint, at timestamp_ntz, v int")
    h = spark.createDataFrame(versions, HISTORY)
    valid = {i: [v for v in versions if k is not None and at and v[1] == k and v[2] and v[2] <= at and (v[3] is None or at < v[3])] for i, k, at, _ in facts}
    assert {r["id"]: r["__n"] for r in integrity.versions_at(f, h, "k", "k", "at").collect()} == {i: len(v) for i, v in valid.items()}
    assert {r["id"] for r in integrity.fk_orphans_at(f, h, "k", "k", "at").collect()} == {i for i, k, _, _ in facts if k is not None and not valid[i]}
    assert {(r["id"], r["n"]) for r in integrity.fk_ambiguous(f, h, "k", "k", "at", "id").collect()} == {(i, len(v)) for i, v in valid.items() if len(v) > 1}


def test_as_of_join(spark):
    facts, versions = events(4, 300), history(5, 120)
    far = datetime(9999, 12, 31)
    f = spark.createDataFrame(facts, "id bigint, k bigint, at timestamp_ntz, v int")
    got = {r["id"]: (r["v_UdmEffectiveDateTime"], r["v_UdmEndDateTime"]) for r in reads.as_of_join(f, spark.createDataFrame(versions, HISTORY), "k", "k", "at").collect()}
    want = {}
    for i, k, at, _ in facts:
        begun = [v for v in versions if k is not None and at and v[1] == k and v[2] and v[2] <= at]
        last = max(begun, key=lambda v: (v[2], v[3] or far), default=None)
        want[i] = (last[2], last[3]) if last and at < (last[3] or far) else (None, None)
    assert got == want
    assert reads.as_of_join(f.limit(0), spark.createDataFrame(versions, HISTORY), "k", "k", "at").count() == 0


def test_overlaps_and_gaps_of_a_hot_key(spark):
    versions = [v for v in history(6, 200) if v[2] and (v[3] is None or v[3] >= v[2])]
    h = spark.createDataFrame(versions, HISTORY)
    far = datetime(9999, 12, 31)
    pairs = [(a, b) for a in versions for b in versions if a[0] != b[0] and a[1] == b[1]]
    assert {r["k"] for r in integrity.overlapping(h, ["k"]).collect()} == {a[1] for a, b in pairs if a[2] < (b[3] or far) and b[2] < (a[3] or far)}
    gaps, last = {}, {}
    for v in sorted(versions, key=lambda v: (v[2], v[0])):
        if v[1] in last and (v[2] - last[v[1]]).total_seconds() > 1:
            gaps[v[1]] = gaps.get(v[1], 0) + 1
        last[v[1]] = v[3] or far
    assert {r["k"]: r["gaps"] for r in integrity.version_gaps(h, ["k"]).collect()} == gaps


def test_states_in_chunks(spark):
    r = random.Random(7)
    rows = sorted({(1 if r.random() < 0.4 else 2, T0 + timedelta(days=r.randrange(300))): r.choice(["a", "b", None]) for _ in range(150)}.items())
    df = spark.createDataFrame([(*k, h) for k, h in rows], "k int, at timestamp_ntz, h string")
    got = sorted(((x["k"], x["begin"], x["h"], x["end"], x["active"]) for x in scd2.from_states(df, ["k"], "at", "h").collect()), key=str)
    points = []
    for (k, at), h in rows:
        if not points or points[-1][0] != k or h is None or points[-1][2] != h:
            points.append((k, at, h))
    want = []
    for i, (k, at, h) in enumerate(points):
        nxt = points[i + 1][1] if i + 1 < len(points) and points[i + 1][0] == k else None
        want.append((k, at, h, nxt, int(nxt is None)))
    assert got == sorted(want, key=str)


def test_empty_arrivals_delete_nothing(spark):
    now = add_row_hash(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"))
    assert cdc.classify(now, now.limit(0), ["id"]).count() == 0
    assert cdc.classify(now, now.limit(0), ["id"], may_be_empty=True).where("change = 'D'").count() == 2
    assert cdc.classify_window(now.withColumn("t", F.lit(T0)), now.limit(0).withColumn("t", F.lit(T0)), ["id"], "t", "2026-01-01", "2026-02-01").count() == 0
    bronze = scd2.first_load(now, ["id"], "2026-01-01")
    flags = lambda b: sorted(r["UdmActiveFlag"] for r in b.collect())
    assert flags(scd2.apply(bronze, now.limit(0), ["id"], "2026-02-01")) == [1, 1]
    assert flags(scd2.apply(bronze, now.limit(0), ["id"], "2026-02-01", may_be_empty=True)) == [2, 2]
    holds = cdc.counts_hold(cdc.classify(now, now, ["id"]), now).first()
    assert (holds["arrived"], holds["classified"], holds["holds"]) == (2, 2, True)


def test_tables_of_keys_only(spark):
    now = add_row_hash(spark.createDataFrame([(1,), (2,)], "id bigint"))
    out = scd2.apply(scd2.first_load(now, ["id"], "2026-01-01"), now.where("id = 1"), ["id"], "2026-02-01", begin=F.lit("2026-01-15").cast("timestamp_ntz"))
    assert {r["id"]: r["UdmSourceEndDate"] for r in out.collect()}[2] == datetime(2026, 2, 1)


def test_verifier_and_surrogate(spark):
    now = add_row_hash(spark.createDataFrame([(i, "a") for i in range(30)], "id bigint, v string"))
    bronze = scd2.first_load(now, ["id"], "2026-01-01", surrogate="_scd2_key")
    assert sorted(r["_scd2_key"] for r in bronze.collect()) == list(range(1, 31))
    part = now.where("id < 20").withColumn("_row_hash", F.when(F.col("id") == 3, "x").otherwise(F.col("_row_hash")))

    def broken(_):
        raise RuntimeError("no answer")

    for verifier, strict, gone in ((None, True, 10), (lambda g: None, True, 10), (lambda g: g.where("id >= 25"), True, 5), (broken, True, 0), (broken, False, 10)):
        rows = scd2.apply(bronze, part, ["id"], "2026-02-01", verifier=verifier, strict=strict, surrogate="_scd2_key").collect()
        assert sum(r["UdmActiveFlag"] == 2 for r in rows) == gone
        assert sorted(r["_scd2_key"] for r in rows) == list(range(1, 32))


def test_history_store_rewrites_only_what_it_must(spark):
    now = add_row_hash(spark.createDataFrame([(i, "a") for i in range(40)], "id bigint, v string"))
    store = scd2.HistoryStore(spark, ["id"], 8).write(scd2.first_load(now, ["id"], "2026-01-01"))
    part = add_row_hash(spark.createDataFrame([(5, "b")], "id bigint, v string"))
    new = store.apply_targeted(part, spark.createDataFrame([(5,)], "id bigint").where("id < 0"), "2026-02-01")
    assert sum(new.paths[b] != p for b, p in store.paths.items()) == 1
    same = scd2.apply(store.read(), part, ["id"], "2026-02-01", deleted=now.where("id < 0"))
    rows = lambda df: sorted(map(tuple, df.select(*same.columns).collect()), key=str)
    assert rows(new.read()) == rows(same)


def test_hash_columns_and_stored_strings(spark):
    df = spark.createDataFrame([("e\u0301  ", ""), (None, " x ")], "a string, b string")
    assert [tuple(r) for r in rewrite_strings(df).collect()] == [("é", ""), (None, " x")]
    assert rewrite_strings(df, empty_as_null=True).first()["b"] is None
    with pytest.warns(UserWarning, match="nope"):
        add_row_hash(df, exclude=["nope"])
