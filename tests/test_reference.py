import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from strandline.functions.hashing import add_row_hash
from strandline.functions.times import micros, seconds_between
from strandline.operators import cdc, cleaning, integrity, profiling, reconcile, scd2
from strandline.plans import reference_queries
from strandline.sources import readers, sinks, snapshots


def hashes(spark, rows, schema, **how):
    return [r["_row_hash"] for r in add_row_hash(spark.createDataFrame(rows, schema), **how).collect()]


def test_hash_equalities(spark):
    a = hashes(spark, [(1, "é", 0.0), (1, "é  ", -0.0), (1, "é", -1e-11), (1, " é", 0.0), (1, None, 0.0), (1, "", 0.0)], "a int, b string, c double")
    assert a[0] == a[1] == a[2] and len(set(a[3:])) == 3 and a[0] not in a[3:]
    n = hashes(spark, [(math.nan,), (math.inf,), (-math.inf,), (None,), (1e9,)], "x double")
    assert len(set(n)) == 5
    assert len(set(hashes(spark, [("a", "bc"), ("ab", "c")], "a string, b string"))) == 2
    e = hashes(spark, [("",), (None,), ("  ",)], "a string", empty_as_null=True)
    assert e[0] == e[1] != e[2]
    x = hashes(spark, [(1, 2), (1, 3)], "a int, b int", exclude=["b", "unknown"])
    assert x[0] == x[1] and len(x[0]) == 64
    assert hashes(spark, [(1, bytearray(b"\xab"))], "a int, b binary")[0]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v string, _row_hash string")


def test_classify(spark):
    e = frame(spark, [(1, "a", "h1"), (2, "b", "h2"), (3, "c", "h3"), (99, "z", "h9"), (5, "n", None)])
    f = frame(spark, [(1, "a", "h1"), (2, "B", "x2"), (3, "C", "x3"), (4, "d", "h4"), (5, "n", None)])
    got = {r["id"]: r["change"] for r in cdc.classify(e, f, ["id"]).collect()}
    assert got == {1: "S", 2: "U", 3: "U", 99: "D", 4: "I", 5: "U"}
    c = cdc.change_counts(cdc.classify(e, f, ["id"])).first()
    assert (c["inserts"] + c["updates"] + c["unchanged"], c["deletes"]) == (5, 1)
    assert cdc.snapshot_deletes(e, f.limit(0), ["id"]).count() == 0


def test_verify_deletes(spark):
    ch = spark.createDataFrame([(1, "D"), (2, "D"), (3, "U")], "id bigint, change string")
    source = spark.createDataFrame([(2,)], "id bigint")
    ids = lambda df: {(r["id"], r["change"]) for r in df.collect()}
    assert ids(cdc.verify_deletes(ch, source, ["id"])) == {(1, "D"), (3, "U")}
    assert ids(cdc.verify_deletes(ch, None, ["id"], strict=True)) == {(3, "U")}
    assert ids(cdc.verify_deletes(ch, source, ["id"], limit=1)) == ids(ch)
    assert ids(cdc.verify_deletes(ch, source, ["id"], limit=1, strict=True)) == {(3, "U")}
    assert ids(cdc.verify_deletes(ch, source, ["id"], windowed=True)) == ids(ch)


def test_many_deletes_are_verified_by_default(spark):
    changes = spark.range(10_001).select("id", F.lit("D").alias("change"))
    for strict in (False, True):
        assert cdc.verify_deletes(changes, spark.range(1, 10_001), ["id"], strict=strict).collect() == [(0, "D")]


def test_flapping_key(spark):
    states = [{1: "a", 2: "b"}, {1: "a"}, {1: "a", 2: "b"}, {1: "x", 2: "b"}]
    days = [f"2026-0{i + 1}-01" for i in range(4)]
    bronze = stage = None
    for s, d in zip(states, days, strict=True):
        now = add_row_hash(spark.createDataFrame(sorted(s.items()), "id bigint, v string"))
        if bronze is None:
            bronze, stage = scd2.first_load(now, ["id"], d), cleaning.add_cdc_columns(now, "I", d, 1)
        else:
            bronze, stage = scd2.apply(bronze, now, ["id"], d), cdc.apply_to_stage(stage, now, ["id"], d, 2)
    rows = sorted((r["id"], r["UdmScd2Operation"], r["UdmActiveFlag"], r["v"]) for r in bronze.collect())
    assert rows == [(1, "I", 0, "a"), (1, "U", 1, "x"), (2, "I", 2, "b"), (2, "R", 1, "b")]
    ops = sorted((r["id"], r["_cdc_operation"], r["_cdc_is_current"]) for r in stage.collect())
    assert ops == [(1, "I", 0), (1, "U", 1), (2, "I", 0), (2, "I", 1)]
    end = bronze.where("id = 1 AND UdmActiveFlag = 0").first()["UdmSourceEndDate"]
    assert end == datetime(2026, 3, 31)


def test_targeted_closes_deletes_without_rows(spark):
    now = add_row_hash(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string"))
    bronze = scd2.first_load(now, ["id"], "2026-01-01")
    gone = spark.createDataFrame([(2,)], "id bigint")
    out = scd2.apply(bronze, now.limit(0), ["id"], "2026-02-01", deleted=gone)
    assert {r["id"]: r["UdmActiveFlag"] for r in out.collect()} == {1: 1, 2: 2}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 5), st.sampled_from("ab"), min_size=1, max_size=6), min_size=1, max_size=3))
def test_one_active_version_and_idempotence(spark, loads):
    bronze = None
    for i, s in enumerate([*loads, loads[-1]]):
        now = add_row_hash(spark.createDataFrame(sorted(s.items()), "id bigint, v string"))
        day = f"2026-01-{i + 1:02d}"
        bronze = scd2.first_load(now, ["id"], day) if bronze is None else scd2.apply(bronze, now, ["id"], day)
        rows = bronze.collect()
    active = {r["id"]: r["v"] for r in rows if r["UdmActiveFlag"] == 1}
    assert active == loads[-1] and sum(r["UdmActiveFlag"] == 1 for r in rows) == len(active)
    assert not [r for r in rows if r["UdmEffectiveDateTime"] == datetime(2026, 1, len(loads) + 1)]


def test_business_overlap_with_backward_intervals(spark):
    d = lambda n: datetime(2026, 1, 1 + n)
    import itertools
    import random

    r = random.Random(4)
    rows = [(i, r.randrange(12), d(r.randrange(9)), None if r.random() < 0.1 else d(r.randrange(9))) for i in range(60)]
    df = spark.createDataFrame(rows, "_scd2_key bigint, k bigint, UdmSourceBeginDate timestamp_ntz, UdmSourceEndDate timestamp_ntz")
    got = {x["k"] for x in integrity.business_overlapping(df, ["k"]).collect()}
    want = {a[1] for a, b in itertools.permutations(rows, 2) if a[1] == b[1] and a[3] and b[3] and a[2] < b[3] and b[2] < a[3]}
    assert got == want


def test_order_and_dedup(spark):
    assert cleaning.parse_order("a, b ASC,c desc") == [("a", False), ("b", True), ("c", False)]
    assert cleaning.parse_order(None) == []
    with pytest.raises(ValueError):
        cleaning.parse_order("a sideways")
    df = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (1, 2, "z"), (None, 1, "n")], "k int, a int, b string")
    got = sorted((r["k"] or 0, r["a"], r["b"]) for r in cleaning.dedup_by_order(df, ["k"], "a").collect())
    assert got == [(0, 1, "n"), (1, 2, "z")]


def test_types():
    assert cleaning.common_type([T.BooleanType(), T.IntegerType()]) == T.IntegerType()
    assert cleaning.common_type([T.BooleanType(), T.DoubleType()]) == T.DoubleType()
    assert cleaning.common_type([T.NullType(), T.DateType()]) == T.DateType()
    assert cleaning.common_type([T.TimestampNTZType(), T.TimestampType()]) == T.TimestampType()
    assert cleaning.common_type([T.StringType(), T.LongType()]) == T.StringType()


def test_contract_and_reorder(spark):
    df = spark.createDataFrame([(1, 2)], "a int, _b int")
    assert cleaning.contract(df, ["a", "c"]) == (["c"], [])
    with pytest.raises(ValueError):
        cleaning.reorder(df, ["a", "z"])
    assert cleaning.reorder(df, ["z", "a"], ["z"]).first() == (None, 1)
    with pytest.raises(ValueError):
        cleaning.strict_union([df, df.select("a")])


def test_redact_and_blank(spark):
    df = spark.createDataFrame([("db_password: secret x",), ("passphrase=abc",), ("-----BEGIN RSA PRIVATE KEY-----\nq\n-----END RSA PRIVATE KEY-----",), (None,), ("",)], "t string")
    got = [r[0] for r in df.select(cleaning.redact(F.col("t"))).collect()]
    assert got == ["db_password=*** x", "passphrase=***", "***", None, ""]
    assert [r[0] for r in cleaning.coerce_blank_keys(df.where("t IS NULL OR t = ''"), ["t"]).collect()] == [None, "<BLANK>"]


def test_redaction_of_every_text(spark, tmp_path):
    starts = ["plain", "Тайна", "μυστικό", "سر", "राज़", "ลับ", "秘密", "비밀", "\ufeffbom", "“quoted”", "  spaced", "\n\tlines"]
    rows = [(i, f"{t} rest") for i, t in enumerate(starts)] + [(len(starts), None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["text"] for r in reference_queries.QUERIES["redact_every_text"](spark, str(tmp_path)).collect()}
    assert got == {i: "user_password=*** rest" for i in range(len(starts))} | {len(starts): None}


def test_persons_of_every_number_are_candidates(spark, tmp_path):
    rows = [(p, flag, datetime(2025, 6, 1)) for p in range(1, 31) for flag in (1, 2)] + [(None, 1, None), (None, 2, None)]
    spark.createDataFrame(rows, "persnbr bigint, UdmActiveFlag tinyint, UdmSourceBeginDate timestamp_ntz").write.parquet(str(tmp_path / "pers_bronze.parquet"))
    run = lambda name: reference_queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(r["persnbr"] for r in run("deleted_of_all_keys")) == list(range(1, 31))
    assert [tuple(r) for r in run("retention_age_of_all")] == [(30, 0, 0, 214, 214)]


@pytest.mark.parametrize(
    ("fresh", "base", "over", "want"),
    [(5, 100, None, "BLOCK_DROP"), (10, 100, None, "WARN"), (49, 100, None, "WARN"), (50, 100, None, "OK"), (500, 100, None, "OK"), (501, 100, None, "BLOCK_GROWTH"), (501, 100, 900, "OK"), (7, None, None, "OK"), (11, 0, 10, "BLOCK_CEILING"), (200_000_000, None, None, "BLOCK_CEILING")],
)
def test_guard(spark, fresh, base, over, want):
    df = spark.createDataFrame([(fresh, base, over)], "f bigint, b bigint, o bigint")
    assert df.select(profiling.guard(F.col("f"), F.col("b"), F.col("o"))).first()[0] == want


def test_verdicts(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (100, 101), (100, 99), (100, 96), (100, 90)], "p bigint, b bigint")
    assert [r[0] for r in df.select(reconcile.count_verdict(F.col("p"), F.col("b"))).collect()] == ["CLEAN", "MAJOR_DRIFT", "MAJOR_DRIFT", "CLEAN", "DRIFT", "MAJOR_DRIFT"]
    assert df.select(reconcile.worst(F.lit("DRIFT"), F.lit("FATAL"))).first()[0] == "FATAL"


def test_times(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 0, 0, 0, 900_000), datetime(2026, 1, 1, 0, 0, 1, 100_000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 1
    old = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 999_999),)], "a timestamp_ntz")
    assert old.select(micros(F.col("a"))).first()[0] == -1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(0, 50), min_size=1, max_size=30))
def test_percentiles_are_monotone(spark, values):
    r = profiling.lateness(spark.createDataFrame([(1, v) for v in values], "k int, d double"), ["k"], "d").first()
    assert r["p50"] <= r["p90"] <= r["p95"] <= r["p99"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, v string")
    df.coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    (tmp_path / "skip.txt").write_text("junk\nid;v\n1;x\n2;y\n")
    df.write.json(str(tmp_path / "j"))
    (tmp_path / "one.json").write_text('[{"id": 1, "v": "a"},\n {"id": 2, "v": null}]')
    schema = df.schema
    assert sorted(r["id"] for r in readers.read(spark, readers.FileSource(str(tmp_path / "c"), "csv", schema=schema)).collect()) == [1, 2]
    got = readers.read(spark, readers.FileSource(str(tmp_path / "skip.t*"), "txt", separator=";", skip_rows=1, rename={"v": "w"}, select=("w",)))
    assert [r["w"] for r in got.collect()] == ["x", "y"]
    assert readers.read(spark, readers.FileSource(str(tmp_path / "j"), "ndjson", schema=schema)).count() == 2
    assert readers.read(spark, readers.FileSource(str(tmp_path / "one.json"), "json", schema=schema)).count() == 2
    with pytest.raises(FileNotFoundError):
        readers.newest(spark, str(tmp_path / "none*"))
    with pytest.raises(ValueError):
        readers.validate(df, least=3)
    with pytest.raises(ValueError):
        readers.validate(df, keys=["nope"])


def test_database_query_and_retry():
    src = readers.DatabaseSource("jdbc:x", "s.t", ("a", "b", "c"), exclude=("b",), as_text=("c",))
    assert readers.query(src, "a > 1") == "SELECT a, CAST(c AS CLOB) AS c FROM s.t WHERE a > 1"
    assert readers.text_type("jdbc:sqlserver://h") == "NVARCHAR(MAX)"
    with pytest.raises(ValueError):
        readers.query(readers.DatabaseSource("jdbc:x", "s.t", exclude=("b",)))
    assert readers.day_predicates("d", [], nulls=True) == ["d IS NULL"]
    # A sign that an error may pass outweighs one that it won't.
    assert readers.is_permanent("ORA-01031: insufficient privileges") and not readers.is_permanent("login failed: connection reset")
    assert readers.day_predicates("d", [date(2026, 1, 31)]) == ["d >= {ts '2026-01-31 00:00:00'} AND d < {ts '2026-02-01 00:00:00'}"]
    calls, waits = [], []

    def fails(message, times):
        def action():
            calls.append(1)
            if len(calls) <= times:
                raise RuntimeError(message)
            return "done"

        return action

    assert readers.with_retry(fails("connection reset", 2), sleep=waits.append) == "done" and waits == [2.0, 4.0]
    calls.clear()
    with pytest.raises(RuntimeError):
        readers.with_retry(fails("ORA-00942: no table", 1), sleep=waits.append)
    assert len(calls) == 1


def test_snapshot(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    snap = snapshots.Snapshot(str(tmp_path), "DNA", "ACCT", date(2026, 1, 5), 7)
    row = snapshots.write_snapshot(df.repartition(3), snap).first()
    assert (row["RowCount"], row["Status"]) == (100, "created") and "year=2026/month=01/day=05" in row["Path"]
    assert snapshots.replay(spark, snap).count() == 100
    with pytest.raises(Exception):
        snapshots.write_snapshot(df, snap)
    victim = next((tmp_path).rglob("part-*.parquet"))
    for crc in tmp_path.rglob(".*.crc"):
        crc.unlink()
    victim.write_bytes(victim.read_bytes() + b"x")
    with pytest.raises(snapshots.SnapshotDamaged):
        snapshots.replay(spark, snap)


def test_bulk_file_and_reload(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb\n", True, datetime(2026, 1, 1, 1, 2, 3, 456_789)), (2, None, None, None)], "id int, v string, ok boolean, at timestamp_ntz")
    sinks.write_bulk(df.coalesce(1), str(tmp_path / "b"))
    text = next((tmp_path / "b").glob("part-*")).read_text()
    assert text.splitlines() == ["1\tab\t1\t2026-01-01 01:02:03.456", "2\t\t\t"]
    sinks.reload(df.withColumn("_x", F.lit(1)), str(tmp_path / "r"))
    sinks.reload(df.limit(1), str(tmp_path / "r"))
    out = spark.read.parquet(str(tmp_path / "r"))
    assert out.columns == ["id", "v", "ok", "at"] and out.count() == 1


def test_stream(spark, tmp_path):
    from strandline.operators.apply_changes import ACCOUNT_FEED, ChangeTable, read_table
    from strandline.streaming.feed import LiveTable, late_counts

    schema = "change_id bigint, acctnbr bigint, _cdc_operation string, _cdc_valid_from timestamp_ntz, _cdc_batch_id bigint"
    t = datetime(2026, 1, 1)
    for i, rows in enumerate([[(1, 1, "I", t, 1), (2, 2, "I", t, 1)], [(3, 2, "D", t.replace(day=3), 2), (4, 1, "U", t.replace(day=2), 2)], [(5, 2, "U", t.replace(day=2), 3), (4, 1, "U", t.replace(day=2), 2)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b{i}"))
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    live = LiveTable(spark, ChangeTable(ACCOUNT_FEED))
    live.follow(feed, str(tmp_path / "cp")).awaitTermination()
    assert [(r["acctnbr"], r["change_id"]) for r in read_table(spark, live.table).collect()] == [(1, 4)]
    # Started again, the stream goes on with the table as it was.
    spark.createDataFrame([(6, 3, "I", t, 4)], schema).coalesce(1).write.parquet(str(tmp_path / "in/b3"))
    live = LiveTable(spark, ChangeTable(ACCOUNT_FEED))
    live.follow(feed, str(tmp_path / "cp")).awaitTermination()
    assert sorted((r["acctnbr"], r["change_id"]) for r in read_table(spark, live.table).collect()) == [(1, 4), (3, 6)]
    before = live.table
    live.take(spark.createDataFrame([(7, 4, "I", t, 4)], schema), live.batch)
    assert live.table == before

    spark.createDataFrame([(t, "a"), (t, "a"), (t.replace(hour=9), "b")], "ts timestamp, kind string").write.parquet(str(tmp_path / "ev"))
    ev = spark.readStream.schema("ts timestamp, kind string").parquet(str(tmp_path / "ev"))
    q = late_counts(ev, "ts", "kind").writeStream.format("memory").queryName("late").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["kind"], r["n"]) for r in spark.sql("SELECT * FROM late").collect()) == [("a", 2), ("b", 1)]
