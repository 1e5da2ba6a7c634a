from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strandline.operators import cleaning, control, profiling, reconcile
from strandline.sources import sinks

T = datetime(2026, 1, 1)
EVENT = "EventLogId bigint, StartedAt timestamp_ntz, CompletedAt timestamp_ntz, Status string, ErrorMessage string, RowsProcessed bigint, ms string"


def test_events(spark):
    s = timedelta(seconds=1)
    rows = [(1, T, T + 2 * s, "IN_PROGRESS", None, 3, "x"), (2, T, T, "odd", None, 5, "x"), (3, T, None, None, "e" * 5000, None, "x"), (4, T, T + 8 * s, "SKIPPED", None, 1, "x"), (5, None, None, "FAILED", None, 0, "x")]
    got = {r["EventLogId"]: (r["Status"], r["DurationMs"], r["RowsPerSecond"], len(r["ErrorMessage"] or "")) for r in control.finish_events(spark.createDataFrame(rows, EVENT)).collect()}
    assert got == {1: ("SUCCESS", 2000, 1.5, 0), 2: ("SUCCESS", 0, 0.0, 0), 3: ("FAILED", None, 0.0, 4000), 4: ("SKIPPED", 8000, 0.13, 0), 5: ("FAILED", None, 0.0, 0)}


def test_attempts(spark):
    log = spark.createDataFrame([("a", T, 1, 1), ("a", T, 2, 2), (None, T, 3, 7)], "k string, at timestamp_ntz, id int, Attempt int")
    fresh = spark.createDataFrame([("a", T + timedelta(2), 5), ("a", T + timedelta(1), 6), ("b", None, 7), (None, T, 8)], "k string, at timestamp_ntz, id int")
    got = {r["id"]: r["Attempt"] for r in control.record_attempts(log, fresh, ["k"], "at", "id").collect()}
    assert got == {1: 1, 2: 2, 3: 7, 6: 3, 5: 4, 7: 1, 8: 1}
    bad = spark.createDataFrame([(1, "T", "S", date(2026, 1, 1), "SUCCESS"), (0, "T", "S", date(2026, 1, 1), "SUCCESS"), (1, "", "S", date(2026, 1, 1), "FAILED"), (1, "T", None, None, None)], "BatchId bigint, TableName string, SourceName string, CycleDate date, Status string")
    assert control.bad_attempts(bad).count() == 3


LEDGER = "k int, EventType string, Status string, StartedAt timestamp_ntz, CompletedAt timestamp_ntz, ErrorMessage string"


def test_ledger(spark):
    g = spark.createDataFrame(
        [(1, "E", "COMPLETED", T, T, None), (2, "E", "IN_PROGRESS", T, None, None), (3, "E", "FAILED", T, T, "x"), (4, "E", "odd", T, None, None), (5, "OLD", "IN_PROGRESS", T, None, None), (6, "E", "IN_PROGRESS", None, None, None)], LEDGER
    )
    wanted = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9, 9)], "k int")
    assert {r["k"]: r["decision"] for r in control.ledger_gate(g, wanted, ["k"]).collect()} == {1: "SKIP", 2: "BUSY", 3: "RETRY", 4: "UNKNOWN", 9: "RUN"}
    swept = {r["k"]: (r["Status"], r["RecoveryAction"]) for r in control.ledger_sweep(g, "2026-01-02", spare=["OLD"]).collect()}
    assert swept == {1: ("COMPLETED", None), 2: ("FAILED", "SWEPT"), 3: ("FAILED", None), 4: ("odd", None), 5: ("IN_PROGRESS", None), 6: ("IN_PROGRESS", None)}
    with pytest.raises(RuntimeError):
        control.ledger_sweep(g, "2026-01-02", most=1)
    done = spark.createDataFrame([(2, "COMPLETED", T, None), (2, "FAILED", T - timedelta(1), "e"), (8, "FAILED", T, "e")], "k int, Status string, CompletedAt timestamp_ntz, ErrorMessage string")
    after = {r["k"]: (r["Status"], r["ErrorMessage"]) for r in control.ledger_finish(g, done, ["k"]).collect()}
    assert after[2] == ("COMPLETED", None) and after[8] == ("FAILED", "e") and after[3] == ("FAILED", "x") and len(after) == 7


def test_configuration(spark):
    columns = spark.createDataFrame([("S", "T", c) for c in ("a", "b", "c", "a")] + [("R", "U", "z"), ("R", "U", None)], "SourceName string, TableName string, ColumnName string")
    profiles = spark.createDataFrame([("S", "F", "c", 1, 2), ("S", "F", "a", 2, 2), ("S", "F", "b", 3, 2), ("*", "F", "z", 1, 1), ("*", "F", "b", 1, 1)], "SourceName string, FieldName string, ColumnName string, Priority int, Most int")
    assert sorted(tuple(r) for r in control.propose_config(columns, profiles).collect()) == [("R", "U", "F", "z"), ("S", "T", "F", "c,a")]
    assert control.propose_config(columns.limit(0), profiles).count() == 0
    config = spark.createDataFrame([("S", "T", "old", "old"), ("S", "V", "old", None)], "SourceName string, TableName string, F string, G string")
    P = "ProposalId bigint, SourceName string, TableName string, FieldName string, ProposedValue string, Status string, AppliedAt timestamp_ntz"
    props = spark.createDataFrame([(1, "S", "T", "F", "x", "APPROVED", None), (2, "S", "T", "F", None, "APPROVED", None), (3, "S", "T", "G", "y", "REJECTED", None), (4, "S", "V", "G", "z", "APPROVED", T)], P)
    after, marked = control.apply_approved(config, props, ["F", "G"], "2026-02-01")
    assert sorted((tuple(r) for r in after.collect()), key=str) == [("S", "T", None, "old"), ("S", "V", "old", None)]
    assert {r["ProposalId"] for r in marked.where("AppliedAt = TIMESTAMP_NTZ '2026-02-01'").collect()} == {1, 2}


def test_config_entries(spark):
    df = spark.createDataFrame([(1, '{"a": "b", "n": 1, "x": null}'), (2, '["p", "q"]'), (3, "[]"), (4, "{}"), (5, "no"), (6, None), (7, " {broken")], "k int, c string")
    got = sorted(tuple(r) for r in control.config_entries(df, ["k"], "c").na.fill("-").collect())
    assert got == [(1, "a", "b"), (1, "n", "1"), (1, "x", "-"), (2, "0", "p"), (2, "1", "q")]


def test_type_drift(spark):
    kind = "table_name string, column_name string, value_type string"
    a = spark.createDataFrame([("t", c, v) for c, v in (("a", "decimal(12,2)"), ("b", "decimal(12,2)"), ("c", "string(5)"), ("d", "date"), ("e", "date"), ("f", "bigint"), ("g", "string"))], kind)
    b = spark.createDataFrame([("t", c, v) for c, v in (("a", "decimal(14,4)"), ("b", "decimal(14,6)"), ("c", "STRING(5)"), ("d", "timestamp"), ("f", "bigint"), ("g", "string(9)"), ("h", "flag"))], kind)
    assert {r["column_name"]: r["drift"] for r in control.type_drift(a, b).collect()} == {"a": "WIDENED", "b": "NARROWED", "d": "RETYPED", "e": "REMOVED", "g": "WIDENED", "h": "ADDED"}


def test_stored_results(spark, tmp_path):
    found = spark.createDataFrame([(0, None, None), (3, None, None), (3, "boom", 1)], "MismatchedRows int, err string, note int")
    rows = control.result_rows(found, "C", "T", "S", "2026-01-01", F.col("MismatchedRows") == 0, F.col("err"), ["note"])
    assert sorted((r["MismatchedRows"], r["Status"], r["SourceRows"], r["Metadata"]) for r in rows.collect()) == [(0, "PASSED", 0, "{}"), (3, "ERROR", 0, '{"note":1}'), (3, "FAILED", 0, "{}")]
    for _ in range(2):
        sinks.append(rows, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 6
    with pytest.raises(ValueError):
        sinks.append(rows.drop("Errors"), str(tmp_path / "log"))


def test_retention_and_inventory(spark):
    v = spark.createDataFrame([("a", T, 0, "active"), ("b", T, 1, "active"), ("c", T, 0, "purged"), ("d", None, 0, "active"), ("e", T, None, "active")], "Token string, RetentionExpiresAt timestamp_ntz, LegalHold int, Status string")
    p = spark.createDataFrame([("a",), ("a",), ("b",), ("z",), (None,)], "Token string")
    assert {r["measure"]: r["n"] for r in control.retention_preview(v, p, "2026-02-01").collect()} == {"would_purge": 2, "held": 1, "provenance_follows": 2, "provenance_without_token": 2}
    config = spark.createDataFrame([("S", "A", None, None), ("S", "B", "x", "PII")], "SourceName string, TableName string, PiiColumnList string, DataClassification string")
    inv = spark.createDataFrame([("S", "A", " y ", "PCI"), ("S", "B", "x", "PII"), ("S", "B", "x", "odd"), ("S", "C", None, "NONE")], config.schema)
    got = sorted((r["TableName"], r["verdict"], r["PiiColumnList"]) for r in control.import_inventory(config, inv).na.fill("-").collect())
    assert got == [("A", "UPDATED", "y"), ("B", "BAD_CLASS", "x"), ("B", "UNCHANGED", "x"), ("C", "UNKNOWN_TABLE", "-")]


def test_lateness_alarm(spark):
    p = spark.createDataFrame([("a", 2.0), ("b", 2.0), ("c", 2.0), (None, 3.0)], "k string, p99 double")
    before = spark.createDataFrame([("a", 3.0), ("b", 0.0), (None, 2.9)], "k string, p99 double")
    got = {r["k"]: (r["RecommendedLookback"], r["alarm"]) for r in control.lateness_report(p, before, ["k"]).collect()}
    assert got == {"a": (3, True), "b": (3, False), "c": (3, False), None: (5, False)}


RUNS = "k string, day date, Status string"


def test_days(spark):
    d = lambda n: date(2026, 1, n)
    runs = spark.createDataFrame([("a", d(3), "SUCCESS"), ("a", d(5), "FAILED_EXTRACT"), ("a", d(6), "FAILED"), ("a", d(6), "SUCCESS"), ("b", d(2), "FAILED"), ("c", None, "FAILED"), ("a", d(7), None)], RUNS)
    assert sorted((r["k"], r["day"].day) for r in control.failed_days(runs, ["k"], "day").collect()) == [("a", 5), ("b", 2)]
    got = sorted((r["k"], r["day"].day, r["late"]) for r in control.days_to_process(runs, ["k"], "day", "2026-01-10", 2).collect())
    assert got == [("a", 7, True), ("a", 8, True), ("a", 9, True), *[(k, n, False) for k in "bc" for n in (7, 8, 9)]]
    assert {r["day"].day for r in control.days_to_process(runs, ["k"], "day", "2026-01-10", 2, "2026-01-04").where("k = 'b'").collect()} == set(range(4, 10))
    assert control.days_to_process(runs.limit(0), ["k"], "day", "2026-01-10", 2).count() == 0


def test_small_measures(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b"), (2, "b")], "k int, v string")
    assert sorted(r[0] for r in df.select(cleaning.key_literal(["k", "v"])).collect()) == ["1|", "1|a", "2|b", "|b"]
    assert cleaning.union_of_keys([df, df], ["k"]).count() == 3
    assert {r["column_name"]: r["is_key"] for r in profiling.candidate_keys(df.select("v", "k", F.expr("uuid()").alias("u")).where("v IS NOT NULL"), ["v", "k", "u"]).collect()} == {"v": False, "k": False, "u": True}
    assert {r["is_key"] for r in profiling.candidate_keys(df.limit(0), ["k", "v"]).collect()} == {True}
    assert reconcile.sample_n(df, ["k", "v"], 2).collect() == reconcile.sample_n(df.repartition(3), ["k", "v"], 2).collect()
    logs = spark.createDataFrame([("FAILED", T), ("SUCCESS", T), (None, None)], "Status string, at timestamp_ntz")
    assert control.purge_logs(logs, "at", "2026-02-01", {"FAILED": 60}, 10).count() == 2
    have = spark.createDataFrame([("T", "ID"), ("U", None)], "table_name string, column_name string")
    want = spark.createDataFrame([("T", "id"), ("T", "no"), ("U", "id")], "table_name string, column_name string")
    assert {tuple(r) for r in control.missing_keys(want, have).collect()} == {("T", "no"), ("U", "id")}
