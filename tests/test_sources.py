import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from strandline.sources import readers, sinks, snapshots

URL = "jdbc:derby:memory:strandline;create=true"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1", "utf-16"])
def test_rows_before_and_after_the_header(spark, tmp_path, encoding):
    text = "Report \"of\" day\n\nmade by é\nid;na\"me;\"a;b\"\nunits;;x\n-;-;-\n1;\"two\nlines; é\";x\n\n2;\"say \"\"hi\"\"\";\n"
    text = text.replace('na"me', "name")
    (tmp_path / "d").mkdir()
    for n in "ab":
        (tmp_path / f"d/{n}.csv").write_bytes(text.encode(encoding))
    source = readers.FileSource(str(tmp_path / "d"), "csv", ";", encoding, skip_rows=3, skip_after=2)
    df = readers.read(spark, source)
    assert df.columns == ["id", "name", "a;b"]
    assert sorted(tuple(r) for r in df.collect()) == sorted([("1", "two\nlines; é", "x"), ("2", 'say "hi"', None)] * 2)
    kinds = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("w", T.StringType())])
    typed = readers.read(spark, readers.FileSource(str(tmp_path / "d/a.csv"), "csv", ";", encoding, skip_rows=3, skip_after=2, schema=kinds))
    assert sorted(r["id"] for r in typed.collect()) == [1, 2]
    plain = readers.read(spark, readers.FileSource(str(tmp_path / "d/a.csv"), "txt", ";", encoding, header=False, skip_rows=3, skip_after=2))
    assert plain.columns == ["_c0", "_c1", "_c2"] and plain.count() == 3
    assert readers.exists(spark, str(tmp_path / "d")) and not readers.exists(spark, str(tmp_path / "none"))


def test_empty_file_with_skipped_rows(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    assert readers.read(spark, readers.FileSource(str(tmp_path / "e.csv"), "csv", skip_rows=2)).count() == 0


def test_database(spark):
    rows = [(i, f"n{i}", None if i % 7 == 0 else datetime(2026, 1, 1 + i % 5, 3), "x" * 5000) for i in range(40)]
    df = spark.createDataFrame(rows, "ID int, NAME string, WHENAT timestamp_ntz, NOTE string")
    sinks.write_database(df, URL, "T", "overwrite", 7, 3, DRIVER)
    source = readers.DatabaseSource(URL, "T", driver=DRIVER)
    whole = {r["ID"] for r in readers.read(spark, source).collect()}
    assert whole == set(range(40))
    split = readers.read_database(spark, source, split_by="ID", parts=4)
    assert split.rdd.getNumPartitions() == 4 and {r["ID"] for r in split.collect()} == whole
    # Rows without a value of the column that splits are read too.
    assert readers.read_database(spark, source, split_by="WHENAT", parts=3).count() == 40
    part = readers.read_database(spark, readers.DatabaseSource(URL, "T", exclude=("WHENAT",), as_text=("NOTE",), driver=DRIVER), "ID < 3")
    assert part.columns == ["ID", "NAME", "NOTE"] and {len(r["NOTE"]) for r in part.collect()} == {5000}
    assert readers.bounds(spark, source, "ID", "ID > 5") == (6, 39)
    days = readers.days_with_rows(spark, source, "WHENAT", date(2026, 1, 1), date(2026, 1, 3))
    assert days == [date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)]
    by_day = readers.read_days(spark, source, "WHENAT", [date(2026, 1, d) for d in range(1, 6)])
    assert by_day.rdd.getNumPartitions() == 6 and {r["ID"] for r in by_day.collect()} == whole
    assert readers.read_days(spark, source, "WHENAT", days, nulls=False).where("WHENAT IS NULL").count() == 0


def test_far_dates_of_a_database(spark):
    df = spark.createDataFrame([(1, date(9999, 12, 31)), (2, date(2026, 1, 1)), (3, None)], "ID int, DAY_OF date")
    sinks.write_database(df, URL, "FAR", "overwrite", driver=DRIVER)
    got = readers.read_database(spark, readers.DatabaseSource(URL, "FAR", driver=DRIVER), far_dates=["DAY_OF"]).collect()
    assert {r["ID"]: r["DAY_OF"] for r in got} == {1: None, 2: date(2026, 1, 1), 3: None}


def test_counts_and_workbooks(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "t"))
    assert readers.row_count(spark, str(tmp_path / "t")) == 7
    pytest.importorskip("pandas")
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        with zipfile.ZipFile(tmp_path / "w.xlsx", "w") as z:
            z.writestr("xl/workbook.xml", "")
        with pytest.raises(RuntimeError, match="openpyxl"):
            readers.read(spark, readers.FileSource(str(tmp_path / "w.xlsx"), "xlsx"))
    else:
        spark.range(3).toPandas().to_excel(tmp_path / "w.xlsx", index=False)
        assert readers.read(spark, readers.FileSource(str(tmp_path / "w.xlsx"), "xlsx")).count() == 3


def test_registry(spark):
    day = date(2026, 1, 5)
    rows = [("S", "T", day, i, f"p{i}", 10, f"h{i}", s) for i, s in enumerate(["created", "created", "created", "verified", "purged", None])]
    reg = spark.createDataFrame(rows, "SourceName string, TableName string, BusinessDate date, BatchId bigint, Path string, RowCount bigint, Sha256 string, Status string")
    found = spark.createDataFrame([("p0", "h0", 10), ("p1", "other", 10), ("p3", "h3", 10)], "Path string, Sha256 string, Rows bigint")
    out = snapshots.mark_verified(reg, found)
    assert {r["BatchId"]: (r["verdict"], r["Status"]) for r in out.collect()} == {
        0: ("verified", "verified"), 1: ("hash_mismatch", "created"), 2: ("missing", "created"), 3: ("skipped", "verified"), 4: ("status_invalid", "purged"), 5: ("status_invalid", None),
    }
    assert {r["verdict"]: r["n"] for r in snapshots.verdict_counts(out).collect()} == {"verified": 1, "hash_mismatch": 1, "missing": 1, "skipped": 1, "status_invalid": 2, "failed": 4}
    assert snapshots.lookup(reg, "S", "T", "2026-01-05", 3).first()["Path"] == "p3"
    assert {r["verdict"]: r["n"] for r in snapshots.verdict_counts(out.limit(0)).collect()} == {"failed": 0}
