import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st

from strandline.operators import reject_records as rr

LAYOUT = [("T", 1, "id", "bigint", False, ","), ("T", 2, "name", "string(5)", False, ","), ("T", 3, "at", "timestamp", True, ","), ("T", 4, "amount", "decimal(5,2)", True, ","), ("T", 5, "ok", "flag", True, ","), ("T", 6, "day", "date", True, ",")]
LAYOUT_SCHEMA = "table_name string, ordinal int, column_name string, value_type string, nullable boolean, delimiter string"
L = rr.Layout([(c[2], c[3], c[4]) for c in LAYOUT], ",")


@pytest.mark.parametrize(
    ("record", "want"),
    [
        ("1,ab,,,,", (None, "")),
        ("1,ab,,,,\r\n", (None, "")),
        ("1,ab,,,,\n\n", ("VALUE", "day")),
        ('1,"a,""b",,,Y,2024-02-29', (None, "")),
        ('1,"a\nb",,,,', (None, "")),
        ("1,a\nb,,,,", (None, "")),
        ('1,"",,,,', (None, "")),
        ("1,,,,,", ("VALUE", "name")),
        ('"",ab,,,,', ("VALUE", "id")),
        ('1,ab,"",,,', ("VALUE", "at")),
        ('1,a"b,,,,', ("QUOTING", "")),
        ('1, "ab",,,,', ("QUOTING", "")),
        ('1,"ab" ,,,,', ("QUOTING", "")),
        ('1,"ab,,,,', ("QUOTING", "")),
        ('1,"a"b",,,', ("QUOTING", "")),
        ("1,ab,,,", ("COLUMN_COUNT", "")),
        ("1,ab,,,,,", ("COLUMN_COUNT", "")),
        ("", ("COLUMN_COUNT", "")),
        (None, ("COLUMN_COUNT", "")),
        ("1,abcdef,,,,", ("VALUE", "name")),
        ("1,ábcd,,,,", (None, "")),
        ("1234567890123456789,ab,,,,", ("VALUE", "id")),
        ("+1,ab,,,,", ("VALUE", "id")),
        ("١,ab,,,,", ("VALUE", "id")),
        ("1,ab,2024-01-01 23:59:59.123,,,", (None, "")),
        ("1,ab,2024-01-01 24:00:00,,,", ("VALUE", "at")),
        ("1,ab,2024-01-01T00:00:00,,,", ("VALUE", "at")),
        ("1,ab,,-123.45,,", (None, "")),
        ("1,ab,,1234.5,,", ("VALUE", "amount")),
        ("1,ab,,1.,,", ("VALUE", "amount")),
        ("1,ab,,.5,,", ("VALUE", "amount")),
        ("1,ab,,1.234,,", ("VALUE", "amount")),
        ("1,ab,,,y,", ("VALUE", "ok")),
        ("1,ab,,,,2023-02-29", ("VALUE", "day")),
        ("1,ab,,,,0000-01-01", ("VALUE", "day")),
        ("1,ab,,,,0001-01-01", (None, "")),
        ("x,a\"b,", ("QUOTING", "")),
    ],
)
def test_judge(record, want):
    assert rr.judge(record, L)[:2] == want


def scan(record, delimiter):
    """Fields by a scanner written from the rules, None if the quotes are broken."""
    record = rr.assemble(record)
    out, i, n = [], 0, len(record)
    while True:
        if i < n and record[i] == '"':
            j, value = i + 1, ""
            while True:
                if j >= n:
                    return None
                if record[j] == '"':
                    if j + 1 < n and record[j + 1] == '"':
                        value += '"'
                        j += 2
                        continue
                    break
                value += record[j]
                j += 1
            j += 1
            if j < n and record[j] != delimiter:
                return None
            out.append(value)
        else:
            j = record.find(delimiter, i)
            j = n if j < 0 else j
            if '"' in record[i:j]:
                return None
            out.append(record[i:j] or None)
        if j >= n:
            return out
        i = j + 1


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet='",a\n\r\t;\x1c\x1d', max_size=12), st.sampled_from([",", ";", "\t", "|"]))
def test_fields_agree_with_a_scanner(record, delimiter):
    layout = rr.Layout([("a", "string", True)], delimiter)
    want = scan(record, delimiter)
    try:
        got = rr.fields_of(rr.assemble(record), layout)
    except rr.csv.Error:
        got = None
    assert got == want


def test_tables(spark):
    layout = spark.createDataFrame(LAYOUT, LAYOUT_SCHEMA)
    big = "1," + '"' + "x" * 300_000 + '"' + ",,,,"
    rows = [(1, "T", "7,ab,2024-01-01 10:00:00.5,,,"), (2, "T", '7,"a",2024-01-01 10:00:00.500,-1.50,N,2024-01-31\r'), (3, "T", None), (4, None, "7"), (5, "U", '"'), (6, "T", big), (7, "T", "7,ab,,,,")]
    df = spark.createDataFrame([(*r, "odd") for r in rows], "QuarantineId bigint, TableName string, RecordData string, reason string")
    got = {r[0]: (r[1], r[2]) for r in rr.rejected(df, layout).collect()}
    assert got == {1: ("VALUE", "at"), 3: ("COLUMN_COUNT", ""), 4: ("COLUMN_COUNT", ""), 5: ("QUOTING", ""), 6: ("VALUE", "name")}
    typed = {r["QuarantineId"]: r for r in rr.typed_rows(df, layout, "T").collect()}
    assert set(typed) == {2, 7}
    r = typed[2]
    assert (r["id"], r["name"], r["at"], r["amount"], r["ok"], r["day"]) == (7, "a", dt.datetime(2024, 1, 1, 10, 0, 0, 500_000), Decimal("-1.50"), False, dt.date(2024, 1, 31))
    assert rr.rejected(df.limit(0), layout).count() == 0
