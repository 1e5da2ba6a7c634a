"""Rows that fail to parse: the strict csv reader per record, then typed constructors.

Each record is one string that may hold quoted delimiters and line breaks; :mod:`assemble_records` makes
such records of a file's lines.  In every partition the records go through Python's strict ``csv`` reader, whose exceptions are the structural failures; the
fields of what survives go to a constructor per column, and the first that refuses is the value
failure.  Records without a fault come out with their fields, which :func:`typed_rows` turns into
columns of the layout's types inside the JVM.  It is one narrow stage: no shuffle, no state.

Reasons, the first that holds: 'QUOTING', 'COLUMN_COUNT', 'VALUE'.

Defined results
- One line end (CR, LF or CRLF) at the very end isn't part of a record; other line breaks are
  ordinary characters, inside quotes or not.
- A null record has no fields, an empty one has one empty field: both are 'COLUMN_COUNT' (an empty
  record is loaded where the layout has one nullable column).
- A record of a table that the layout doesn't have, or of no table, is 'COLUMN_COUNT' unless its
  quotes are broken.
- An empty field without quotes is null; anything else is checked, '""' included.
- Records and fields may be of any length.  An empty table gives no rows.
"""

from __future__ import annotations

import csv
import datetime as dt
import re
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_BIGINT = re.compile(r"-?[0-9]{1,18}")
_DATE = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2})")
_TIME = re.compile(r"([0-9]{4}-[0-9]{2}-[0-9]{2}) ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{3})?")
#: Characters that stand for line breaks inside the reader, which would take them for record ends.
_STAND_INS = "\x1c\x1d\x1e\x1f\x01\x02\x03\x04\x05\x06"


def _date(text: str) -> None:
    m = _DATE.fullmatch(text)
    if not m:
        raise ValueError(text)
    dt.date(int(m[1]), int(m[2]), int(m[3]))


def _timestamp(text: str) -> None:
    m = _TIME.fullmatch(text)
    if not m:
        raise ValueError(text)
    _date(m[1])


def _matching(pattern: str) -> Callable[[str], None]:
    whole = re.compile(pattern).fullmatch

    def build(text: str) -> None:
        if not whole(text):
            raise ValueError(text)

    return build


def constructor(value_type: str) -> Callable[[str], None]:
    """The function that raises ValueError for a text that is no value of the layout's type."""
    m = re.fullmatch(r"\s*(\w+)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*", value_type.lower())
    if not m:
        raise ValueError(f"unknown type {value_type!r}")
    kind, p, s = m[1], int(m[2] or 0), int(m[3] or 0)
    if kind == "string":

        def text(x: str) -> None:
            if p and len(x) > p:
                raise ValueError("too long")

        return text
    if kind == "decimal":
        # p = s leaves no digit before the point, but a number needs one.
        fraction = rf"(?:\.[0-9]{{1,{s}}})?" if s else ""
        return _matching(rf"-?[0-9]{{1,{max(p - s, 1)}}}{fraction}")
    if kind == "bigint":
        return _matching(_BIGINT.pattern)
    if kind == "date":
        return _date
    if kind == "timestamp":
        return _timestamp
    if kind == "flag":
        return _matching("[YN]")
    raise ValueError(f"unknown type {value_type!r}")


class Layout:
    """Delimiter and columns of one file."""

    def __init__(self, columns: list[tuple[str, str, bool]], delimiter: str) -> None:
        self.columns = [(name, constructor(kind), bool(nullable)) for name, kind, nullable in columns]
        self.delimiter = delimiter
        d = re.escape(delimiter)
        self.quoted = re.compile(rf'(?:(?<={d})|\A)"(?:[^"]|"")*"(?={d}|\Z)')
        self.dialect = {"delimiter": delimiter, "strict": True, "quoting": csv.QUOTE_NOTNULL}


def assemble(record: str) -> str:
    """The record without the line end that closes it."""
    if record.endswith("\r\n"):
        return record[:-2]
    return record[:-1] if record.endswith(("\n", "\r")) else record


def fields_of(record: str, layout: Layout) -> list[str | None]:
    """Fields of an assembled record, None where one is empty and unquoted; raises csv.Error."""
    if not record:
        return [None]
    swap: dict[str, str] = {}
    text = record
    if "\n" in text or "\r" in text:
        free = [c for c in _STAND_INS if c not in text and c != layout.delimiter]
        if len(free) < 2:
            free = [c for c in map(chr, range(0xE000, 0xF8FF)) if c not in text][:2]
        swap = {"\n": free[0], "\r": free[1]}
        for a, b in swap.items():
            text = text.replace(a, b)
    rows = list(csv.reader([text], **layout.dialect))
    if '"' in text and '"' in layout.quoted.sub("", text):
        raise csv.Error("quote inside a field without quotes")
    row = rows[0]
    for a, b in swap.items():
        row = [x and x.replace(b, a) for x in row]
    return row


def judge(record: str | None, layout: Layout | None) -> tuple[str | None, str, list[str | None] | None]:
    """Reason (None: it can be loaded), column at fault, fields."""
    if record is None:
        return "COLUMN_COUNT", "", None
    try:
        row = fields_of(assemble(record), layout or _UNKNOWN)
    except csv.Error:
        return "QUOTING", "", None
    if layout is None or len(row) != len(layout.columns):
        return "COLUMN_COUNT", "", None
    for value, (name, build, nullable) in zip(row, layout.columns, strict=True):
        if value is None:
            if not nullable:
                return "VALUE", name, None
            continue
        try:
            build(value)
        except ValueError:
            return "VALUE", name, None
    return None, "", row


_UNKNOWN = Layout([], ",")


def layouts(file_layout: DataFrame) -> dict[str, list[tuple[str, str, bool]]]:
    """Columns by table, with the delimiter as the first element's name.

    The layout is configuration: a row per column of each file that is loaded.
    """
    out: dict[str, list] = {}
    for r in file_layout.orderBy("table_name", "ordinal").collect():
        out.setdefault(r["table_name"], [r["delimiter"]]).append((r["column_name"], r["value_type"], r["nullable"]))
    return out


def judge_records(records: DataFrame, file_layout: DataFrame, record_id: str, table: str, text: str) -> DataFrame:
    """(record_id, table, reason, column_name, fields) of every record; reason is null if it loads."""
    plain = layouts(file_layout)
    id_type = records.schema[record_id].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(sys.maxsize)
        by = {name: Layout(cols[1:], cols[0]) for name, cols in plain.items()}
        for pdf in it:
            found = [judge(None if r is None else r, by.get(t)) for t, r in zip(pdf["__t"], pdf["__r"], strict=True)]
            yield pd.DataFrame(
                {
                    "__id": pdf["__id"],
                    "__t": pdf["__t"],
                    "reason": [f[0] for f in found],
                    "column_name": [f[1] for f in found],
                    "fields": [f[2] for f in found],
                }
            )

    narrow = records.select(F.col(record_id).alias("__id"), F.col(table).alias("__t"), F.col(text).alias("__r"))
    out = narrow.mapInPandas(run, f"__id {id_type}, __t string, reason string, column_name string, fields array<string>")
    return out.select(F.col("__id").alias(record_id), F.col("__t").alias(table), "reason", "column_name", "fields")


def rejected(records: DataFrame, file_layout: DataFrame) -> DataFrame:
    """(QuarantineId, reason, column_name) of the records that can't be loaded."""
    return (
        judge_records(records, file_layout, "QuarantineId", "TableName", "RecordData")
        .where("reason IS NOT NULL")
        .select("QuarantineId", "reason", "column_name")
    )


_TYPES = {"bigint": T.LongType(), "date": T.DateType(), "timestamp": T.TimestampNTZType(), "flag": T.BooleanType(), "string": T.StringType()}


def typed_rows(records: DataFrame, file_layout: DataFrame, table: str) -> DataFrame:
    """The records of one file that load, as typed columns after ``QuarantineId``.

    Flags become booleans, timestamps have no zone.  A column of the file that is itself called
    QuarantineId keeps its name; the id is then ``QuarantineId_``.  A file without a layout has no rows and
    no other columns.
    """
    columns = layouts(file_layout).get(table, [","])[1:]
    good = judge_records(records.where(F.col("TableName") == table), file_layout, "QuarantineId", "TableName", "RecordData").where("reason IS NULL")
    taken = {c.lower() for c, _, _ in columns}
    name = "QuarantineId" if "quarantineid" not in taken else "QuarantineId_"
    out = [F.col("QuarantineId").alias(name)]
    for i, (column, kind, _) in enumerate(columns):
        base = kind.lower().split("(")[0].strip()
        value = F.col("fields")[i]
        if base == "flag":
            value = value == "Y"
        elif base == "decimal":
            value = value.cast(kind.lower().replace(" ", ""))
        else:
            value = value.cast(_TYPES[base])
        out.append(value.alias(column))
    return good.select(*out)
