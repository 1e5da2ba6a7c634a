"""Reading sources: files of several formats, databases, and windows of either."""

from __future__ import annotations

import csv
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.cleaning import blank_far_dates


@dataclass(frozen=True)
class FileSource:
    """Where a file lies and how it is read.

    ``skip_rows`` lines come before the header, ``skip_after`` records between the header and the data.
    """

    path: str
    kind: str = "parquet"
    separator: str = ","
    encoding: str = "UTF-8"
    header: bool = True
    skip_rows: int = 0
    skip_after: int = 0
    sheet: str | int = 0
    schema: T.StructType | None = None
    rename: dict[str, str] = field(default_factory=dict)
    select: tuple[str, ...] = ()


@dataclass(frozen=True)
class DatabaseSource:
    """A database table; ``exclude`` and ``as_text`` shape the projection that is pushed down."""

    url: str
    table: str
    columns: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    as_text: tuple[str, ...] = ()
    driver: str | None = None
    fetch_size: int = 10_000
    hint: str = ""


def newest(spark: SparkSession, pattern: str) -> str:
    """The path that matches the pattern and was modified last; ties by name."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []
    files = sorted((f.getModificationTime(), f.getPath().toString()) for f in found)
    if not files:
        raise FileNotFoundError(pattern)
    return files[-1][1]


def read_file(spark: SparkSession, source: FileSource) -> DataFrame:
    """The newest file that the path matches, with columns renamed, then selected."""
    path = newest(spark, source.path) if any(c in source.path for c in "*?[{") else source.path
    if source.kind == "parquet":
        df = spark.read.parquet(path)
    elif source.kind in ("csv", "txt"):
        reader = spark.read.option("sep", source.separator).option("encoding", source.encoding).option("multiLine", True)
        if source.skip_rows or source.skip_after:
            df = _skipped(spark, path, source)
        else:
            reader = reader.option("header", source.header)
            df = (reader.schema(source.schema) if source.schema else reader).csv(path)
    elif source.kind in ("json", "ndjson"):
        reader = spark.read.option("multiLine", source.kind == "json")
        df = (reader.schema(source.schema) if source.schema else reader).json(path)
    elif source.kind == "orc":
        df = spark.read.orc(path)
    elif source.kind in ("xlsx", "xls"):
        df = _excel(spark, path, source)
    else:
        raise ValueError(f"unknown kind of file: {source.kind}")
    if source.rename:
        df = df.withColumnsRenamed(source.rename)
    return df.select(*source.select) if source.select else df


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; only the files' footers are read."""
    return spark.read.parquet(path).count()


def _head(spark: SparkSession, path: str, source: FileSource) -> tuple[list[str], int]:
    """The first record after the skipped lines, and how many records of the reader all that comes before the data is.

    Only the file's first lines are read here; the reader drops blank lines itself, so they aren't counted.
    """
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(at).isDirectory():
        files = sorted(f.getPath().toString() for f in fs.listStatus(at) if f.getPath().getName()[0] not in "._" and f.getLen())
        if not files:
            return [], 0
        at = jvm.org.apache.hadoop.fs.Path(files[0])
    stream = fs.open(at)
    try:
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, source.encoding))
        skipped = [lines.readLine() for _ in range(source.skip_rows)]

        def rest() -> Iterator[str]:
            while (line := lines.readLine()) is not None:
                yield line + "\n"

        records = (r for r in csv.reader(rest(), delimiter=source.separator) if r)
        first = next(records, [])
    finally:
        stream.close()
    return [x.removeprefix("\ufeff") for x in first], sum(bool(x and x.strip()) for x in skipped) + int(source.header) + source.skip_after


def _skipped(spark: SparkSession, path: str, source: FileSource) -> DataFrame:
    """A delimited file without the lines before its header and the records after it.

    Every file goes through the reader as a whole, so quoted line breaks and the encoding hold; its
    first records are dropped where they are read, by counting inside the file.  Without a schema all columns are text.
    """
    first, drop = _head(spark, path, source)
    names = list(source.schema.names) if source.schema else first if source.header else [f"_c{i}" for i in range(len(first))]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if not names:
        return spark.createDataFrame([], text)
    reader = spark.read.option("sep", source.separator).option("encoding", source.encoding).option("multiLine", True).option("escape", '"')
    raw = reader.schema(text).csv(path).select("*", F.col("_metadata.file_path").alias("__path"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, path_now = 0, None
        for batch in it:
            keep = []
            for at in batch.column("__path").to_pylist() if path_now is None or seen < drop or batch.column("__path")[batch.num_rows - 1].as_py() != path_now else ():
                seen = seen + 1 if at == path_now else 1
                path_now = at
                keep.append(seen > drop)
            out = batch.filter(pa.array(keep, pa.bool_())) if keep else batch
            yield out.select(names)

    rows = raw.mapInArrow(run, text)
    return rows.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in source.schema.fields]) if source.schema else rows


def _excel(spark: SparkSession, path: str, source: FileSource) -> DataFrame:
    """A sheet; workbooks are small by format (about a million rows), so one is read on the driver."""
    import pandas as pd

    try:
        pdf = pd.read_excel(path.removeprefix("file:"), sheet_name=source.sheet, header=0 if source.header else None, skiprows=source.skip_rows)
    except ImportError as e:
        raise RuntimeError("reading workbooks needs the package openpyxl") from e
    return spark.createDataFrame(pdf.rename(columns=str))


def validate(df: DataFrame, *, least: int = 1, expected: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """``df``, after checking that it has the columns and at least so many rows; raises otherwise."""
    missing = [c for c in [*expected, *keys] if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if least and df.limit(least).count() < least:
        raise ValueError(f"fewer than {least} rows")
    return df


#: A database's type for text of any length, by the beginning of its address.
TEXT_TYPES = {"jdbc:oracle": "CLOB", "jdbc:sqlserver": "NVARCHAR(MAX)", "jdbc:postgresql": "TEXT", "jdbc:mysql": "CHAR", "jdbc:derby": "CLOB"}


def text_type(url: str) -> str:
    """The database's type for text of any length."""
    return next((t for begin, t in TEXT_TYPES.items() if url.startswith(begin)), "CLOB")


def query(source: DatabaseSource, where: str = "") -> str:
    """The SELECT that the database runs: only wanted columns, some cast to text, filtered there."""
    if not source.columns and (source.exclude or source.as_text):
        raise ValueError("exclude and as_text need the list of columns; read_database finds it")
    columns = [c for c in source.columns if c not in source.exclude] or ["*"]
    shown = [f"CAST({c} AS {text_type(source.url)}) AS {c}" if c in source.as_text else c for c in columns]
    hint = f"{source.hint} " if source.hint else ""
    return f"SELECT {hint}{', '.join(shown)} FROM {source.table}" + (f" WHERE {where}" if where else "")


def _reader(spark: SparkSession, source: DatabaseSource):
    reader = spark.read.format("jdbc").option("url", source.url).option("fetchsize", source.fetch_size)
    return reader.option("driver", source.driver) if source.driver else reader


def with_columns(spark: SparkSession, source: DatabaseSource) -> DatabaseSource:
    """``source`` with the table's columns, asked from the database where a projection needs them."""
    if source.columns or not (source.exclude or source.as_text):
        return source
    return replace(source, columns=tuple(_reader(spark, source).option("dbtable", source.table).load().columns))


def bounds(spark: SparkSession, source: DatabaseSource, column: str, where: str = "") -> tuple[object, object]:
    """Smallest and largest value of a column, found by the database."""
    inner = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {source.table}" + (f" WHERE {where}" if where else "")
    row = _reader(spark, source).option("dbtable", f"({inner}) q").load().first()
    return row[0], row[1]


def read_database(
    spark: SparkSession, source: DatabaseSource, where: str = "", far_dates: Sequence[str] = (), *, split_by: str | None = None, parts: int = 16
) -> DataFrame:
    """A table over JDBC; dates from the year 9999 on become null.

    With ``split_by``, a number, date or time column, ``parts`` connections read a range of it each; rows
    where it is null belong to the first.  Without it one connection makes one consistent read.
    """
    source = with_columns(spark, source)
    reader = _reader(spark, source).option("dbtable", f"({query(source, where)}) q")
    if split_by:
        lo, hi = bounds(spark, source, split_by, where)
        if lo is not None and lo != hi:
            reader = reader.option("partitionColumn", split_by).option("lowerBound", str(lo)).option("upperBound", str(hi)).option("numPartitions", parts)
    df = reader.load()
    return blank_far_dates(df, far_dates) if far_dates else df


def _day(d: date) -> str:
    """A day's start in JDBC's own spelling, which every driver turns into its database's."""
    return f"{{ts '{d} 00:00:00'}}"


def day_predicates(column: str, days: Sequence[date], nulls: bool = False) -> list[str]:
    """One half-open predicate per day, for a parallel read, and one for rows without a day if asked."""
    found = [f"{column} >= {_day(d)} AND {column} < {_day(d + timedelta(days=1))}" for d in days]
    return [*found, f"{column} IS NULL"] if nulls else found


def days_with_rows(spark: SparkSession, source: DatabaseSource, column: str, start: date, end: date) -> list[date]:
    """The days from start to end, both included, that have rows; the database finds them, a row per day."""
    inner = f"SELECT DISTINCT CAST({column} AS DATE) AS d FROM {source.table} WHERE {column} >= {_day(start)} AND {column} < {_day(end + timedelta(days=1))}"
    return sorted(r[0] if isinstance(r[0], date) and not hasattr(r[0], "hour") else r[0].date() for r in _reader(spark, source).option("dbtable", f"({inner}) q").load().collect())


def read_days(spark: SparkSession, source: DatabaseSource, column: str, days: Sequence[date], nulls: bool = True) -> DataFrame:
    """Some days of a table, one partition per day, and one for the rows without a day unless ``nulls`` is False."""
    source = with_columns(spark, source)
    how = {"fetchsize": str(source.fetch_size)} | ({"driver": source.driver} if source.driver else {})
    return spark.read.jdbc(source.url, f"({query(source)}) q", predicates=day_predicates(column, days, nulls), properties=how)


def window(df: DataFrame, column: str, target: date, overlap_minutes: int = 0) -> DataFrame:
    """One day's rows, from as many whole days earlier as the overlap covers."""
    start = target - timedelta(days=overlap_minutes // 1440)
    t = F.col(column)
    return df.where((t >= F.lit(str(start)).cast("timestamp_ntz")) & (t < F.lit(str(target + timedelta(days=1))).cast("timestamp_ntz")))


def distinct_days(df: DataFrame, column: str) -> DataFrame:
    """(day) of every day that has rows."""
    return df.where(F.col(column).isNotNull()).select(F.to_date(column).alias("day")).distinct()


#: Parts of messages of errors that may pass; they go before the permanent ones.
TRANSIENT = (
    "ora-12541", "ora-12170", "ora-03135", "ora-03113", "ora-12537", "connection reset", "connection refused", "timeout", "timed out", "broken pipe",
    "network", "server is not available",
)
#: Parts of messages that no retry can help.
PERMANENT = (
    "syntax", "permission", "does not exist", "invalid column", "invalid object", "login failed", "access denied", "ora-00942", "ora-00904", "ora-01017",
    "ora-01031", "ora-00933", "ora-06550",
)


def is_permanent(message: str) -> bool:
    """Whether an error would come again: a sign that it may pass outweighs any other, and so does no sign at all."""
    low = message.lower()
    return not any(t in low for t in TRANSIENT) and any(p in low for p in PERMANENT)


def with_retry(action: Callable[[], DataFrame], tries: int = 3, wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """The action's result, tried again after errors that may pass, waiting twice as long each time."""
    for n in range(tries):
        try:
            return action()
        except Exception as e:
            if n + 1 == tries or is_permanent(str(e)):
                raise
            sleep(wait * 2**n)
    raise AssertionError


#: Readers by kind of source; a caller can add its own.
READERS: dict[type, Callable[..., DataFrame]] = {FileSource: read_file, DatabaseSource: read_database}


def read(spark: SparkSession, source: object) -> DataFrame:
    """The whole of a source."""
    return READERS[type(source)](spark, source)
