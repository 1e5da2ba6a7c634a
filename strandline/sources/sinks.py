"""Writing: delimited bulk files, reloads, databases, rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import add_row_hash, rewrite_strings
from ..operators.cleaning import add_extracted_at, bits_to_tinyint, blank_far_dates, reorder, sanitize_strings
from .readers import exists


def prepare(df: DataFrame, at: str, *, far_dates: Sequence[str] = (), exclude: Sequence[str] = (), empty_as_null: bool = False, portable: bool = False) -> DataFrame:
    """An extract made ready to be stored, in this order: far dates, strings as they are hashed, row hash, time of
    extraction, control characters, booleans.  The hash sees strings before control characters go."""
    dated = blank_far_dates(df, far_dates) if far_dates else df
    hashed = add_row_hash(rewrite_strings(dated, empty_as_null=empty_as_null), exclude, portable=portable)
    stamped = add_extracted_at(hashed, at)
    return bits_to_tinyint(sanitize_strings(stamped))


def append(df: DataFrame, path: str) -> None:
    """Rows added to a Parquet table whose columns, where it exists, have the same names and types."""
    if exists(df.sparkSession, path):
        have = df.sparkSession.read.parquet(path).schema
        if [(f.name, f.dataType) for f in have.fields] != [(f.name, f.dataType) for f in df.schema.fields]:
            raise ValueError(f"the table has other columns: {have.simpleString()}")
    df.write.mode("append").parquet(path)


def write_bulk(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Tab-delimited text for a bulk loader: no header, no quotes, null as nothing, milliseconds."""
    out = bits_to_tinyint(sanitize_strings(reorder(df, columns or df.columns)))
    (
        out.write.mode("overwrite").option("sep", "\t").option("header", False).option("quote", "").option("nullValue", "").option("emptyValue", "")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSS").option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS").option("lineSep", "\n").csv(path)
    )


def reload(df: DataFrame, path: str, internal: bool = False) -> None:
    """A clean copy in place of the old one; internal columns are left out."""
    keep = df.columns if internal else [c for c in df.columns if not c.startswith("_")]
    df.select(*keep).write.mode("overwrite").parquet(path)


def write_database(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, streams: int = 8, driver: str | None = None) -> None:
    """Rows into a database table over several connections."""
    out = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch).option("numPartitions", streams)
    (out.option("driver", driver) if driver else out).mode(mode).save()


def quarantine(rejects: DataFrame, reason: str, table: str, source: str, batch_id: int, at: str) -> DataFrame:
    """Rejected rows as records: their reason and their content as JSON."""
    return rejects.select(
        F.lit(table).alias("TableName"),
        F.lit(source).alias("SourceName"),
        F.lit(reason).alias("RejectionReason"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in rejects.columns])).alias("RecordData"),
        F.lit(batch_id).cast("bigint").alias("BatchId"),
        F.lit(at).cast("timestamp_ntz").alias("QuarantinedAt"),
    )
