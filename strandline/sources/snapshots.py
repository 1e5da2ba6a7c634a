"""Immutable Parquet snapshots, one per source, table, business date and batch, that can be verified.

A snapshot's files get a SHA-256 each in a manifest beside it; a snapshot is replayed only if files
and row count still agree.  The manifest is computed by tasks, file by file.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.cleaning import keep_first, one_row


@dataclass(frozen=True)
class Snapshot:
    """Identity of a snapshot under a root folder."""

    root: str
    source: str
    table: str
    business_date: date
    batch_id: int

    @property
    def path(self) -> str:
        d = self.business_date
        return f"{self.root}/source={self.source}/table={self.table}/year={d:%Y}/month={d:%m}/day={d:%d}/batch={self.batch_id}"

    @property
    def manifest(self) -> str:
        return f"{self.root}/_manifest/{self.source}.{self.table}.{self.business_date:%Y%m%d}.{self.batch_id}"


class SnapshotDamaged(RuntimeError):
    """Files or rows of a snapshot aren't those that were written."""


#: Bytes of a file that are read at a time.
PIECE = 8 << 20


def _open(path: str):
    """A file of any file system that Arrow knows, as a stream of bytes."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path) if ":" in path else f"file://{path}")
    return system.open_input_stream(unquote(inner))


def _digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, sha256) of every data file; a task streams its files in pieces, whatever their size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    schema = "file string, length bigint, sha256 string"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            sums = []
            for one in pdf["path"]:
                digest = hashlib.sha256()
                with _open(one) as stream:
                    while piece := stream.read(PIECE):
                        digest.update(piece)
                sums.append(digest.hexdigest())
            yield pd.DataFrame({"file": [x.rpartition("/")[2] for x in pdf["path"]], "length": pdf["length"], "sha256": sums})

    return files.mapInPandas(run, schema)


def write_snapshot(df: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Writes the snapshot and its manifest and returns its registry row, in state created.

    An existing snapshot is never overwritten.
    """
    spark = df.sparkSession
    df.write.mode("error").option("compression", "zstd").parquet(snapshot.path)
    rows = spark.read.parquet(snapshot.path).count()
    _digests(spark, snapshot.path).withColumn("rows", F.lit(rows).cast("bigint")).coalesce(1).write.mode("error").parquet(snapshot.manifest)
    return spark.createDataFrame(
        [(snapshot.source, snapshot.table, snapshot.business_date, snapshot.batch_id, snapshot.path, rows, "created")],
        "SourceName string, TableName string, BusinessDate date, BatchId bigint, Path string, RowCount bigint, Status string",
    )


def verify(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """(file, problem) for each file that is missing, new or changed; if there is none, a row for a
    wrong row count."""
    want = spark.read.parquet(snapshot.manifest)
    have = _digests(spark, snapshot.path)
    both = want.select("file", F.col("sha256").alias("w")).join(have.select("file", F.col("sha256").alias("h")), "file", "full")
    problem = F.when(F.col("h").isNull(), "missing").when(F.col("w").isNull(), "unexpected").when(F.col("h") != F.col("w"), "changed")
    files = both.select("file", problem.alias("problem")).where("problem IS NOT NULL")
    if not files.isEmpty():
        return files
    rows = one_row(spark.read.parquet(snapshot.path).agg(F.count("*").alias("n")), want.agg(F.max("rows").alias("r")))
    return files.unionByName(rows.where("n <> r").select(F.lit("*").alias("file"), F.lit("row count").alias("problem")))


def replay(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """The snapshot's rows, after verifying it."""
    found = verify(spark, snapshot).limit(5).collect()
    if found:
        raise SnapshotDamaged(f"{snapshot.path}: {[tuple(r) for r in found]}")
    return spark.read.parquet(snapshot.path)


#: Verdicts of a verification, and whether each counts as failed.
VERDICTS = {"verified": False, "would_verify": False, "skipped": False, "missing": True, "hash_mismatch": True, "status_invalid": True, "error": True}


def lookup(registry: DataFrame, source: str, table: str, business_date: str, batch_id: int) -> DataFrame:
    """The registry row of exactly this snapshot."""
    return registry.where(
        (F.col("SourceName") == source) & (F.col("TableName") == table) & (F.col("BusinessDate") == F.lit(business_date).cast("date")) & (F.col("BatchId") == batch_id)
    )


def mark_verified(registry: DataFrame, found: DataFrame) -> DataFrame:
    """(registry columns, verdict): the registry after a verification.

    ``found`` has what was measured per ``Path``: Sha256 and Rows, null where there is no file.  A snapshot in state
    created whose checksum and count agree is verified; one that is verified already is skipped; any
    other state can't be verified.
    """
    both = registry.join(found.select("Path", F.col("Sha256").alias("__s"), F.col("Rows").alias("__n"), F.lit(True).alias("__m")), "Path", "left")
    agrees = F.col("__s").eqNullSafe(F.col("Sha256")) & F.col("__n").eqNullSafe(F.col("RowCount"))
    verdict = (
        F.when(F.col("Status") == "verified", "skipped")
        .when(F.coalesce(F.col("Status") != "created", F.lit(True)), "status_invalid")
        .when(F.col("__m").isNull() | F.col("__s").isNull(), "missing")
        .when(~agrees, "hash_mismatch")
        .otherwise("verified")
    )
    out = both.withColumn("verdict", verdict)
    return out.withColumn("Status", F.when(F.col("verdict") == "verified", "verified").otherwise(F.col("Status"))).select(*registry.columns, "verdict")


def verdict_counts(verified: DataFrame) -> DataFrame:
    """(verdict, n) of a bulk verification, with the sum of those that count as failed."""
    per = verified.groupBy("verdict").agg(F.count("*").alias("n"))
    failed = per.where(F.col("verdict").isin(*[v for v, bad in VERDICTS.items() if bad])).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return per.unionByName(failed.select(F.lit("failed").alias("verdict"), "n"))


def latest_for_date(registry: DataFrame) -> DataFrame:
    """Per source, table and date, the snapshot to replay: the newest that is verified or further."""
    usable = registry.where(F.col("Status").isin("verified", "replicated", "archived", "replication_failed"))
    return keep_first(usable, ["SourceName", "TableName", "BusinessDate"], [F.col("CreatedAt").desc_nulls_last(), F.col("BatchId").desc_nulls_last()])
