"""A change feed applied as it arrives, and windowed counts with a watermark."""

from __future__ import annotations

import json
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.apply_changes import ChangeTable, FeedColumns, apply_changes


def _as_text(table: ChangeTable, batch: int) -> str:
    return json.dumps({"batch": batch, "table": asdict(table)})


def _from_text(text: str) -> tuple[ChangeTable, int]:
    found = json.loads(text)
    t = found["table"]
    columns = FeedColumns(**(t.pop("columns") | {}))
    fields = {k: tuple(v) if isinstance(v, list) else v for k, v in t.items()}
    return ChangeTable(columns=replace(columns, key=tuple(columns.key)), **fields), found["batch"]


class LiveTable:
    """A :class:`ChangeTable` that each micro-batch moves to its next version.

    Its versions are kept beside the stream's checkpoint, one small file per micro-batch, so a stream
    that is started again goes on with the table that the checkpoint belongs to.  A micro-batch that is
    delivered again after a failure is passed over if its version was written, and applied again if not;
    changes carry their own order and are told apart by their id, so that changes nothing either.
    """

    def __init__(self, spark: SparkSession, table: ChangeTable) -> None:
        self.spark, self.table, self.batch, self.store = spark, table, -1, None

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.store}/{name}")

    def _files(self):
        at = self._path("versions")
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def open(self, store: str) -> None:
        """Takes up the last version that was written under the folder, if there is one."""
        self.store = store.rstrip("/")
        fs, at = self._files()
        fs.mkdirs(at)
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        written = sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))
        if written:
            stream = fs.open(self._path(f"versions/{written[-1]}.json"))
            try:
                lines = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
                self.table, self.batch = _from_text(lines.readLine())
            finally:
                stream.close()
        elif self.table.root is None:
            self.table = replace(self.table, root=f"{self.store}/data")

    def take(self, batch: DataFrame, number: int) -> None:
        """Applies one micro-batch and writes the version that it makes."""
        if number <= self.batch:
            return
        self.table, self.batch = apply_changes(self.spark, self.table, batch), number
        if self.store:
            fs, _ = self._files()
            half = self._path(f"versions/{number}.part")
            out = fs.create(half, True)
            out.write(bytearray(_as_text(self.table, number).encode()))
            out.close()
            fs.rename(half, self._path(f"versions/{number}.json"))

    def follow(self, feed: DataFrame, checkpoint: str) -> StreamingQuery:
        """Starts following a streaming feed until all that is available has been applied."""
        self.open(f"{checkpoint.rstrip('/')}.table")
        return feed.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(events: DataFrame, at: str, kind: str, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(window start, kind, n) of a stream; events later than the watermark are dropped."""
    return (
        events.withWatermark(at, late)
        .groupBy(F.window(at, every).alias("w"), kind)
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), kind, "n")
    )
