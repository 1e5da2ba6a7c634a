"""The shared folder for intermediate tables.

On a cluster it is ``spark.checkpoint.dir``, which every executor can reach; tests and local runs,
where that is unset, get a folder of their own.  What was written is removed by :func:`release`, which a
session that runs many queries calls between them, and at the end of the process.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or, on a local master without one, a temporary folder."""
    own = spark.conf.get("spark.checkpoint.dir", None)
    if own:
        return own.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="strandline-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; :func:`release` removes it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Removes what the session wrote to the shared folder; results that still read it fail afterwards."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


@atexit.register
def _at_exit() -> None:
    if not _WRITTEN:
        return
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None:
            release(spark)
    except Exception:
        # The session has ended before; its folder stays.
        return


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, and a lost executor
    costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
