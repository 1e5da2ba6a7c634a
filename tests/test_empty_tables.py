"""Every query on tables without rows, and on tables whose columns are all null."""

import os

import pytest
from pyspark.sql import functions as F

from strandline.plans import control_queries as reference, queries as core

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {**reference.QUERIES, **core.TRAINING}
#: Configuration, which is never null or missing.
CONFIGURATION = ("file_layout", "mix_target")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("rows", [0, 3])
def test_queries_end(spark, tmp_path, rows):
    for f in os.listdir(FOLDER):
        df = spark.read.parquet(f"{FOLDER}/{f}")
        if f.removesuffix(".parquet") not in CONFIGURATION:
            df = df.limit(rows).select(*[F.lit(None).cast(k.dataType).alias(k.name) for k in df.schema.fields])
        df.coalesce(1).write.parquet(str(tmp_path / f))
    for name, query in QUERIES.items():
        try:
            query(spark, str(tmp_path)).write.format("noop").mode("overwrite").save()
        except Exception as e:
            raise AssertionError(f"{name}: {str(e)[:500]}") from e
