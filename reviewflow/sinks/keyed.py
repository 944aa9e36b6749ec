"""Tables with one row per key, kept so by merging (K1 as a property of the target).

A keyed table is a folder of Parquet files partitioned by a bucket of the key.
A merge reads and rewrites only the buckets that its rows touch; of a key's
rows, old and new, the first under a total order stays.  So a merge that runs
again, or rows that come twice or out of order, change nothing.

The buckets' new content is staged beside them, under a name that readers
skip, before they are replaced.  A merge that ended while it replaced buckets
is finished from its stage by the next one, before anything is read.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.operators.clean import dedup_on_key, require
from reviewflow.session import scratch_path

BUCKET = "key_bucket"
MERGING = "_merging"
DEFAULT_BUCKETS = 64


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _any(spark: SparkSession, path: str, names: str) -> bool:
    """Is there anything below ``path`` with such a name?"""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(path, names))
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def read_keyed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table's rows; empty before its first merge."""
    if not _any(spark, path, f"{BUCKET}=*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _replace(spark: SparkSession, path: str, stage: str, schema) -> None:
    back = spark.read.schema(schema).parquet(stage)
    (back.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))


def _finish(spark: SparkSession, path: str, schema) -> None:
    """Replace from stages that a merge left complete; throw away the others."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(os.path.join(path, MERGING))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        stage = status.getPath()
        if _any(spark, stage.toString(), "_SUCCESS"):
            _replace(spark, path, stage.toString(), schema)
        fs.delete(stage, True)


def merge_by_key(rows: DataFrame, path: str, key: list[str], order: list[Column], buckets: int = DEFAULT_BUCKETS) -> dict:
    """Merge ``rows`` into the keyed table at ``path``: {buckets}, how many were rewritten.

    ``order`` must be total over all columns that differ, so that the outcome
    does not depend on how rows arrive.  Rows without a key are left out.  All
    merges of a table take the same number of buckets, and one runs at a time.
    A hot key costs one row per map task: the first of a key is found before
    the shuffle.
    """
    spark = rows.sparkSession
    new = scratch_path(spark, "keyed-new")
    dedup_on_key(require(rows, key), key, order).withColumn(BUCKET, bucket_of(key, buckets)).write.partitionBy(BUCKET).parquet(new)
    schema = rows.withColumn(BUCKET, F.lit(0)).schema
    _finish(spark, path, schema)
    arrived = spark.read.schema(schema).parquet(new)
    touched = [r[0] for r in arrived.select(BUCKET).distinct().collect()]          # at most ``buckets`` numbers
    if touched:
        held = read_keyed(spark, path, schema).where(F.col(BUCKET).isin(touched))
        stage = os.path.join(path, MERGING, uuid.uuid4().hex)
        dedup_on_key(held.unionByName(arrived), key, order).write.parquet(stage)
        _finish(spark, path, schema)
    return {"buckets": len(touched)}
