"""Helpers shared by the operators: staged tables, text normalisation, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.session import ensure_checkpoint_dir, scratch_path, ship_package

# Whole texts go to Python workers: a batch is cut by bytes, not only by rows.
BATCH_BYTES = str(4 << 20)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Java pattern of one word: a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Shared folder, package on the executors, Arrow batches bounded in bytes."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs the tasks that still read it, never the work before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")
