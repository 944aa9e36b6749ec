"""Positions of rows inside ordered groups of any size, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import stage

ROW_BITS = 33       # monotonically_increasing_id keeps the row's place in its partition in the lower 33 bits


def runs_and_rows(rows: DataFrame, keys: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(runs, rows): the rows in global order, staged, and what a key holds in each range partition.

    The table is dealt by ranges of (keys, order), so a key with a large part
    of all rows covers many partitions and every partition holds one run of
    it.  A run (keys, run) has ``first``, the row number its rows count from,
    ``before``, the key's rows in earlier runs, and ``size``, the rows of the
    key; a key has at most one run per partition, so the window over its runs
    is small.  Rows that are equal in all of keys and order are dealt apart by
    their place in the input.  Keys must not be null; nulls in order come first.
    """
    tie = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = tie.repartitionByRange(*keys, *order, "_tie").sortWithinPartitions(*keys, *order, "_tie").drop("_tie")
    placed = stage(dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("run", F.shiftright("at", ROW_BITS)), f"{name}-ordered")
    runs = placed.groupBy(*keys, "run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    key = Window.partitionBy(*keys)
    before = F.sum("held").over(key.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    return (runs.select(*keys, "run", "first", F.coalesce(before, F.lit(0)).cast("long").alias("before"), F.sum("held").over(key).alias("size")),
            placed)


def numbered(rows: DataFrame, keys: list[str], order: list[str], into: str, name: str) -> DataFrame:
    """``rows`` with each one's place in its key, from 0, and ``size``, the rows of the key."""
    runs, placed = runs_and_rows(rows, keys, order, name)
    return (placed.join(runs, [*keys, "run"]).withColumn(into, F.col("before") + F.col("at") - F.col("first"))
            .drop("run", "at", "first", "before"))
