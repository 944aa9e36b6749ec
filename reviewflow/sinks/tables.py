"""Table sinks (S4-S6) with row counts observed on the writing job (G1).

Failures raise (the source pipeline printed and carried on).  The save mode
is set with ``.mode("append")`` — passing ``mode`` inside ``options`` leaves
the default ErrorIfExists in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow.sources.jdbc import jdbc_options, jdbc_table_exists


# Connections that one append opens at most, unless told otherwise.
MAX_CONNECTIONS = 16


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """G1: count rows on the action that writes them — no second job, and the
    scorer UDF is not pruned away as it is under a separate ``count()``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def append_table(df: DataFrame, table: str, url: str, *, user=None, password=None, driver=None,
                 batchsize: int = K.JDBC_BATCH_SIZE, num_partitions: int = MAX_CONNECTIONS) -> int:
    """Append over JDBC in batches; ``num_partitions`` caps concurrent connections
    (rows are coalesced to that many tasks before the write)."""
    opts = jdbc_options(url, table, user, password, driver, batchsize=batchsize, numPartitions=num_partitions)
    out, obs = observed(df)
    out.write.format("jdbc").options(**opts).mode("append").save()
    return obs.get["rows"]


def append_catalog_table(df: DataFrame, table: str) -> int:
    """Append to a catalog table by column name (order-independent)."""
    spark = df.sparkSession
    cols = spark.table(table).columns
    out, obs = observed(df.select(*cols))
    out.write.mode("append").insertInto(table)
    return obs.get["rows"]


def target_exists(spark, table: str, url: str | None = None, **jdbc) -> bool:
    """Is the target there? With ``url``: in the database catalog (exact name), else in the session catalog."""
    if url:
        return jdbc_table_exists(spark, table, url, **{k: jdbc.get(k) for k in ("user", "password", "driver")})
    return spark.catalog.tableExists(table)


def guarded_append_rows(df: DataFrame, table: str, url: str | None = None, **jdbc) -> int | None:
    """Append only if the target exists; rows written, or None when skipped (with a notice).

    With ``url`` the check runs against the database catalog (exact name);
    without it, against the session catalog.
    """
    spark = df.sparkSession
    if not target_exists(spark, table, url, **jdbc):
        print(f"target table {table} does not exist; load skipped")
        return None
    if url:
        return append_table(df, table, url, **jdbc)
    return append_catalog_table(df, table)


def guarded_append(df: DataFrame, table: str, url: str | None = None, **jdbc) -> bool:
    """As ``guarded_append_rows``; True when the target existed and the rows were appended."""
    return guarded_append_rows(df, table, url, **jdbc) is not None
