"""Relational sources over JDBC (S3) and the exact-name table check of S6.

Credentials are passed in (options or environment), never stored in code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str | None = None, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    opts = {"url": url}
    if table:
        opts["dbtable"] = table
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    opts.update({k: str(v) for k, v in extra.items() if v is not None})
    return opts


def read_table(spark: SparkSession, table: str, columns: list | None = None, url: str = "", *,
               user: str | None = None, password: str | None = None, driver: str | None = None,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, fetch_size: int | None = None) -> DataFrame:
    """S3: a table over JDBC, projected to ``columns`` (pruned in the pushed query).

    Without partition options Spark reads a JDBC table in one task; give a
    numeric/date ``partition_column`` with bounds to read in
    ``num_partitions`` parallel range queries.
    """
    opts = jdbc_options(url, table, user, password, driver, fetchsize=fetch_size)
    if partition_column:
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound), upperBound=str(upper_bound),
                    numPartitions=str(num_partitions or 8))
    df = spark.read.format("jdbc").options(**opts).load()
    return df.select(*columns) if columns else df


def jdbc_bounds(spark: SparkSession, table: str, column: str, url: str, *, user=None, password=None,
                driver=None) -> tuple:
    """(min, max) of a numeric/date column, computed by the database (one row back),
    to size a partitioned ``read_table``."""
    opts = jdbc_options(url, None, user, password, driver)
    opts["query"] = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**opts).load().first()
    return row["lo"], row["hi"]


def read_table_partitioned(spark: SparkSession, table: str, column: str, columns: list | None = None,
                           url: str = "", *, num_partitions: int = 64, user=None, password=None, driver=None,
                           fetch_size: int | None = 10_000) -> DataFrame:
    """S3 at scale: ``num_partitions`` parallel range queries over ``column``'s [min, max]."""
    lo, hi = jdbc_bounds(spark, table, column, url, user=user, password=password, driver=driver)
    if lo is None:
        return read_table(spark, table, columns, url, user=user, password=password, driver=driver)
    return read_table(spark, table, columns, url, user=user, password=password, driver=driver,
                      partition_column=column, lower_bound=lo, upper_bound=hi, num_partitions=num_partitions,
                      fetch_size=fetch_size)


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def jdbc_table_exists(spark: SparkSession, table: str, url: str, *, user=None, password=None, driver=None,
                      catalog_query: str | None = None) -> bool:
    """Exact-name existence check in the database catalog.

    ``LIKE`` would treat ``_`` as a wildcard; this compares names with ``=``.
    The default catalog query is the standard INFORMATION_SCHEMA one; pass
    ``catalog_query`` (with ``{name}`` for the quoted name) for databases
    that keep it elsewhere.
    """
    q = catalog_query or ("SELECT table_name FROM information_schema.tables "
                          "WHERE table_schema = DATABASE() AND table_name = {name}")
    opts = jdbc_options(url, None, user, password, driver)
    opts["query"] = q.format(name=_quote(table))
    return len(spark.read.format("jdbc").options(**opts).load().take(1)) > 0
