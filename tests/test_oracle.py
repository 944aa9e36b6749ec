"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import duckdb
import pytest

import __spark_entry__ as E
from reviewflow.plans.derive import TABLES
from reviewflow.plans.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tools.oracle_check import compare

# the library's own catalogue; the optional training-data queries have their tests beside them
SQL, NAMES = ORACLE_SQL, set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    yield con
    con.close()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "review" in df.columns


def test_every_query_has_sql_or_is_declared_rows_only():
    assert NAMES - set(SQL) == {"q_train_logistic"}
    assert set(SQL) <= NAMES <= set(E.queries()) and SQL.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_ORACLE).toPandas()
    ddf = duck.execute(SQL[name]).df()
    verdict = compare(name, sdf, ddf)
    assert verdict.startswith("OK"), verdict


def test_rows_only_query_runs(spark):
    df = E.queries()["q_train_logistic"](spark, SF_SMALL)
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
