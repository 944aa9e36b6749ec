"""The operators' queries that SQL can express against their DuckDB SQL."""

import duckdb
import pytest

from reviewflow.llm.queries import ORACLE_SQL, QUERIES
from reviewflow.plans.derive import TABLES
from tools.oracle_check import compare

DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    verdict = compare(name, QUERIES[name](spark, DIR).toPandas(), con.execute(ORACLE_SQL[name]).df())
    con.close()
    assert verdict.startswith("OK"), verdict


def test_one_query_for_each_operator():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_line_dedup", "op2_secret_scan", "op3_source_mixing", "op4_exact_dedup", "op5_toxicity", "op6_license_scan",
        "op7_byte_bpe", "op8_pii", "op9_simhash", "op10_embedding_dedup", "op11_conversation_trie", "op12_rotated_codes",
        "op13_merkle_manifest"]
