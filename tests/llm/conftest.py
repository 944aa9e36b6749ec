import pytest
from pyspark.sql import functions as F

from reviewflow.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Make a documents table: (doc_id, text) or (doc_id, text, source) per row."""
    prepare(spark)

    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.withColumns({c: F.lit(i) for i, c in enumerate(extra)}).repartition(3) if extra else df.repartition(3)
    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
