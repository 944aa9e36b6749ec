"""Hot keys: one parent / request / key holding a third of all rows."""

from pyspark.sql import functions as F

from reviewflow.operators import assemble as AS
from reviewflow.operators import augment as AU
from reviewflow.operators import clean as C
from reviewflow.operators import flatten as FL

N = 30_000


def _skewed(spark):
    # key 0 holds a third of the rows; the rest spread over 2,000 keys
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        F.col("id").alias("v"))


def test_nest_splits_a_hot_parent_into_bounded_records(spark):
    df = _skewed(spark)
    with_pos = C.first_n_per_key(df, ["k"], ["v"], N, rank_col="pos")
    nested = FL.nest_children(with_pos, ["k"], "pos", ["v"], array_name="c", chunk_size=1000)
    hot = nested.filter("k = 0").select("chunk", F.size("c").alias("n"), F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # see the raw hash placement
    try:
        rows = hot.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(rows) == 10 and max(r.n for r in rows) <= 1000 and sum(r.n for r in rows) == N // 3
    assert len({r.p for r in rows}) > 1                      # the hot parent spans several tasks
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "chunk" in plan.split("hashpartitioning(")[1].split(")")[0]
    back = FL.unnest_children(nested, ["k"], "c", chunk_size=1000)
    assert back.select("k", "v").exceptAll(df).count() == 0 and back.count() == N


def test_dedup_and_top_n_on_a_hot_key(spark):
    df = _skewed(spark)
    one = {r.k: r.v for r in C.dedup_on_key(df, ["k"], [F.col("v").desc()]).collect()}
    assert len(one) == 2001 and one[0] == max(v for v in range(N) if v % 3 == 0)
    top = C.first_n_per_key(df, ["k"], ["v"], 5).filter("k = 0").orderBy("v").collect()
    assert [r.v for r in top] == [0, 3, 6, 9, 12]


def test_assemble_pages_with_a_huge_request(spark):
    pages = spark.range(1, 10_001).select(
        F.lit("hot").alias("request_id"), F.col("id").cast("int").alias("page_no"),
        F.when(F.col("id") == 7777, F.lit("UNKNOWN_ERROR")).otherwise(F.lit("OK")).alias("status"),
        F.lit("tok").alias("next_page_token"), F.array(F.col("id").cast("string")).alias("results"))
    other = spark.createDataFrame([("cold", 1, "OK", None, ["x"])],
                                  "request_id string, page_no int, status string, next_page_token string, "
                                  "results array<string>")
    out = AS.assemble_pages(pages.unionByName(other))
    got = {r.request_id: r.n for r in out.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    assert got == {"hot": 7776, "cold": 1}


def test_top_up_with_a_hot_parent(spark):
    children = _skewed(spark).select(F.col("k").cast("string").alias("k"), F.col("v").alias("pos"))
    hot = children.filter("k = '0'").drop("pos").limit(1)
    small = spark.createDataFrame([("new",)], "k string")
    parents = hot.unionByName(small)
    # the hot parent is far above the minimum and stays untouched; the new parent is padded
    children = C.first_n_per_key(children, ["k"], ["pos"], N, rank_col="__r").drop("pos") \
        .withColumnRenamed("__r", "pos")
    out = AU.top_up_groups(children.filter("k = '0'"), parents, "k", "pos", min_count=50)
    counts = {r.k: r.n for r in out.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {"0": N // 3, "new": 50}
