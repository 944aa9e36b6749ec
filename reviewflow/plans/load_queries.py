"""Queries of loading: appends made once, landed files loaded once, keyed merges, the run ledger.

Each writes real tables below the shared scratch folder and reads the whole of
the supplied table; catalog entries are dropped before the query returns.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow import schemas as S
from reviewflow.functions import exprs as X
from reviewflow.operators.flatten import flatten_reviews
from reviewflow.plans import derive as D
from reviewflow.plans import flows as PL
from reviewflow.plans.registry import register
from reviewflow.session import scratch_path
from reviewflow.sinks import landings as LA
from reviewflow.sinks.envelope import write_envelope
from reviewflow.sinks.keyed import merge_by_key, read_keyed
from reviewflow.sinks.ledger import BEGUN, Ledger
from reviewflow.sinks.tables import append_catalog_table


@contextmanager
def _database(spark):
    """A catalog database of its own in the scratch folder, gone afterwards with its entries; external files stay."""
    name = f"reviewflow_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@register("q_append_once", "SELECT event_id, user_id, event_type, value FROM events")
def q_append_once(spark, sf_dir):
    """Three loads into a catalog table; one is run twice, one ended between its append and its record and is run again."""
    events = D.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    ledger, path = Ledger(spark, scratch_path(spark, "ledger")), scratch_path(spark, "append-once")
    with _database(spark) as db:
        target = f"{db}.events"
        spark.sql(f"CREATE TABLE {target} (event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE) USING parquet LOCATION '{path}'")
        parts = [events.where(F.pmod("event_id", F.lit(3)) == k) for k in range(3)]
        ledger.append_once(parts[0], target, "first")
        ledger.append_once(parts[0], target, "first")
        cut = ledger.staged(parts[1], "second", target)
        total = cut.selectExpr("count(*) AS rows", "coalesce(bit_xor(xxhash64(event_id, user_id, event_type, value)), 0L) AS digest").first()
        ledger.record("second", target, BEGUN, total["rows"], total["digest"])
        append_catalog_table(cut, target)               # ... and here the job is lost
        for k, name in enumerate(("first", "second", "third")):
            ledger.append_once(parts[k], target, name)
    return spark.read.schema(events.schema).parquet(path)


def _land(docs, path):
    write_envelope(docs, path, partition_col="city_slug", root="data", constants={"disclaimer": K.DEFAULT_DISCLAIMER}, mode="overwrite")


@register("q_loaded_files", """
WITH r(run, old, new) AS (VALUES (1, 0, 1), (2, 0, 0), (3, 1, 1), (4, 0, 0)),
n AS (SELECT count(*) FILTER (conv_id % 2 = 0) AS even, count(*) FILTER (conv_id % 2 <> 0) AS odd,
             sum(length(text)) FILTER (conv_id % 2 = 0) AS even_chars, sum(length(text)) AS chars FROM conversations)
SELECT run, CAST(CASE WHEN run = 1 THEN even WHEN run = 3 THEN odd ELSE 0 END AS BIGINT) AS rows_loaded, run IN (1, 3) AS took_files,
       CAST(CASE WHEN run < 3 THEN even ELSE even + odd END AS BIGINT) AS rows_held,
       CAST(CASE WHEN run < 3 THEN even_chars ELSE chars END AS BIGINT) AS chars_held
FROM r, n
""")
def q_loaded_files(spark, sf_dir):
    """A landing folder is loaded, loaded again, grows, and is loaded twice more: every file once."""
    docs = D.review_documents(D.table(spark, sf_dir, "conversations")).withColumn("city_slug", X.slug("city"))
    landing, ledger = scratch_path(spark, "landing"), Ledger(spark, scratch_path(spark, "ledger"))
    even = F.expr("cast(regexp_extract(data[0].place_id, '[0-9]+$', 0) AS long) % 2 = 0")
    out = None
    with _database(spark) as db:
        S.create_target_tables(spark, db)
        target = f"{db}.{S.HOSPITAL_REVIEWS.name}"
        _land(docs.where(even), os.path.join(landing, "one"))
        for run in range(1, 5):
            if run == 3:
                _land(docs.where(~even), os.path.join(landing, "two"))
            done = PL.load_new_reviews(spark, landing, ledger, D.FIXED_LOAD_TS, target)
            held = spark.table(target).agg(F.count(F.lit(1)).alias("rows_held"), F.sum(F.length("review")).alias("chars_held")).first()
            row = spark.range(1).select(F.lit(run).alias("run"), F.lit(done["rows"]).cast("long").alias("rows_loaded"),
                                        F.lit(done["files"] > 0).alias("took_files"), F.lit(held[0]).cast("long").alias("rows_held"),
                                        F.lit(held[1]).cast("long").alias("chars_held"))
            out = row if out is None else out.union(row)
    return out


@register("q_merge_keys", """
SELECT user_id, event_id, ts, value FROM events WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
""")
def q_merge_keys(spark, sf_dir):
    """K1 kept by the target: three arrivals, the second twice, merged by key; the latest row of a key stays."""
    events = D.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    path, order = scratch_path(spark, "keyed"), [F.col("ts").desc(), F.col("event_id").asc()]
    for k in (1, 2, 1, 0):
        merge_by_key(events.where(F.pmod("event_id", F.lit(3)) == k), path, ["user_id"], order, buckets=16)
    return read_keyed(spark, path, events.withColumn("key_bucket", F.lit(0)).schema).drop("key_bucket")


@register("q_run_ledger", f"""
WITH n AS (SELECT count(*) AS rows, count(*) FILTER (octet_length(encode(text)) > 65535) AS long_text FROM conversations)
SELECT t.target, t.state, c.name AS counted, CAST(c.n AS BIGINT) AS n FROM n,
  (VALUES ('{S.HOSPITAL_REVIEWS.name}', 'done'), ('absent', 'no target')) t(target, state),
  LATERAL (VALUES ('read', rows), ('rejected', long_text), ('rows', rows - long_text), ('none', 0)) c(name, n)
WHERE (c.name = 'none') = (t.state = 'no target')
""")
def q_run_ledger(spark, sf_dir):
    """G1 with S6/S7: the tables are created, a load goes to one that is there and one that is not, and the ledger tells what became of them."""
    docs = D.review_documents(D.table(spark, sf_dir, "conversations")).withColumn("city_slug", X.slug("city"))
    landing, ledger = scratch_path(spark, "landing"), Ledger(spark, scratch_path(spark, "ledger"))
    _land(docs, landing)
    with _database(spark) as db:
        S.create_target_tables(spark, db)
        for name in (S.HOSPITAL_REVIEWS.name, "absent"):
            PL.load_new_reviews(spark, landing, ledger, D.FIXED_LOAD_TS, f"{db}.{name}", rejects_path=scratch_path(spark, "rejects"))
    done = ledger.runs().where("state <> 'begun'").withColumn("target", F.substring_index("target", ".", -1))
    counted = F.when(F.col("state") == "no target", F.array(F.struct(F.lit("none").alias("name"), F.lit(0).cast("long").alias("n")))).otherwise(F.array(
        *[F.struct(F.lit(k).alias("name"), F.coalesce(F.col("counts")[k], F.lit(0)).cast("long").alias("n")) for k in ("read", "rejected")],
        F.struct(F.lit("rows").alias("name"), F.col("rows").alias("n"))))
    return done.select("target", "state", F.explode(counted).alias("c")).select("target", "state", F.col("c.name").alias("counted"), F.col("c.n").alias("n"))


@register("q_landing_as_of", """
WITH d AS (SELECT conv_id % 2 = 0 AS even, length(text) AS n FROM conversations)
SELECT k AS reader, CAST(count(*) FILTER (k = 4 OR even) AS BIGINT) AS reviews, CAST(sum(n) FILTER (k = 4 OR even) AS BIGINT) AS chars
FROM d, (VALUES (1), (2), (3), (4)) v(k) GROUP BY k
""")
def q_landing_as_of(spark, sf_dir):
    """A landing of half the documents, one that was lost half-way, one of all; what readers of four times get."""
    docs = D.review_documents(D.table(spark, sf_dir, "conversations")).withColumn("city_slug", X.slug("city"))
    even = F.expr("cast(regexp_extract(data[0].place_id, '[0-9]+$', 0) AS long) % 2 = 0")
    path, options = scratch_path(spark, "landings"), {"constants": {"disclaimer": K.DEFAULT_DISCLAIMER}}
    LA.land(docs.where(even), path, "2024-03-01 10:00:00", **options)
    LA.write_files(docs.where(~even), path, "2024-03-02 10:00:00", **options)       # ... and here the job is lost
    LA.land(docs, path, "2024-03-03 10:00:00", **options)
    out = None
    for reader, at in ((1, "2024-03-01 10:00:00"), (2, "2024-03-02 12:00:00"), (3, "2024-03-03 09:59:59"), (4, None)):
        reviews = flatten_reviews(LA.read_as_of(spark, path, PL.REVIEW_READ_SCHEMA, at))
        row = reviews.agg(F.count(F.lit(1)).alias("reviews"), F.sum(F.length("review")).alias("chars")).select(F.lit(reader).alias("reader"), "reviews", "chars")
        out = row if out is None else out.union(row)
    return out
