"""Plan shapes that matter at scale: shuffles, partial top-n, pushdown, Python nodes."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from reviewflow.operators import augment as AU
from reviewflow.operators import flatten as FL
from reviewflow.plans import derive as D
from tests.conftest import SF_SMALL
from tools.plan_summary import summarise


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_attach_details_uses_one_key_shuffle(spark):
    s = summarise(_plan(E.queries()["q_attach_details"](spark, SF_SMALL)))
    assert s["shuffles"] - s["round_robin"] == 1 and s["partial_limit"] == 1


def test_landing_flow_pads_without_extra_shuffles(spark):
    s = summarise(_plan(E.queries()["q_land_reviews"](spark, SF_SMALL)))
    # stand-in nest + attach dedup; padding adds none
    assert s["shuffles"] - s["round_robin"] <= 2 and s["python"] == 0


def test_pad_children_and_flatten_are_narrow(spark):
    docs = D.review_documents(D.table(spark, SF_SMALL, "conversations"))
    flat = FL.flatten_reviews(docs.repartition(3))
    assert summarise(_plan(flat))["shuffles"] == 2          # the stand-in nest + the explicit repartition
    arr = docs.select(F.col("conv_id"), F.col("data")[0]["reviews"].alias("reviews")).repartition(3, "conv_id")
    padded = AU.pad_children(arr, "reviews", ["conv_id"], min_count=10)
    s = summarise(_plan(padded))
    assert s["shuffles"] == summarise(_plan(arr))["shuffles"]


def test_scorers_stay_in_the_jvm_unless_pluggable(spark):
    assert summarise(_plan(E.queries()["q_lexicon_score"](spark, SF_SMALL)))["python"] == 0
    assert summarise(_plan(E.queries()["q_label_reviews_model"](spark, SF_SMALL)))["python"] == 0
    assert summarise(_plan(E.queries()["q_score_text"](spark, SF_SMALL)))["python"] == 1


def test_no_explicit_broadcast_hints_in_library():
    import pathlib
    src = "\n".join(p.read_text() for p in pathlib.Path(__file__).resolve().parents[1].joinpath("reviewflow")
                    .rglob("*.py"))
    assert "F.broadcast(" not in src and ".hint(\"broadcast\"" not in src and "localCheckpoint" not in src


def test_bucketed_tables_make_label_dedup_and_key_antijoin_shuffle_free(spark, tmp_path):
    from reviewflow import jobs
    from reviewflow.plans import flows as PL
    from reviewflow.sinks import envelope as EN
    conv = D.table(spark, SF_SMALL, "conversations")
    land = str(tmp_path / "land")
    EN.write_envelope(D.review_documents(conv).withColumn("city_slug", F.col("city")), land,
                      constants={"disclaimer": "x"}, mode="overwrite")
    jobs.main(["create-tables", "--database", "rf_bucketed", "--buckets", "4"])
    PL.load_reviews(spark, land, "2025-01-01 00:00:00", table="rf_bucketed.hospitals_reviews_ingestion")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = PL.label_frame(spark.table("rf_bucketed.hospitals_reviews_ingestion"))
        keys = spark.table("rf_bucketed.gcp_hospital_sentiment").select("author_id")
        plan = _plan(frame.join(keys, ["author_id"], "left_anti"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan
    res = PL.label_reviews(spark, "rf_bucketed.hospitals_reviews_ingestion", "rf_bucketed.gcp_hospital_sentiment")
    assert res["written"] and res["rows"] == spark.table("rf_bucketed.gcp_hospital_sentiment").count()
