"""Extraction side end to end: raw pages / places + details → landed documents → loaders."""

from datetime import datetime

from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.operators.clean import split_conformed
from reviewflow.plans import flows as PL
from reviewflow.sources.landing import scan_landing


def _place(pid, name):
    return {"name": name, "business_status": "OPERATIONAL", "formatted_address": f"{name} road",
            "geometry": {"location": {"lat": 1.0, "lng": 2.0}}, "opening_hours": {"open_now": False},
            "rating": 4.0, "user_ratings_total": 10, "types": ["hospital"], "place_id": pid}


def test_land_places_then_load(spark, tmp_path):
    schema = S.T.StructType(S.PAGE.fields + [S.T.StructField("city", S.T.StringType())])
    pages = spark.createDataFrame([
        {"request_id": "r1", "page_no": 1, "status": "OK", "next_page_token": "t", "city": "Pune",
         "results": [_place("a", "A"), _place("b", "B")]},
        {"request_id": "r1", "page_no": 2, "status": "OK", "next_page_token": None, "city": "Pune",
         "results": [_place("c", "C")]},
        {"request_id": "r2", "page_no": 1, "status": "OVER_QUERY_LIMIT", "next_page_token": None, "city": "Goa",
         "results": [_place("x", "X")]},
    ], schema)
    out = str(tmp_path / "lists")
    PL.land_places(spark, pages, out)
    docs = scan_landing(spark, out, S.PLACES_DOCUMENT)
    good, _ = split_conformed(PL.places_frame(docs, "2025-01-01 00:00:00"))
    assert sorted(r.name for r in good.collect()) == ["A", "B", "C"]


def test_land_reviews_then_load(spark, tmp_path):
    places = spark.createDataFrame([("p1", "H1", None, 4.5, 10, "New Delhi"), ("p2", "H2", "x", 3.0, 5, "Pune"),
                                    ("p3", "H3", "y", 2.0, 1, "Pune")],
                                   "place_id string, name string, formatted_address string, hospital_rating double, "
                                   "user_ratings_total long, city string")
    rev = {"author_name": "Ann", "rating": 5, "text": "superb", "time": 1700000000, "translated": None,
           "original_language": None}
    details = spark.createDataFrame([
        {"place_id": "p1", "ok": True, "fetched_at": datetime(2024, 1, 1), "reviews": [rev] * 7},
        {"place_id": "p2", "ok": True, "fetched_at": datetime(2024, 1, 1), "reviews": []},
        {"place_id": "p3", "ok": False, "fetched_at": datetime(2024, 1, 1), "reviews": [rev]},
    ], S.DETAIL)
    out = str(tmp_path / "reviews")
    totals = PL.land_reviews(spark, places, details, out, min_count=20)
    assert totals == {"total_reviews": 40, "total_hospitals": 2}
    docs = scan_landing(spark, out, PL.REVIEW_READ_SCHEMA)
    good, bad = split_conformed(PL.reviews_frame(docs, "2025-01-01 00:00:00"))
    counts = {r.place_id: r.n for r in good.groupBy("place_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"p1": 20, "p2": 20} and bad.count() == 0
    real = good.filter("place_id = 'p1' and author_name = 'Ann'").collect()
    assert len(real) == 5 and all(r.original_language == "en" and r.translated == 0 for r in real)
    flat = PL.land_reviews_frame(places, details, min_count=20).filter("author_name = 'Ann'").collect()
    assert {(r.review_type, r.date) for r in flat} == {("real", "2023-11-14")}
    assert good.filter("place_id = 'p1'").select("address").distinct().first()[0] == "N/A"
    import os
    assert sorted(d for d in os.listdir(out) if d.startswith("city_slug=")) == ["city_slug=new_delhi", "city_slug=pune"]


def test_jobs_entry_point(spark, tmp_path):
    from reviewflow import jobs
    places = spark.createDataFrame([("p1", "H1", "addr", 4.5, 10, "Pune")],
                                   "place_id string, name string, formatted_address string, hospital_rating double, "
                                   "user_ratings_total long, city string")
    details = spark.createDataFrame([{"place_id": "p1", "ok": True, "fetched_at": datetime(2024, 1, 1),
                                      "reviews": [{"author_name": "Ann", "text": "great", "time": 1}]}], S.DETAIL)
    pp, dp, out = str(tmp_path / "places"), str(tmp_path / "details"), str(tmp_path / "land")
    places.write.parquet(pp)
    details.write.parquet(dp)
    jobs.main(["land-reviews", "--places", pp, "--details", dp, "--out", out])
    spark.sql("CREATE DATABASE IF NOT EXISTS rf_jobs")
    S.create_target_tables(spark, "rf_jobs")
    res = jobs.main(["load-reviews", "--landing", out, "--table", "rf_jobs.hospitals_reviews_ingestion"])
    assert res["written"] and spark.table("rf_jobs.hospitals_reviews_ingestion").count() == 100
    res = jobs.main(["label-reviews", "--source-table", "rf_jobs.hospitals_reviews_ingestion",
                     "--target-table", "rf_jobs.gcp_hospital_sentiment"])
    assert res["written"] and spark.table("rf_jobs.gcp_hospital_sentiment").count() > 0


def test_load_with_rejects_counts_every_row(spark, tmp_path):
    """Over-long place_id (VARCHAR(100)) rows go to the rejects path, the rest to the table."""
    places = spark.createDataFrame([("p" * 150, "Long", "a", 4.0, 1, "Pune"), ("ok", "Short", "b", 3.0, 1, "Pune")],
                                   "place_id string, name string, formatted_address string, hospital_rating double, "
                                   "user_ratings_total long, city string")
    details = spark.createDataFrame([{"place_id": "p" * 150, "ok": True, "fetched_at": datetime(2024, 1, 1),
                                      "reviews": []},
                                     {"place_id": "ok", "ok": True, "fetched_at": datetime(2024, 1, 1),
                                      "reviews": []}], S.DETAIL)
    land, rej = str(tmp_path / "land"), str(tmp_path / "rej")
    PL.land_reviews(spark, places, details, land, min_count=3)
    spark.sql("CREATE DATABASE IF NOT EXISTS rf_rej")
    S.create_target_tables(spark, "rf_rej")
    res = PL.load_reviews(spark, land, "2025-01-01 00:00:00", table="rf_rej.hospitals_reviews_ingestion",
                          rejects_path=rej)
    assert res == {"files": res["files"], "written": True, "rows": 3, "rejected": 3, "corrupt_documents": 0, "read": 6, "conformed": 6}
    assert spark.read.parquet(rej).filter("_errors = 'place_id'").count() == 3


def test_land_reviews_rerun_is_idempotent(spark, tmp_path):
    places = spark.createDataFrame([("p1", "H1", "a", 4.0, 1, "Pune"), ("p2", "H2", "b", 3.0, 1, "Goa")],
                                   "place_id string, name string, formatted_address string, hospital_rating double, "
                                   "user_ratings_total long, city string")
    details = spark.createDataFrame([{"place_id": p, "ok": True, "fetched_at": datetime(2024, 1, 1), "reviews": []}
                                     for p in ("p1", "p2")], S.DETAIL)
    out = str(tmp_path / "land")
    PL.land_reviews(spark, places, details, out, min_count=4)
    PL.land_reviews(spark, places.filter("city = 'Pune'"), details, out, min_count=4)   # re-run one city
    docs = scan_landing(spark, out, PL.REVIEW_READ_SCHEMA)
    counts = {r.place_id: r.n for r in PL.reviews_frame(docs, "2025-01-01 00:00:00")
              .groupBy("place_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"p1": 4, "p2": 4}


def test_land_synthetic_then_load(spark, tmp_path):
    from reviewflow import jobs
    out = str(tmp_path / "synthetic")
    res = jobs.main(["land-synthetic", "--cities", "Pune, New Delhi", "--out", out])
    assert (res["total_hospitals"], res["total_reviews"]) == (10, 1000)
    docs = scan_landing(spark, out, PL.REVIEW_READ_SCHEMA)
    flat = PL.reviews_frame(docs, "2025-01-01 00:00:00")
    good, bad = split_conformed(flat)
    assert good.count() == 2 * 5 * 100 and bad.count() == 0
    per = {r.hospital_name: r.n for r in good.groupBy("hospital_name").agg(F.count("*").alias("n")).collect()}
    assert len(per) <= 10 and sum(per.values()) == 1000
    assert good.filter(F.col("place_id").isNotNull()).count() == 0
    import os
    assert sorted(d for d in os.listdir(out) if d.startswith("city_slug=")) == ["city_slug=new_delhi", "city_slug=pune"]


def test_label_rerun_appends_only_new_keys(spark, tmp_path):
    places = spark.createDataFrame([("p1", "H1", "a", 4.0, 1, "Pune")],
                                   "place_id string, name string, formatted_address string, hospital_rating double, "
                                   "user_ratings_total long, city string")
    details = spark.createDataFrame([{"place_id": "p1", "ok": True, "fetched_at": datetime(2024, 1, 1),
                                      "reviews": [{"author_name": "Ann", "text": "superb", "time": 1}]}], S.DETAIL)
    land = str(tmp_path / "land")
    PL.land_reviews(spark, places, details, land, min_count=30)
    spark.sql("CREATE DATABASE IF NOT EXISTS rf_rerun")
    S.create_target_tables(spark, "rf_rerun")
    PL.load_reviews(spark, land, "2025-01-01 00:00:00", table="rf_rerun.hospitals_reviews_ingestion")
    first = PL.label_reviews(spark, "rf_rerun.hospitals_reviews_ingestion", "rf_rerun.gcp_hospital_sentiment")
    again = PL.label_reviews(spark, "rf_rerun.hospitals_reviews_ingestion", "rf_rerun.gcp_hospital_sentiment")
    t = spark.table("rf_rerun.gcp_hospital_sentiment")
    assert first["rows"] > 0 and again["rows"] == 0
    assert t.count() == t.select("author_id").distinct().count() == first["rows"]


def test_jobs_load_places_from_pretty_documents_with_rejects(spark, tmp_path):
    import json
    import os

    from reviewflow import jobs
    root = tmp_path / "hospital_lists"
    os.makedirs(root / "2025")
    long_status = "X" * 120                                   # business_status is VARCHAR(100)
    doc = {"results": [_place("a", "Alpha"), {**_place("b", "Beta"), "business_status": long_status},
                       {**_place("c", "NoGeo"), "geometry": None}]}
    (root / "2025" / "hospitals_in_Pune_20250101_000000.json").write_text(json.dumps(doc, indent=4))
    (root / "notes.txt").write_text("ignore me")
    spark.sql("CREATE DATABASE IF NOT EXISTS rf_cli")
    S.create_target_tables(spark, "rf_cli")
    res = jobs.main(["load-places", "--landing", str(root), "--multi-line", "--table", "rf_cli.hospital_lists_ingestion",
                     "--rejects", str(tmp_path / "rej")])
    assert res["files"] == 1 and res["rows"] == 1 and res["rejected"] == 1 and res["corrupt_documents"] == 0
    assert [r.name for r in spark.table("rf_cli.hospital_lists_ingestion").collect()] == ["Alpha"]
    assert spark.read.parquet(str(tmp_path / "rej")).first()._errors == "business_status"


def test_multiline_scan_lands_a_hot_hospital_in_chunks(spark, tmp_path):
    from reviewflow.plans.registry import QUERIES
    turns = spark.range(2500).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "concat('text ', id) AS text")
    turns.union(spark.sql("SELECT 8L, 0L, 'system', 'other'")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["q_multiline_scan"](spark, str(tmp_path))
    assert len(got.inputFiles()) == 4           # three chunks and the other hospital of the same city
    assert sorted(r.review for r in got.collect()) == sorted(["other", *(f"text {i}" for i in range(2500))])
