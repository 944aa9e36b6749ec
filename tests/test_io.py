import json
import os

import pytest
from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.plans import derive as D
from reviewflow.plans import flows as PL
from reviewflow.sinks import envelope as EN
from reviewflow.sinks import tables as TB
from reviewflow.sources.landing import NoLandedFiles, has_landed_file, landed_file_count, scan_landing
from tests.conftest import SF_SMALL


def _place(name, **kw):
    p = {"name": name, "business_status": "OPERATIONAL", "formatted_address": f"{name} street",
         "geometry": {"location": {"lat": 12.9, "lng": 77.5}}, "opening_hours": {"open_now": True},
         "rating": 4, "user_ratings_total": 120, "types": ["hospital", "health"], "place_id": f"id-{name}"}
    p.update(kw)
    return {k: v for k, v in p.items() if v is not ...}


def _write(path, obj, pretty=True):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        if isinstance(obj, str):
            f.write(obj)
        else:
            json.dump(obj, f, indent=4 if pretty else None, ensure_ascii=False)


@pytest.fixture()
def landing(tmp_path):
    root = str(tmp_path / "hospital_lists")
    _write(f"{root}/hospitals_in_Pune_20250101_000000.json", {"results": [
        _place("Ruby"), _place("Säge Klinik", rating=3.5), _place("NoGeo", geometry=...),
        _place("NoHours", opening_hours=...), _place("NullRating", rating=None), _place("NullTypes", types=None)]})
    _write(f"{root}/nested/city2/hospitals_in_Goa_20250101_000000.json", {"results": []})
    _write(f"{root}/nested/city2/hospitals_in_Goa_20250102_000000.json", {"results": [_place("Goa Med")]})
    _write(f"{root}/notes.txt", "not json")
    return root


def test_scan_landing_recursive_suffix_and_explicit_schema(spark, landing):
    docs = scan_landing(spark, landing, S.PLACES_DOCUMENT, multi_line=True)
    assert landed_file_count(docs) == 3                      # .txt neighbour ignored, nested folder found
    flat = PL.places_frame(docs, "2025-01-01 00:00:00")
    good, bad = __import__("reviewflow.operators.clean", fromlist=["x"]).split_conformed(flat)
    names = sorted(r.name for r in good.collect())
    assert names == ["Goa Med", "NoHours", "NullTypes", "Ruby", "Säge Klinik"]   # NoGeo, NullRating dropped
    r = {x.name: x for x in good.collect()}
    assert r["NoHours"].open_now is None and r["Ruby"].open_now == "true" and r["NullTypes"].types == ""
    assert abs(r["Säge Klinik"].rating - 3.5) < 1e-6 and r["Ruby"].types == "hospital,health"


def test_scan_landing_empty_folder_raises(spark, tmp_path):
    os.makedirs(tmp_path / "empty", exist_ok=True)
    with pytest.raises(NoLandedFiles):
        scan_landing(spark, str(tmp_path / "empty"), S.PLACES_DOCUMENT)
    with pytest.raises(NoLandedFiles):
        scan_landing(spark, str(tmp_path / "missing"), S.PLACES_DOCUMENT)
    _write(str(tmp_path / "empty" / "_SUCCESS"), "")
    _write(str(tmp_path / "empty" / "readme.txt"), "x")
    assert not has_landed_file(spark, str(tmp_path / "empty"))
    with pytest.raises(NoLandedFiles):
        scan_landing(spark, str(tmp_path / "empty"), S.PLACES_DOCUMENT)


def test_malformed_file_kept_as_corrupt_record(spark, tmp_path):
    root = str(tmp_path / "m")
    _write(f"{root}/good.json", {"results": [_place("A")]})
    _write(f"{root}/bad.json", "{not json")
    docs = scan_landing(spark, root, S.PLACES_DOCUMENT, multi_line=True, corrupt_col="_corrupt")
    rows = docs.collect()
    assert len(rows) == 2 and sum(1 for x in rows if x._corrupt is not None) == 1


def test_envelope_round_trip_and_file_count(spark, tmp_path):
    conv = D.table(spark, SF_SMALL, "conversations")
    docs = D.review_documents(conv).withColumn("city_slug", F.col("city"))
    out = str(tmp_path / "reviews_landing")
    EN.write_envelope(docs, out, root="data", constants={"disclaimer": "x"}, mode="overwrite")
    assert any(d.startswith("city_slug=") for d in os.listdir(out))
    back = scan_landing(spark, out, S.REVIEWS_DOCUMENT, multi_line=False, with_file=True)
    assert back.select("source_file").distinct().count() == landed_file_count(back)
    a = PL.reviews_frame(back.drop("source_file"), "2025-01-01 00:00:00")
    b = PL.reviews_frame(docs, "2025-01-01 00:00:00")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == conv.count()


def test_landing_names(spark):
    df = spark.createDataFrame([("New Delhi",)], "city string")
    ts = F.to_timestamp(F.lit("2025-03-04 05:06:07"))
    r = df.select(EN.landing_name("city", ts), EN.landing_name("city", ts, folder="lists", kind="lists")).first()
    assert tuple(r) == ("new_delhi_hospital_reviews.json", "lists/hospitals_in_New_Delhi_20250304_050607.json")


def test_guarded_append_catalog_and_observed_count(spark):
    df = spark.createDataFrame([("a", 1.0)], "name string, rating double")
    assert TB.guarded_append(df, "rf_missing_table") is False
    spark.sql("CREATE TABLE IF NOT EXISTS rf_target (rating double, name string) USING parquet")
    assert TB.guarded_append(df, "rf_target") is True
    assert TB.guarded_append(df, "rf_target") is True        # append mode, not ErrorIfExists
    assert spark.table("rf_target").count() == 2
    out, obs = TB.observed(df)
    out.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 1


def test_load_reviews_flow_into_catalog_table(spark, tmp_path):
    conv = D.table(spark, SF_SMALL, "conversations")
    out = str(tmp_path / "landing")
    EN.write_envelope(D.review_documents(conv).withColumn("city_slug", F.col("city")), out,
                      constants={"disclaimer": "x"})
    spark.sql("CREATE DATABASE IF NOT EXISTS rf_flow")
    S.create_target_tables(spark, "rf_flow")
    res = PL.load_reviews(spark, out, "2025-01-01 00:00:00", table="rf_flow.hospitals_reviews_ingestion",
                          multi_line=False)
    assert res["written"] and spark.table("rf_flow.hospitals_reviews_ingestion").count() == conv.count()
    res = PL.label_reviews(spark, "rf_flow.hospitals_reviews_ingestion", "rf_flow.gcp_hospital_sentiment")
    assert res["written"]
    t = spark.table("rf_flow.gcp_hospital_sentiment")
    assert t.count() == t.select("author_id").distinct().count() > 0


def test_jdbc_options_are_assembled_without_connecting():
    from reviewflow.sources.jdbc import _quote, jdbc_options
    o = jdbc_options("jdbc:mysql://h/db", "t", "u", "p", "drv", batchsize=1000, numPartitions=None)
    assert o == {"url": "jdbc:mysql://h/db", "dbtable": "t", "user": "u", "password": "p", "driver": "drv",
                 "batchsize": "1000"}
    assert _quote("it's") == "'it''s'"


def test_envelope_rebalance_keeps_few_files_per_city(spark, tmp_path):
    conv = D.table(spark, SF_SMALL, "conversations").repartition(6)
    docs = D.review_documents(conv).withColumn("city_slug", F.col("city"))
    out = str(tmp_path / "rebalanced")
    EN.write_envelope(docs, out, root="data", constants={"disclaimer": "x"}, mode="overwrite")
    cities = [d for d in os.listdir(out) if d.startswith("city_slug=")]
    files = sum(len([f for f in os.listdir(os.path.join(out, c)) if f.endswith(".json")]) for c in cities)
    assert files <= 2 * len(cities)
    back = scan_landing(spark, out, S.REVIEWS_DOCUMENT)
    assert PL.reviews_frame(back, "2025-01-01 00:00:00").count() == conv.count()


def test_compact_landing_to_parquet(spark, landing, tmp_path):
    from reviewflow.sources.landing import compact_landing
    out = str(tmp_path / "compact")
    n = compact_landing(spark, landing, out, S.PLACES_DOCUMENT)
    assert n == 3
    docs = spark.read.parquet(out)
    assert "source_file" in docs.columns
    good, _ = __import__("reviewflow.operators.clean", fromlist=["x"]).split_conformed(
        PL.places_frame(docs.drop("source_file"), "2025-01-01 00:00:00"))
    assert good.count() == 5


def test_loader_counts_malformed_documents(spark, tmp_path):
    root = str(tmp_path / "lists")
    _write(f"{root}/a.json", {"results": [_place("A"), _place("B")]})
    _write(f"{root}/bad.json", "{not json")
    spark.sql("CREATE DATABASE IF NOT EXISTS rf_corrupt")
    S.create_target_tables(spark, "rf_corrupt")
    res = PL.load_places(spark, root, "2025-01-01 00:00:00", table="rf_corrupt.hospital_lists_ingestion",
                         multi_line=True)
    assert res["rows"] == 2 and res["corrupt_documents"] == 1 and res["files"] == 2
    skipped = PL.load_places(spark, root, "2025-01-01 00:00:00", table="rf_corrupt.no_such_table", multi_line=True)
    assert skipped["written"] is False and "corrupt_documents" not in skipped


def test_scan_landing_reads_gzip_documents_too(spark, tmp_path):
    import gzip
    root = tmp_path / "gz"
    root.mkdir()
    (root / "a.json").write_text(json.dumps({"results": [_place("A")]}) + "\n")
    with gzip.open(root / "b.json.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps({"results": [_place("B")]}) + "\n")
    only_json = scan_landing(spark, str(root), S.PLACES_DOCUMENT)
    both = scan_landing(spark, str(root), S.PLACES_DOCUMENT, suffix=(".json", ".json.gz"))
    assert only_json.count() == 1 and both.count() == 2
    assert sorted(r.name for r in both.selectExpr("inline(results)").collect()) == ["A", "B"]
