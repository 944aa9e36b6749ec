import json

from reviewflow import schemas as S
from reviewflow.sources.landing import scan_landing


def test_narrow_prunes_structs_inside_arrays():
    keep = {"results": {"name": True, "geometry": {"location": {"lat": True}}}}
    n = S.narrow(S.PLACES_DOCUMENT, keep)
    place = n["results"].dataType.elementType
    assert place.fieldNames() == ["name", "geometry"]
    assert place["geometry"].dataType["location"].dataType.fieldNames() == ["lat"]


def test_narrow_schema_reaches_the_json_scan(spark, tmp_path):
    p = tmp_path / "docs"
    p.mkdir()
    doc = {"results": [{"name": "A", "rating": 4.0, "geometry": {"location": {"lat": 1.0, "lng": 2.0}},
                        "types": ["h"]}]}
    (p / "a.json").write_text(json.dumps(doc) + "\n")
    n = S.narrow(S.PLACES_DOCUMENT, {"results": {"name": True, "geometry": {"location": {"lat": True}}}})
    df = scan_landing(spark, str(p), n).selectExpr("inline(results)")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "lng" not in plan and "rating" not in plan
    r = df.first()
    assert r.name == "A" and r.geometry.location.lat == 1.0


def test_table_specs_match_the_ddl_contract():
    assert [c.sql for c in S.HOSPITAL_LISTS.columns][1] == "varchar(100)"
    assert S.HOSPITAL_REVIEWS.spark_schema()["translated"].dataType.simpleString() == "tinyint"
    assert S.SCORE_SENTIMENT.spark_schema()["author_id"].nullable is False
    assert "`sentiment_score` float" in S.SCORE_SENTIMENT.ddl()
