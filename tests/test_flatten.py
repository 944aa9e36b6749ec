from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.operators import flatten as FL
from reviewflow.plans import derive as D
from tests.conftest import SF_SMALL


def _place(name="A", types=("a", "b"), lat=1.0, open_now=True):
    return {"name": name, "business_status": "OPERATIONAL", "formatted_address": "x",
            "geometry": {"location": {"lat": lat, "lng": 2.0}} if lat is not None else None,
            "opening_hours": {"open_now": open_now} if open_now is not None else None,
            "rating": 4.5, "user_ratings_total": 10, "types": list(types) if types is not None else None,
            "place_id": "p"}


def test_flatten_places_inner_explode_and_types(spark):
    docs = spark.createDataFrame([
        {"results": [_place("A"), _place("B", types=None), _place("C", types=("x", None, "y")),
                     _place("D", types=()), _place("E", lat=None, open_now=None)]},
        {"results": []},
        {"results": None},
    ], S.PLACES_DOCUMENT)
    rows = {r.name: r for r in FL.flatten_places(docs).collect()}
    assert set(rows) == {"A", "B", "C", "D", "E"}
    assert rows["A"].types == "a,b" and rows["B"].types == "" and rows["C"].types == "x,y" and rows["D"].types == ""
    assert rows["E"].latitude is None and rows["E"].open_now is None
    assert rows["A"].latitude == 1.0 and rows["A"].longitude == 2.0 and rows["A"].open_now is True


def test_flatten_reviews_two_levels(spark):
    docs = D.review_documents(D.table(spark, SF_SMALL, "conversations"))
    flat = FL.flatten_reviews(docs, with_extras=True, with_position=True)
    n_src = D.table(spark, SF_SMALL, "conversations").count()
    assert flat.count() == n_src
    assert "review" in flat.columns and "text" not in flat.columns        # D1
    assert dict(flat.dtypes)["time"] == "timestamp" and dict(flat.dtypes)["translated"] == "int"


def test_nested_null_and_empty_reviews_yield_nothing(spark):
    docs = spark.createDataFrame([
        {"disclaimer": "d", "data": [{"name": "H1", "reviews": None}, {"name": "H2", "reviews": []}]},
        {"disclaimer": "d", "data": None},
    ], S.REVIEWS_DOCUMENT)
    assert FL.flatten_reviews(docs).count() == 0


def test_nest_then_explode_is_identity(spark):
    conv = D.table(spark, SF_SMALL, "conversations")
    nested = FL.nest_children(conv, ["conv_id"], "turn", ["role", "text"], array_name="c")
    back = FL.unnest_children(nested, ["conv_id"], "c", pos="turn")
    a = conv.select("conv_id", "turn", "role", "text")
    assert back.select(a.columns).exceptAll(a).count() == 0 and a.exceptAll(back.select(a.columns)).count() == 0


def test_nest_chunks_are_bounded(spark):
    df = spark.range(0, 1000).select(F.lit(1).alias("k"), F.col("id").alias("pos"), (F.col("id") * 2).alias("v"))
    nested = FL.nest_children(df, ["k"], "pos", ["v"], array_name="c", chunk_size=64)
    sizes = [r[0] for r in nested.select(F.size("c")).collect()]
    assert max(sizes) <= 64 and sum(sizes) == 1000 and len(sizes) == 16
    back = FL.unnest_children(nested, ["k"], "c", chunk_size=64)
    assert back.filter(F.col("v") != F.col("pos") * 2).count() == 0


def test_narrow_schema_keeps_only_named_fields():
    from reviewflow.plans.flows import REVIEW_READ_SCHEMA
    rev = REVIEW_READ_SCHEMA["data"].dataType.elementType["reviews"].dataType.elementType
    assert "review_type" not in rev.fieldNames() and "text" in rev.fieldNames()
    assert "disclaimer" not in REVIEW_READ_SCHEMA.fieldNames()


def test_to_json_keeps_unicode_and_nulls(spark):
    df = spark.createDataFrame([("é", None)], "a string, b string")
    s = df.select(FL.to_json_text(F.struct("a", "b"))).first()[0]
    assert s == '{"a":"é","b":null}'


def test_project_dotted_paths_in_order(spark):
    df = spark.createDataFrame([{"h": {"name": "A", "loc": {"lat": 1.5}}, "x": 2}],
                               "h struct<name:string, loc:struct<lat:double>>, x long")
    out = FL.project(df, {"lat": "h.loc.lat", "hospital_name": "h.name", "twice": F.col("x") * 2})
    assert out.columns == ["lat", "hospital_name", "twice"] and tuple(out.first()) == (1.5, "A", 4)
