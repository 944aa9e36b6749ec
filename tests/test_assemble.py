from datetime import datetime

from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.operators import assemble as AS

PAGE_SCHEMA = "request_id string, page_no int, status string, next_page_token string, results array<string>"


def _pages(spark, rows):
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def test_assemble_pages_cases(spark):
    rows = [
        ("ok", 1, "OK", "t1", ["a", "b"]), ("ok", 2, "OK", "t2", ["c"]), ("ok", 3, "OK", None, ["d"]),
        ("zero", 1, "ZERO_RESULTS", None, ["z"]),
        ("badfirst", 1, "REQUEST_DENIED", "t", ["x"]), ("badfirst", 2, "OK", None, ["y"]),
        ("emptyfirst", 1, "OK", "t", []), ("emptyfirst", 2, "OK", None, ["y"]),
        ("bad2", 1, "OK", "t", ["a"]), ("bad2", 2, "INVALID_REQUEST", "t", ["b"]), ("bad2", 3, "OK", None, ["c"]),
        ("zero2", 1, "OK", "t", ["a"]), ("zero2", 2, "ZERO_RESULTS", "t", ["b"]), ("zero2", 3, "OK", None, ["c"]),
        ("notoken", 1, "OK", None, ["a"]), ("notoken", 2, "OK", None, ["b"]),
        ("gap", 1, "OK", "t", ["a"]), ("gap", 3, "OK", None, ["c"]),
        ("nofirst", 2, "OK", None, ["b"]),
    ]
    out = AS.assemble_pages(_pages(spark, rows)).collect()
    got = sorted((r.request_id, r.page_no, r.pos, r.result) for r in out)
    assert got == sorted([
        ("ok", 1, 0, "a"), ("ok", 1, 1, "b"), ("ok", 2, 0, "c"), ("ok", 3, 0, "d"),
        ("zero", 1, 0, "z"),
        ("bad2", 1, 0, "a"), ("zero2", 1, 0, "a"), ("notoken", 1, 0, "a"), ("gap", 1, 0, "a"),
    ])
    oc = {r.request_id: (r.outcome, r.n_pages, r.n_results) for r in AS.request_outcomes(_pages(spark, rows)).collect()}
    assert oc["ok"] == ("ok", 3, 4) and oc["badfirst"] == ("failed", 0, 0) and oc["emptyfirst"] == ("empty", 0, 0)
    assert oc["nofirst"] == ("failed", 0, 0) and oc["bad2"] == ("ok", 1, 1)


def test_assembled_output_is_a_prefix(spark):
    rows = [("r", i, "OK" if i != 7 else "BAD", "t", [str(i)]) for i in range(1, 12)]
    got = sorted(r.page_no for r in AS.assemble_pages(_pages(spark, rows)).collect())
    assert got == list(range(1, 7))


def _review(i):
    return {"author_name": f"a{i}", "text": f"t{i}", "rating": 5, "time": 1700000000 + i}


def test_attach_details_cases(spark):
    places = spark.createDataFrame([("p0", "H0"), ("p3", "H3"), ("p7", "H7"), ("pfail", "HF"), ("pmiss", "HM"),
                                    (None, "HN"), ("pdup", "HD")], "place_id string, name string")
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    details = spark.createDataFrame([
        {"place_id": "p0", "ok": True, "fetched_at": t0, "reviews": []},
        {"place_id": "p3", "ok": True, "fetched_at": t0, "reviews": [_review(i) for i in range(3)]},
        {"place_id": "p7", "ok": True, "fetched_at": t0, "reviews": [_review(i) for i in range(7)]},
        {"place_id": "pfail", "ok": False, "fetched_at": t0, "reviews": None},
        {"place_id": None, "ok": True, "fetched_at": t0, "reviews": [_review(0)]},
        {"place_id": "pdup", "ok": True, "fetched_at": t0, "reviews": [_review(0)]},
        {"place_id": "pdup", "ok": True, "fetched_at": t1, "reviews": [_review(1), _review(2)]},
    ], S.DETAIL)
    out = {r.place_id: r for r in AS.attach_details(places, details).collect()}
    assert set(out) == {"p0", "p3", "p7", "pdup"}
    assert len(out["p0"].reviews) == 0 and len(out["p3"].reviews) == 3
    assert [x.author_name for x in out["p7"].reviews] == [f"a{i}" for i in range(5)]
    assert [x.author_name for x in out["pdup"].reviews] == ["a1", "a2"]


def test_union_and_totals(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    u = AS.union_batches(a, b)
    assert sorted(u.columns) == ["a", "b", "id"] and u.count() == 2
    docs = spark.createDataFrame([
        {"disclaimer": "d", "data": [{"name": "H1", "reviews": [_review(0), _review(1)]}, {"name": "H2", "reviews": None}]},
        {"disclaimer": "d", "data": [{"name": "H3", "reviews": [_review(2)]}]},
    ], S.REVIEWS_DOCUMENT)
    r = AS.batch_totals(docs).first()
    assert (r.total_hospitals, r.total_reviews) == (3, 3)


def test_first_n_null_array(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6],), (None,)], "a array<int>")
    assert [r[0] for r in df.select(AS.first_n("a", 5)).collect()] == [[1, 2, 3, 4, 5], []]
    assert F is not None
