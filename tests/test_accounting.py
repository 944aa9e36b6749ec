"""Every row read is accounted for; nothing depends on a parent's or page's size; models load once per worker."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.operators import assemble as AS
from reviewflow.operators import augment as AU
from reviewflow.operators import clean as C
from reviewflow.operators import flatten as FL
from reviewflow.operators import sentiment as SE
from reviewflow.plans import flows as PL


def _review(i, **kw):
    return {"author_name": f"a{i}", "rating": 5, "text": f"t{i}", "language": "en", **kw}


def _land(spark, path, reviews, name="H"):
    df = spark.createDataFrame([{"disclaimer": "d", "data": [{"name": name, "place_id": "p", "reviews": reviews}]}], S.REVIEWS_DOCUMENT)
    df.write.mode("append").json(str(path))


def _tables(spark, db):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    S.create_target_tables(spark, db)
    return f"{db}.hospitals_reviews_ingestion"


def test_rows_that_do_not_fit_fail_the_load_without_a_rejects_path(spark, tmp_path):
    _land(spark, tmp_path / "land", [_review(1), _review(2, language="x" * 40), _review(3, rating=3_000_000_000)])
    table = _tables(spark, "rf_acc1")
    with pytest.raises(PL.RejectedRows) as e:
        PL.load_reviews(spark, str(tmp_path / "land"), "2025-01-01 00:00:00", table=table)
    assert e.value.counts["read"] == 3 and e.value.counts["rejected"] == 2 and spark.table(table).count() == 0
    out = PL.load_reviews(spark, str(tmp_path / "land"), "2025-01-01 00:00:00", table=table, rejects_path=str(tmp_path / "rej"))
    assert out["read"] == out["rows"] + out["rejected"] == 3
    reasons = {r._errors for r in spark.read.parquet(str(tmp_path / "rej")).collect()}
    assert reasons == {"language", "review_rating"}


def test_places_account_for_missing_columns(spark, tmp_path):
    place = {"name": "n", "formatted_address": "a", "rating": 4.0, "geometry": {"location": {"lat": 1.0, "lng": 2.0}}}
    spark.createDataFrame([{"results": [place, {**place, "rating": None}, {**place, "business_status": "b" * 200}]}],
                          S.PLACES_DOCUMENT).write.json(str(tmp_path / "land"))
    _tables(spark, "rf_acc2")
    out = PL.load_places(spark, str(tmp_path / "land"), "2025-01-01 00:00:00", table="rf_acc2.hospital_lists_ingestion",
                         rejects_path=str(tmp_path / "rej"))
    assert (out["read"], out["rows"], out["rejected"], out["missing_required"]) == (3, 1, 1, 1)


def test_labels_account_for_keys_and_score_only_new_ones(spark, tmp_path):
    table = _tables(spark, "rf_acc3")
    _land(spark, tmp_path / "land", [_review(1), _review(1), _review(2)])
    PL.load_reviews(spark, str(tmp_path / "land"), "2025-01-01 00:00:00", table=table)
    target = "rf_acc3.gcp_hospital_sentiment"
    spark.table(table).limit(1).withColumn("author_id", F.lit(None).cast("string")).write.mode("append").insertInto(table)
    seen = spark.sparkContext.accumulator(0)

    class Counting:
        def load(self):
            pass

        def score(self, texts):
            seen.add(len(texts))
            return pd.DataFrame({"label": ["Mixed"] * len(texts), "score": [0.0] * len(texts)})

    out = PL.label_reviews(spark, table, target, scorer=Counting())
    assert (out["read"], out["null_keys"], out["repeated_keys"], out["already_stored"], out["rows"], out["rejected"]) == (4, 1, 1, 0, 2, 0)
    assert seen.value == 2
    again = PL.label_reviews(spark, table, target, scorer=Counting())
    assert (again["read"], again["null_keys"], again["repeated_keys"], again["already_stored"], again["rows"]) == (4, 1, 1, 2, 0)
    assert seen.value == 2      # a re-run scores nothing


def test_labels_are_scored_above_the_dedup(spark):
    cols = "hospital_name string, address string, place_id string, author_name string, author_id string, review string, sentiments string"
    df = spark.createDataFrame([("h", "a", "p", "n", "1", "r", "")], cols)
    frame = PL.label_frame(df, scorer=SE.LexiconScorer(), native=False, load_ts="2025-01-01 00:00:00")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Window")        # nodes print from the top down
    row = frame.collect()[0]
    assert (row.place_id, row.method, str(row.loaddatetime)) == ("p", "LexiconScorer", "2025-01-01 00:00:00")


def test_first_per_author_is_the_same_whatever_the_order(spark):
    rows = [("h2", "a", "1", "same"), ("h1", "b", "1", "same"), ("h1", "a", "1", "same")]
    df = spark.createDataFrame([(h, a, "n", k, r, None) for h, a, k, r in rows],
                               "hospital_name string, address string, author_name string, author_id string, review string, sentiment string")
    for order in (df, df.orderBy("hospital_name"), df.orderBy(F.desc("address"))):
        got = PL.label_frame(order).collect()
        assert [(r.hospital_name, r.address) for r in got] == [("h1", "a")]


def test_one_hospital_of_2500_reviews_is_one_hospital(spark, tmp_path):
    flat = spark.range(2500).select(F.lit("p").alias("place_id"), F.lit("Pune").alias("city"), F.lit("H").alias("name"),
                                    F.col("id").cast("int").alias("pos"), F.col("id").cast("string").alias("text"))
    docs = PL.review_documents_frame(flat, spread=True)
    assert docs.count() == 3
    from reviewflow.sinks.envelope import write_envelope
    write_envelope(docs, str(tmp_path / "land"), keep=[FL.FIRST_CHILD])
    back = spark.read.schema(S.REVIEWS_DOCUMENT).option("recursiveFileLookup", "true").json(str(tmp_path / "land"))
    for d in (docs, back):
        assert [tuple(r) for r in AS.batch_totals(d).collect()] == [(1, 2500)]
    got = FL.flatten_reviews(back, with_position=True).select("review_pos", "review").collect()
    assert sorted(r.review_pos for r in got) == list(range(2500)) and all(str(r.review_pos) == r.review for r in got)
    assert [tuple(r) for r in AS.child_totals(flat, "place_id", ["city"]).collect()] == [("Pune", 1, 2500)]


def test_a_page_of_10002_results_keeps_its_order(spark):
    big = [f"r{i}" for i in range(10_002)]
    pages = spark.createDataFrame([("q", 1, "OK", "t", big, "Pune"), ("q", 2, "OK", None, ["last"], "Pune")],
                                  "request_id string, page_no int, status string, next_page_token string, results array<string>, city string")
    docs = PL.land_places_frame(pages).orderBy("page_no").collect()
    assert [d.results for d in docs] == [big, ["last"]] and {d.city_slug for d in docs} == {"pune"}


def test_counts_of_zero_make_no_rows(spark):
    cities = spark.createDataFrame([("Pune",)], "city string")
    assert AU.generate_hospitals(cities, per_city=0).count() == 0
    assert AU.generate_hospitals(cities, per_city=1, reviews_per_hospital=0).count() == 0
    empty = spark.createDataFrame([("p", [])], "place_id string, reviews array<struct<text:string>>")
    assert AU.pad_children(empty, "reviews", ["place_id"], min_count=0, gen=lambda k, p: F.struct(F.lit("x").alias("text"))).count() == 0


def test_conformance_flags_nan_and_long_text(spark):
    spec = S.TableSpec("t", (S.Column("f", "float"), S.Column("d", "double"), S.Column("x", "text"), S.Column("n", "int")))
    df = spark.createDataFrame([(float("nan"), 1.0, "a", 1), (1.0, float("nan"), "é" * 40_000, 1), (1.0, 1.0, "a", 3_000_000_000)],
                               "f double, d double, x string, n long")
    assert [r._errors for r in C.conform_to_schema(df, spec).collect()] == ["f", "d,x", "n"]


class CountedLoads(SE.LexiconScorer):
    def __init__(self, folder):
        super().__init__()
        self.folder = folder

    def load(self):
        super().load()
        with open(os.path.join(self.folder, f"{os.getpid()}"), "a") as f:
            f.write("x")


def test_a_model_loads_once_per_worker(spark, tmp_path):
    df = spark.range(200).select(F.col("id").cast("string").alias("t")).repartition(20)
    for _ in range(3):
        SE.score_text(df, "t", CountedLoads(str(tmp_path))).collect()
    loads = [os.path.getsize(tmp_path / p) for p in os.listdir(tmp_path)]
    assert loads and max(loads) == 1


def test_a_hot_request_is_joined_in_slices(spark):
    rows = [("hot", i + 1, "OK", "t", ["x"]) for i in range(64)] + [("bad", 1, "NO", None, ["x"]), ("none", 2, "OK", None, ["x"])]
    pages = spark.createDataFrame(rows, "request_id string, page_no int, status string, next_page_token string, results array<string>")
    got = {r.request_id: (r.outcome, r.n_pages, r.n_results) for r in AS.request_outcomes(pages).collect()}
    assert got == {"hot": ("ok", 64, 64), "bad": ("failed", 0, 0), "none": ("failed", 0, 0)}


def test_details_are_cut_before_the_shuffle_and_ties_are_settled(spark):
    details = spark.createDataFrame([("p", True, ["b"] * 9), ("p", True, ["a"] * 9), ("p", False, ["c"]), ("q", False, ["d"])],
                                    "place_id string, ok boolean, reviews array<string>")
    places = spark.createDataFrame([("p",), ("q",)], "place_id string")
    got = {tuple(r.reviews) for d in (details, details.orderBy("reviews"), details.orderBy(F.desc("reviews")))
           for r in AS.attach_details(places, d).collect()}
    assert len(got) == 1 and {len(x) for x in got} == {5}


def _plain_naive_bayes(rows):
    """Log odds per row from every token of the labelled rows, by loops."""
    import math
    import re
    words = [re.split("[^a-z-]+", (t or "").lower()) for _, t, _ in rows]
    count = {1: {}, 0: {}}
    for w, (_, _, y) in zip(words, rows):
        for x in w:
            if x and y is not None:
                count[y][x] = count[y].get(x, 0) + 1
    every = set(count[0]) | set(count[1])
    total = {y: sum(count[y].values()) + len(every) for y in (0, 1)}

    def share(x, y):
        return math.log((count[y].get(x, 0) + 1) / total[y])
    weight = {x: round((share(x, 1) - share(x, 0)) * 1e6) for x in every}
    sizes = {y: sum(1 for r in rows if r[2] == y) for y in (0, 1)}
    prior = round((math.log(sizes[1] + 1) - math.log(sizes[0] + 1)) * 1e6)
    return {r[0]: prior + sum(weight.get(x, 0) for x in w if x) for w, r in zip(words, rows)}


def test_counts_model_against_plain_python(spark):
    rows = [(1, "good good bad", 1), (2, "bad awful", 0), (3, "good", 1), (4, "", 0), (5, None, None), (6, "Unseen words, bad", None), (7, None, 1)]
    df = spark.createDataFrame(rows, "id long, text string, y int")
    got = {r.id: r.log_odds for r in SE.apply_counts(SE.train_counts(df, "text", "y"), df, "id", "text", {0: "N", 1: "P"}).collect()}
    assert got == _plain_naive_bayes(rows)
    none = df.where("false")
    assert SE.apply_counts(SE.train_counts(none, "text", "y"), none, "id", "text", {0: "N", 1: "P"}).collect() == []


def test_counts_model_weighs_every_token(spark):
    """A token that occurs once among tens of thousands of frequent ones decides, however large the vocabulary."""
    rows = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{'x' * (j // 26)}" for j in range(300)) + (" rare" if i == 7 else ""), i % 2) for i in range(200)]
    rows += [(900, "rare", None), (901, "neverseen", None)]
    df = spark.createDataFrame(rows, "id long, text string, y int")
    model = SE.train_counts(df, "text", "y")
    got = {r.id: r.log_odds for r in SE.apply_counts(model, df, "id", "text", {0: "N", 1: "P"}).collect()}
    assert got == _plain_naive_bayes(rows) and got[900] > got[901] == model.prior
    assert model.weights.count() > 7000


@pytest.mark.parametrize("most", [0, 40, 1 << 17])
def test_counts_model_weighs_frequent_tokens_where_texts_are_read(spark, monkeypatch, most):
    """Only tokens out of the head are shuffled with their texts, and the sums are those of the plain code for any size of head."""
    monkeypatch.setattr(SE, "HEAD_TOKENS", most)
    rows = [(i, " ".join(chr(97 + i % 3) + "x" * (j * j % 83) for j in range(60)) + f" {'r' * (i + 1)} the the The", i % 2 if i % 5 else None) for i in range(60)]
    rows += [(7, "the cxx repeated key", 1), (None, "the x", 1), (61, None, 0)]
    df = spark.createDataFrame(rows, "id long, text string, y int").repartition(3)
    model = SE.train_counts(df, "text", "y")
    scored = SE.apply_counts(model, df, "id", "text", {0: "N", 1: "P"})
    plain = _plain_naive_bayes([(i, *r[1:]) for i, r in enumerate(rows)])
    wanted = {}
    for i, r in enumerate(rows):
        wanted[r[0]] = wanted.get(r[0], 0) + plain[i]
    assert {r.id: r.log_odds for r in scored.collect()} == wanted
    if not most:
        assert model.head is None
        return
    head, tail = (sorted(r.token for r in x.collect()) for x in (model.head, model.tail))
    assert "the" in head and len(head) <= most and max(map(len, head)) <= SE.HEAD_LENGTH < max(map(len, tail))
    assert sorted(head + tail) == sorted(r.token for r in model.weights.collect())
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.count("BroadcastHashJoin") >= 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")      # less than the head: all tokens go to the join of two large sides
    try:
        again = SE.apply_counts(model, df, "id", "text", {0: "N", 1: "P"})
        assert "LeftAnti" not in again._jdf.queryExecution().executedPlan().toString()
        assert {r.id: r.log_odds for r in again.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_counts_model_does_not_depend_on_a_broadcast(spark):
    """Both sides of the join may be large: with broadcasts off it is a sort-merge join, and the plan has no limit."""
    df = spark.createDataFrame([(1, "a b", 1), (2, "b c", 0)], "id long, text string, y int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = SE.apply_counts(SE.train_counts(df, "text", "y"), df, "id", "text", {0: "N", 1: "P"})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Limit" not in plan and "Broadcast" not in plan


def test_streams_go_on_after_a_restart(spark, tmp_path):
    from reviewflow.streaming.landing_stream import stream_reviews
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    _land(spark, land, [_review(1)], name="h0")
    stream_reviews(spark, land, out).awaitTermination()
    _land(spark, land, [_review(2)], name="h1")
    # a new application would have another checkpoint root; the stream's own place is with its output
    stream_reviews(spark.newSession(), land, out).awaitTermination()
    names = sorted(r.hospital_name for r in spark.read.parquet(out).collect())
    assert names == ["h0", "h1"]


def test_cluster_without_shared_folder_is_refused():
    from reviewflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
