from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow.operators import augment as AU


def _children(spark):
    rows = [(k, p, f"real-{k}-{p}") for k, n in (("a", 0), ("b", 1), ("c", 5), ("d", 99), ("e", 100), ("f", 101))
            for p in range(n)]
    return spark.createDataFrame(rows, "k string, pos long, text string")


def test_top_up_pads_to_minimum_and_is_idempotent(spark):
    children = _children(spark)
    parents = spark.createDataFrame([(k,) for k in "abcdefg"], "k string")
    once = AU.top_up_groups(children, parents, "k", min_count=100)
    counts = {r.k: r.n for r in once.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 100, "b": 100, "c": 100, "d": 100, "e": 100, "f": 101, "g": 100}
    # originals untouched
    orig = once.filter(F.col("review_type").isNull()).select("k", "pos", "text")
    assert orig.exceptAll(children).count() == 0 and children.exceptAll(orig).count() == 0
    # positions dense 0..n-1 per parent
    bad = once.groupBy("k").agg(F.max("pos").alias("m"), F.count("*").alias("n")).filter("m <> n - 1")
    assert bad.count() == 0
    twice = AU.top_up_groups(once.select("k", "pos", "text"), parents, "k", min_count=100)
    assert twice.count() == once.count()
    gen = once.filter(F.col("review_type") == K.FAKE_REVIEW_TYPE)
    assert gen.filter(F.col("text").contains("{adjective")).count() == 0
    assert gen.count() == sum(max(100 - n, 0) for n in (0, 1, 5, 99, 100, 101, 0))


def test_generated_rows_are_repeatable(spark):
    parents = spark.createDataFrame([(k,) for k in "xyz"], "k string")
    empty = spark.createDataFrame([], "k string, pos long, text string")
    a = AU.top_up_groups(empty, parents, "k", min_count=10).collect()
    b = AU.top_up_groups(empty, parents.repartition(3), "k", min_count=10).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_synthetic_review_fields(spark):
    df = spark.range(500).select(AU.synthetic_review([F.col("id")], "t").alias("r")).select("r.*")
    rows = df.collect()
    assert all(1 <= r.rating <= 5 for r in rows)
    assert all(r.relative_time_description.endswith("months ago") for r in rows)
    assert all("2020-01-01" <= r.date <= "2024-12-31" for r in rows)
    assert all(r.review_type == "fake" and r.translated is False for r in rows)
    # text class follows the rating
    for r in rows[:100]:
        words = set(r.text.replace(".", " ").replace(",", " ").split())
        lex = K.ADJECTIVES_POSITIVE if r.rating >= 4 else K.ADJECTIVES_NEUTRAL if r.rating == 3 else K.ADJECTIVES_NEGATIVE
        assert words & set(lex)


def test_generate_hospitals_counts(spark):
    cities = spark.createDataFrame([("Pune",), ("New Delhi",)], "city string")
    df = AU.generate_hospitals(cities, "city", per_city=5, reviews_per_hospital=100)
    assert df.count() == 1000
    h = df.select("city", "hospital_no", "name", "formatted_address", "hospital_rating", "user_ratings_total").distinct()
    assert h.count() == 10
    for r in h.collect():
        assert r.name.startswith(r.city + " ") and r.name[len(r.city) + 1:] in K.HOSPITAL_TYPES
        assert "\n" not in r.formatted_address and 1.0 <= r.hospital_rating <= 5.0
        assert 50 <= r.user_ratings_total <= 5000
    assert df.filter(F.col("place_id").isNotNull()).count() == 0


def test_pad_children_flat_and_idempotent(spark):
    from reviewflow import schemas as S
    rev = {"author_name": "Ann", "rating": 5, "text": "great", "time": 1}
    df = spark.createDataFrame([("a", [rev] * 3), ("b", None), ("c", [rev] * 12)],
                               S.T.StructType([S.T.StructField("k", S.T.StringType()),
                                               S.T.StructField("reviews", S.T.ArrayType(S.REVIEW))]))
    flat = AU.pad_children(df, "reviews", ["k"], min_count=10)
    sizes = {r.k: r.n for r in flat.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert sizes == {"a": 10, "b": 10, "c": 12}
    a = flat.filter("k = 'a'").orderBy("pos").collect()
    assert [x.author_name for x in a[:3]] == ["Ann"] * 3 and all(x.review_type == "fake" for x in a[3:])
    assert [x.pos for x in a] == list(range(10))
    assert "Exchange" not in flat._jdf.queryExecution().executedPlan().toString()
    # padding the re-nested rows again adds nothing
    from reviewflow.operators.flatten import nest_children
    again = nest_children(flat, ["k"], "pos", list(S.REVIEW.fieldNames()), array_name="reviews", chunk_size=100)
    flat2 = AU.pad_children(again.drop("chunk"), "reviews", ["k"], min_count=10)
    assert flat2.count() == flat.count() and flat2.exceptAll(flat.select(flat2.columns)).count() == 0


def test_with_element_defaults(spark):
    from reviewflow import schemas as S
    from reviewflow.operators.clean import with_element_defaults
    df = spark.createDataFrame([([{"author_name": "x", "translated": None, "original_language": None}],)],
                               S.T.StructType([S.T.StructField("reviews", S.T.ArrayType(S.REVIEW))]))
    r = with_element_defaults(df, "reviews", {"translated": False, "original_language": "en", "nope": 1}).first()
    assert r.reviews[0].translated is False and r.reviews[0].original_language == "en"
