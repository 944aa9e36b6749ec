import math
from datetime import datetime

from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow.functions import exprs as X


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_author_id_murmur3_seed_42(spark):
    out = one(spark, X.author_id("n"), [("Ann",), (None,)], "n string")
    assert out == ["849699480", "42"]


def test_epoch_to_timestamp_reads_seconds_utc(spark):
    out = one(spark, X.epoch_to_timestamp("t"), [(1700000000,), (None,)], "t long")
    assert out[0] == datetime(2023, 11, 14, 22, 13, 20) and out[1] is None


def test_epoch_date_falsy_is_na(spark):
    out = one(spark, X.epoch_date("t"), [(None,), (0,), (1700000000,)], "t long")
    assert out == ["N/A", "N/A", "2023-11-14"]


def test_bool_to_int(spark):
    assert one(spark, X.bool_to_int("b"), [(True,), (False,), (None,)], "b boolean") == [1, 0, None]


def test_is_blank_matches_python_strip(spark):
    texts = [None, "", " \t\n", " ", "　 ", "\x1c\x1f", "x", " a ", "​"]
    out = one(spark, X.is_blank("t"), [(t,) for t in texts], "t string")
    expected = [t is None or not t.strip() for t in texts]
    assert out == expected


def test_score_label_strict_bounds_nan_null(spark):
    vals = [-0.26, -0.25, 0.0, 0.25, 0.26, float("nan"), None]
    out = one(spark, X.score_label("s"), [(v,) for v in vals], "s double")
    assert out == ["Negative", "Mixed", "Mixed", "Mixed", "Positive", "Mixed", None]


def test_rating_class(spark):
    vals = [1.0, 2.0, 3.0, 3.5, 4.0, 5.0, None]
    out = one(spark, X.rating_class("r"), [(v,) for v in vals], "r double")
    assert out == ["negative", "negative", "neutral", "negative", "positive", "positive", None]


def test_argmax_first_maximum(spark):
    rows = [([1.0, 3.0, 3.0],), ([5.0],), ([],), (None,)]
    assert one(spark, X.argmax("a"), rows, "a array<double>") == [1, 0, None, None]


def test_lookup(spark):
    assert one(spark, X.lookup({0: "neg", 1: "pos"}, F.col("i")), [(1,), (7,)], "i int") == ["pos", None]


def test_slug_and_newline(spark):
    df = spark.createDataFrame([("New York\nCity",)], "c string")
    r = df.select(X.slug("c"), X.slug("c", lower=False), X.newline_to_comma("c")).first()
    assert tuple(r) == ("new_york\ncity", "New_York\nCity", "New York, City")


def test_hash_pick_repeatable_and_in_range(spark):
    df = spark.range(2000).select(X.hash_pick("s", "id", 7).alias("p"), X.hash_int("s", "id", 50, 5000).alias("i"),
                                  X.hash_tenths("s", "id", 1.0, 5.0).alias("t"), X.hash_date("s", "id").alias("d"))
    a = df.collect()
    b = df.repartition(7).orderBy("p", "i", "t", "d").collect()
    assert sorted(a) == sorted(b)
    assert {r.p for r in a} == set(range(7))
    assert all(50 <= r.i <= 5000 for r in a)
    assert all(1.0 <= r.t <= 5.0 and round(r.t, 1) == r.t for r in a)
    assert min(r.d for r in a).isoformat() >= "2020-01-01" and max(r.d for r in a).isoformat() <= "2024-12-31"


def test_fill_template_leaves_no_placeholder(spark):
    rows = [(t,) for t in K.POSITIVE_TEMPLATES + K.NEUTRAL_TEMPLATES + K.NEGATIVE_TEMPLATES]
    out = one(spark, X.fill_template("t", [F.lit("a"), F.lit("b"), F.lit("c"), F.lit("d")]), rows, "t string")
    assert all("{adjective" not in s for s in out)


def test_months_and_time_text(spark):
    df = spark.createDataFrame([(3, datetime(2025, 1, 2, 3, 4, 5))], "n int, ts timestamp")
    r = df.select(X.months_ago_text("n"), X.load_time_text("ts"), X.compact_time_text("ts")).first()
    assert tuple(r) == ("3 months ago", "2025-01-02 03:04:05", "20250102_030405")
    assert not math.isnan(1.0)
