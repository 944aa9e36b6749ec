"""Subword pieces and the classifier trained on them, against plain code."""

import math

import numpy as np
import pandas as pd
import pytest
import regex
from hypothesis import given
from hypothesis import strategies as st

from reviewflow.operators import sentiment as SE
from reviewflow.operators import subwords as SW
from reviewflow.plans.subword_queries import VOCABULARY

SMALL = SW.Vocabulary({b" ": 0, b" go": 1, b" good": 2, b"o": 3, b"d": 4, b"ness": 5, b"n": 6, b" !": 7, b"e": 8, b"s": 9, b"oodn": 10, "é".encode(): 11})
TEXTS = ["Goodness GOOD!", None, "", " \t\n", "goodn", "été good", "x", "good " * 50, "日本 good", "go\x00od"]


def plain(vocabulary, word):
    """The longest entry at every place, tried from the longest down."""
    data, out, at = (" " + word).encode(), [], 0
    while at < len(data):
        fits = [n for n in range(1, len(data) - at + 1) if data[at:at + n] in vocabulary.entries]
        out.append(vocabulary.entries[data[at:at + max(fits)]] if fits else SW.UNKNOWN)
        at += max(fits, default=1)
    return out


def plain_text(vocabulary, text, lower=True):
    lowered = "".join(c.lower() if lower and "A" <= c <= "Z" else c for c in text or "")
    return [p for w in regex.findall(SW.WORD, lowered) for p in plain(vocabulary, w)]


@given(st.text(alphabet="goodnes!é日", max_size=30))
def test_cut_is_the_longest_match(word):
    if not SMALL.prefixes:
        SMALL.load()
    assert SMALL.cut(word) == plain(SMALL, word)


def test_an_entry_that_only_begins_another_is_not_lost():
    v = SW.Vocabulary({b" a": 1, b" abcd": 2, b"b": 3, b"c": 4})
    v.load()
    assert v.cut("abce") == [1, 3, 4, SW.UNKNOWN] and v.cut("abcd") == [2]


def test_vocabulary_is_bounded(monkeypatch):
    monkeypatch.setattr(SW, "MAX_ENTRIES", 3)
    with pytest.raises(ValueError):
        SW.Vocabulary({bytes([i]): i for i in range(4)})


def cutter(**options):
    c = SW.Cutter(SMALL, **options)
    c.load()
    return c


CUTTER = cutter()


@pytest.mark.parametrize("limit", [None, 1, 3, 40])
@pytest.mark.parametrize("lower", [True, False])
def test_pieces_of_whole_texts(spark, limit, lower):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {r.id: r.ids for r in df.select("id", SW.encode("text", SMALL, limit, lower).alias("ids")).collect()}
    assert got == {i: plain_text(SMALL, t, lower)[:limit] for i, t in enumerate(TEXTS)}


def test_a_full_memo_changes_nothing(monkeypatch):
    text = "good go o d good goodness ! good"
    whole = cutter().pieces(text)
    monkeypatch.setattr(SW, "MEMO", 2)
    c = cutter()
    assert c.pieces(text) == whole == plain_text(SMALL, text) and len(c._memo) <= 2


def test_a_very_long_word_takes_linear_time():
    ids = cutter().pieces("good" * 250_000)
    assert len(ids) > 500_000 and ids[:2] == [2, SW.UNKNOWN]


def test_encode_adds_no_shuffle(spark):
    plan = spark.range(3).selectExpr("string(id) AS text").select(SW.encode("text", SMALL))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") >= 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "y int, text string")
    assert df.select(SW.encode("text", SMALL)).count() == 0
    model = SW.train_subwords(df, "text", "y", {0: "a", 1: "b"}, SMALL)
    model.load()
    assert model.logits(pd.Series(["good", " "])).tolist() == [[0.0, 0.0], None]


@given(st.text(alphabet="goOdnes!é日İ_\x7f\x00 -1²", max_size=40))
def test_words_of_ascii_and_other_texts(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    assert CUTTER.words(text) == regex.findall(SW.WORD, lowered)


@pytest.mark.parametrize("limit", [None, 1, 2, 5])
def test_logits_sum_the_weights_of_the_pieces(limit):
    weights = np.arange(24, dtype=np.int64).reshape(12, 2) ** 2
    model = SW.SubwordClassifier(SW.Cutter(SMALL, limit), weights, np.array([3, 4]), {0: "a", 1: "b"})
    model.load()
    for text in filter(None, TEXTS):
        ids = [p for p in plain_text(SMALL, text)[:limit] if p != SW.UNKNOWN]
        want = [float(3 + sum(weights[p, 0] for p in ids)), float(4 + sum(weights[p, 1] for p in ids))]
        assert model.logits(pd.Series([text]))[0] == (want if text.strip() else None)


def test_training_against_plain_counts(spark):
    rows = [(0, "good good"), (1, "bad !"), (1, "goodness"), (None, "x"), (7, "go"), (0, ""), (2, None)]
    names = {0: "negative", 1: "neutral", 2: "positive"}
    model = SW.train_subwords(spark.createDataFrame(rows, "y int, text string"), "text", "y", names, SMALL)
    model.load()
    hits = [(y, p) for y, t in rows if y in names for p in plain_text(SMALL, t) if p != SW.UNKNOWN]
    size, text = len({p for _, p in hits}), "good go !"

    def logit(c):
        n = sum(y == c for y, _ in hits)
        out = round(math.log(sum(y == c for y, _ in rows) + 1) * SE.MICRO)
        for p in plain_text(SMALL, text):
            if p in {q for _, q in hits}:
                out += round(math.log((hits.count((c, p)) + 1) / (n + size)) * SE.MICRO)
        return out
    assert model.logits(pd.Series([text]))[0] == [logit(c) for c in range(3)]
    df = spark.createDataFrame([(text,), (" ",), (None,)], "text string")
    best = max(range(3), key=lambda c: (logit(c), -c))
    assert [r.sentiment for r in SE.label_text(df, "text", model).collect()] == [names[best], "", ""]


def test_held_out_agreement(spark):
    """Learned on two thirds of the labelled documents, asked for the others: better than the most frequent label."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality IS NOT NULL").select("doc_id", "quality")
    known, v = docs.join(labels, "doc_id"), SW.read_vocabulary(VOCABULARY)
    fitted = known.where("doc_id % 3 <> 0")
    model = SW.train_subwords(fitted, "text", "quality", {0: "0", 1: "1"}, v)
    asked = SE.label_text(known.where("doc_id % 3 = 0"), "text", model).where("sentiment <> ''").toPandas()
    share = (asked.sentiment == asked.quality.astype(str)).mean()
    usual = max(asked.quality.mean(), 1 - asked.quality.mean())
    print("agreement", share, "most frequent", usual)
    assert share > usual + 0.05
