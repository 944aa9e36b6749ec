"""Operators against brute-force Python models of the source's loops, on random inputs.

Each Hypothesis example packs many independent cases (requests / places /
groups) into one frame, so one Spark job checks them all.
"""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.operators import assemble as AS
from reviewflow.operators import augment as AU

STATUSES = ["OK", "OK", "OK", "ZERO_RESULTS", "INVALID_REQUEST", "OVER_QUERY_LIMIT"]
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow,
                                                                         HealthCheck.function_scoped_fixture])

page = st.tuples(st.sampled_from(STATUSES), st.booleans(),
                 st.lists(st.text(alphabet="abc", min_size=1, max_size=3), max_size=3))
request = st.dictionaries(st.integers(min_value=1, max_value=6), page, max_size=6)


def fetch_model(pages: dict):
    """The source's follow-the-token loop over landed pages: None (failed), [] or results."""
    if 1 not in pages:
        return None
    status, has_token, results = pages[1]
    if status not in ("OK", "ZERO_RESULTS"):
        return None
    if not results:
        return []
    out = [(1, i, r) for i, r in enumerate(results)]
    k = 1
    while pages[k][1]:                       # next_page_token present
        k += 1
        if k not in pages:
            break                            # the fetch of page k fails
        status, _, results = pages[k]
        if status != "OK":
            break
        out += [(k, i, r) for i, r in enumerate(results)]
    return out


@SETTINGS
@given(st.lists(request, min_size=1, max_size=25))
def test_assemble_pages_matches_token_loop(spark, requests):
    rows = [(f"r{i}", k, st_, "tok" if tok else None, res)
            for i, req in enumerate(requests) for k, (st_, tok, res) in req.items()]
    if not rows:
        return
    df = spark.createDataFrame(rows, "request_id string, page_no int, status string, next_page_token string, "
                                     "results array<string>")
    got = {}
    for r in AS.assemble_pages(df).collect():
        got.setdefault(r.request_id, []).append((r.page_no, r.pos, r.result))
    outcomes = {r.request_id: (r.outcome, r.n_results) for r in AS.request_outcomes(df).collect()}
    for i, req in enumerate(requests):
        if not req:
            continue
        want = fetch_model(req)
        assert sorted(got.get(f"r{i}", [])) == sorted(want or []), (req, got.get(f"r{i}"))
        expect_outcome = "failed" if want is None else "empty" if (not req[1][2] if 1 in req else True) else "ok"
        assert outcomes[f"r{i}"][0] == expect_outcome
        assert outcomes[f"r{i}"][1] == len(want or [])


detail = st.one_of(st.none(), st.tuples(st.booleans(), st.one_of(st.none(), st.integers(min_value=0, max_value=8))))


@SETTINGS
@given(st.lists(detail, min_size=1, max_size=30))
def test_attach_details_matches_lookup_loop(spark, details):
    places = spark.createDataFrame([(f"p{i}", f"H{i}") for i in range(len(details))] + [(None, "HN")],
                                   "place_id string, name string")
    t0 = datetime(2024, 1, 1)
    rows = []
    for i, d in enumerate(details):
        if d is None:
            continue                                   # detail never fetched
        ok, n = d
        revs = None if n is None else [{"author_name": f"a{j}", "text": f"t{j}"} for j in range(n)]
        rows.append({"place_id": f"p{i}", "ok": ok, "fetched_at": t0, "reviews": revs})
        # an older, failed duplicate never wins over the row above
        rows.append({"place_id": f"p{i}", "ok": False, "fetched_at": t0 - timedelta(days=1), "reviews": None})
    det = spark.createDataFrame(rows, S.DETAIL) if rows else spark.createDataFrame([], S.DETAIL)
    got = {r.place_id: [x.author_name for x in r.reviews] for r in AS.attach_details(places, det).collect()}
    want = {}
    for i, d in enumerate(details):                   # the source's per-place loop
        if d is None or not d[0]:
            continue                                   # failed lookup: `continue` before append
        want[f"p{i}"] = [f"a{j}" for j in range(d[1] or 0)][:5]
    assert got == want


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=12), min_size=1, max_size=20), st.integers(1, 10))
def test_top_up_matches_while_loop(spark, sizes, minimum):
    children = spark.createDataFrame([(f"g{i}", p, f"real{p}") for i, n in enumerate(sizes) for p in range(n)],
                                     "k string, pos long, text string")
    parents = spark.createDataFrame([(f"g{i}",) for i in range(len(sizes))], "k string")
    flat = AU.top_up_groups(children, parents, "k", min_count=minimum)
    got = {}
    for r in flat.collect():
        got.setdefault(r.k, []).append((r.pos, r.text.startswith("real") and r.review_type is None))
    for i, n in enumerate(sizes):                      # while len(reviews) < min: append
        want = [(p, True) for p in range(n)] + [(p, False) for p in range(n, max(n, minimum))]
        assert sorted(got[f"g{i}"]) == want
    # the array form agrees with the flat form
    nested = spark.createDataFrame(
        [(f"g{i}", [{"author_name": "x", "text": f"real{p}"} for p in range(n)]) for i, n in enumerate(sizes)],
        S.T.StructType([S.T.StructField("k", S.T.StringType()), S.T.StructField("reviews", S.T.ArrayType(S.REVIEW))]))
    padded = AU.pad_children(nested, "reviews", ["k"], min_count=minimum)
    counts = {r.k: r.n for r in padded.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert counts == {f"g{i}": max(n, minimum) for i, n in enumerate(sizes)}


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=40), min_size=1, max_size=15), st.integers(1, 9))
def test_nest_then_unnest_is_identity(spark, sizes, chunk):
    from reviewflow.operators import flatten as FL
    rows = [(k, p, f"{k}:{p}") for k, n in enumerate(sizes) for p in range(n)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "k int, pos long, v string")
    nested = FL.nest_children(df, ["k"], "pos", ["v"], array_name="c", chunk_size=chunk)
    assert all(len(r.c) <= chunk for r in nested.collect())
    back = FL.unnest_children(nested, ["k"], "c", chunk_size=chunk).select("k", "pos", "v")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(alphabet="xyz", max_size=6)),
                          st.one_of(st.none(), st.integers(min_value=-300, max_value=300))), min_size=1, max_size=40))
def test_conform_flags_exactly_what_does_not_fit(spark, rows):
    from reviewflow import schemas as SC
    from reviewflow.operators import clean as C
    spec = SC.TableSpec("t", (SC.Column("name", "varchar(3)"), SC.Column("small", "tinyint")))
    df = spark.createDataFrame(rows, "name string, small int")
    out = C.conform_to_schema(df, spec)
    got = [(r.name, r.small, r._errors) for r in out.collect()]
    want = []
    for name, small in rows:
        errs = [c for c, bad in (("name", name is not None and len(name) > 3),
                                 ("small", small is not None and not -128 <= small <= 127)) if bad]
        want.append((name, small if small is None or -128 <= small <= 127 else None, ",".join(errs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    good, bad = C.split_conformed(out)
    assert good.count() + bad.count() == len(rows)


WORDS = ["superb", "top-notch", "bad", "mediocre", "fine", "Awful", "ÉTÉ", "run-of-the-mill", "great", "x"]
text = st.lists(st.one_of(st.sampled_from(WORDS), st.text(alphabet="ab -,.!éÜ\n\t", max_size=5)), max_size=12) \
    .map(" ".join)


@SETTINGS
@given(st.lists(st.one_of(st.none(), text), min_size=1, max_size=30))
def test_native_and_pandas_scorers_agree(spark, texts):
    from reviewflow.operators import sentiment as SE
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    native = {r.id: (r.label, r.score) for r in SE.lexicon_score(df, "t").collect()}
    pandas = {r.id: (r.sentiment, r.sentiment_score) for r in SE.score_text(df, "t").collect()}
    for i in native:
        (la, sa), (lb, sb) = native[i], pandas[i]
        assert la == lb, (texts[i], native[i], pandas[i])
        assert (sa is None and sb is None) or abs(sa - sb) < 1e-6
    a = {r.id: r.sentiment for r in SE.label_text(df, "t").collect()}
    b = {r.id: r.sentiment for r in SE.lexicon_classify(df, "t").collect()}
    assert a == b
