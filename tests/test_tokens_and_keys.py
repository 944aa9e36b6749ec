"""Pages by following tokens against a plain walk; ids that unlike authors share."""

import random

from pyspark.sql import functions as F

from reviewflow.operators import assemble as AS
from reviewflow.operators import clean as C
from reviewflow.plans.queries import COLLIDING_NAMES

SCHEMA = "request_id string, page_token string, status string, next_page_token string, results array<string>"


def walked(rows):
    """The source's loop: ask for the first page, then for the token it gives, until a page is bad, missing or known."""
    out = []
    for req in {r[0] for r in rows if r[0] is not None}:
        pages = {}
        for r in rows:
            if r[0] == req:
                pages.setdefault(r[1], r)
        token, n, seen = None, 1, set()
        while token in pages and token not in seen:
            _, _, status, following, results = pages[token]
            if n == 1 and (status not in ("OK", "ZERO_RESULTS") or not results) or n > 1 and status != "OK":
                break
            out += [(req, n, i, x) for i, x in enumerate(results or [])]
            seen.add(token)
            if following is None:
                break
            token, n = following, n + 1
    return sorted(out)


def followed(spark, rows):
    return sorted(tuple(r) for r in AS.follow_tokens(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect())


def test_random_chains_loops_and_gaps(spark):
    r = random.Random(1)
    rows = []
    for k in range(60):
        tokens = [None, *[f"t{i}" for i in range(r.randint(0, 12))]]
        r.shuffle(tokens)
        for t in tokens:
            if r.random() < .95:
                follow = r.choice([None, "t0", "nowhere", *[x for x in tokens if x]]) if r.random() < .9 else "t1"
                rows.append((f"r{k}", t, r.choice(["OK"] * 8 + ["ZERO_RESULTS", "DENIED", None]), follow,
                             r.choice([None, [], ["a"], ["b", "c"]]) if r.random() < .4 else ["x", f"{k}-{t}"]))
    assert followed(spark, rows) == walked(rows)


def test_long_walks_and_loops_into_the_middle(spark):
    rows = [("long", f"p{i}" if i else None, "OK", f"p{i + 1}", [f"{i}"]) for i in range(700)]
    rows += [("rho", f"q{i}" if i else None, "OK", f"q{i + 1}" if i < 49 else "q20", [f"{i}"]) for i in range(50)]
    rows += [("self", None, "OK", "s", ["a"]), ("self", "s", "OK", "s", ["b"])]
    # a loop that no walk reaches, and a chain behind a gap
    rows += [("far", None, "OK", "gone", ["only"]), ("far", "l1", "OK", "l2", ["x"]), ("far", "l2", "OK", "l1", ["y"])]
    got = followed(spark, rows)
    assert got == walked(rows) and len(got) == 700 + 50 + 2 + 1


def test_cases(spark):
    assert followed(spark, []) == []
    assert followed(spark, [(None, None, "OK", None, ["a"])]) == [(None, 1, 0, "a")]
    same = [("r", None, "OK", None, ["b", None])] * 3                      # repeated rows are one page
    assert [x[:3] for x in followed(spark, same)] == [("r", 1, 0), ("r", 1, 1)]


def test_authors_of_one_id_are_told(spark):
    a, b = COLLIDING_NAMES
    names = [a, a, b, "alone", "alone", None, None, ""]
    got = C.author_collisions(spark.createDataFrame([(x,) for x in names], "author_name string")).collect()
    assert [tuple(r)[1:] for r in got] == [(3, 2, a, b)]
    none = spark.createDataFrame([], "author_name string")
    assert C.author_collisions(none).collect() == []
    # the audit combines before it shuffles
    plan = C.author_collisions(spark.range(10).select(F.col("id").cast("string").alias("author_name")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") + plan.count("SortAggregate") >= 4
