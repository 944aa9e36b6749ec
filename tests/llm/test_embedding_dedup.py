import numpy as np
import pytest

from reviewflow.llm import embedding_dedup as op
from reviewflow.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine=op.COSINE):
    """n_links and component of each row."""
    def sound(r):
        v = r[1]
        return v is not None and r[2] is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    n = len(rows)
    links, root = [set() for _ in rows], list(range(n))
    good = [i for i in range(n) if sound(rows[i])]
    scaled = {i: np.array(rows[i][1], float) / max(map(abs, rows[i][1])) for i in good}
    unit = {i: v / np.linalg.norm(v) for i, v in scaled.items()}
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and unit[i] @ unit[j] >= cosine:
                links[i].add(j)
                links[j].add(i)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in links[i]:
            root[top(i)] = top(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[top(i)] = min(low.get(top(i), r[0]), r[0])
    return [(r[0], len(links[i]), low.get(top(i)), r[0] is not None and low.get(top(i)) == r[0]) for i, r in enumerate(rows)]


def test_traversal_visits_cells_by_rising_distance():
    rng = np.random.default_rng(0)
    a, b = rng.random(5), rng.random(7)
    way = list(op.multi_sequence(a, b))
    sums = [a[i] + b[j] for i, j in way]
    assert len(set(way)) == 35 and sums == sorted(sums)


def groups(rng, n, size, noise, dim=16):
    centre = rng.normal(size=(n, dim))
    return np.concatenate([c + noise * rng.normal(size=(size, dim)) for c in centre])


def test_against_brute_force(spark):
    prepare(spark)
    rng = np.random.default_rng(1)
    x = np.concatenate([groups(rng, 30, 4, 0.05), rng.normal(size=(80, 16)), groups(rng, 1, 60, 0.1)])
    rows = [(i, v.tolist(), int(i % 3 == 0)) for i, v in enumerate(x)]
    same = x[0].tolist()
    rows += [(1000 + i, same, 0) for i in range(30)] + [(2000, [2 * v for v in same], 0), (2001, [v * 1e200 for v in same], 0)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 16, 0), (3003, [float("nan")] + same[1:], 0), (3004, [None, *same[1:]], 0),
             (3005, same, None), (3006, [float("inf")] + same[1:], 0), (None, same, 0), (1000, same, 0), (3007, same[:8], 0), (3008, same[:8], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS class_id", "3 AS digest").repartition(3)
    got = sorted((tuple(r) for r in op.near_duplicates(df).collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    assert len(got) == len(want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.97 * len(want)
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want) and not sum(g[1] for g in got) > sum(w[1] for w in want)


def test_small_blocks_count_every_pair_once(spark, monkeypatch):
    prepare(spark)
    rng = np.random.default_rng(2)
    x = groups(rng, 3, 40, 0.08)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id AS class_id", "struct(label, 16 AS dim) AS label", "1L AS n", "embedding AS vector")
    index = op.fit(x, np.ones(len(x)), words=4)
    index.visits = 16       # all cells: then nothing may be missed or counted twice
    got = {r.a: r.n for r in op.link(df, index, block=7).where("b < 0").groupBy("a").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    assert got == {i: n for i, n, _, _ in brute(rows) if n}


def test_recall_with_a_sample_well_below_the_table(spark):
    prepare(spark)
    rng = np.random.default_rng(3)
    x = np.concatenate([groups(rng, 150, 8, 0.08), rng.normal(size=(300, 16))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("vec_id AS class_id", "struct(label, 16 AS dim) AS label", "1L AS n", "embedding AS vector")
    sample = op.sample_of(df, rows=150)
    assert len(sample[0]) == 150
    got = sum(r.n for r in op.link(df, op.fit(*sample)).where("b < 0").collect())
    want = sum(n for _, n, _, _ in brute(rows))
    assert 0.95 * want <= got <= want


@pytest.mark.parametrize("table", ["sf0.01"])
def test_recall_on_the_given_table(spark, table):
    prepare(spark)
    df = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want = {w[0]: w for w in brute(rows)}
    got = {r.vec_id: tuple(r) for r in op.near_duplicates(df).collect()}
    assert len(got) == len(rows) and sum(g[1] for g in got.values()) >= 0.9 * sum(w[1] for w in want.values())
    assert all(g[1] <= want[i][1] for i, g in got.items())


def test_nothing_to_index(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, None, 1), (None, [1.0, 2.0], None)], SCHEMA)
    assert sorted((tuple(r) for r in op.near_duplicates(df).collect()), key=repr) == [(1, 0, 1, True), (None, 0, None, False)]
    assert op.near_duplicates(df.where("false")).collect() == []


def test_vectors_of_one_component_link_by_their_sign(spark):
    prepare(spark)
    rows = [(i, [float(v)], i % 2) for i, v in enumerate([2, 3, 5, -1, -4, 0, 1e-300, 7])] + [(50, [1.0, 0.0], 0), (51, [], 0)]
    got = op.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))
