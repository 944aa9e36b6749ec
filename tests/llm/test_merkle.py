import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from reviewflow.llm import merkle as op
from reviewflow.llm.queries import QUERIES

from .conftest import DOCS, rows_of


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, n_chars):
    doc_id, text, lang, source, _ = row
    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def beside(tree, i):
    out = []
    for level in tree[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else "", i & 1))
        i >>= 1
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) by whole trees in memory."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4]))) for x in langs}
    trees = {x: levels([leaf(r, r[4]) for r in own[x]]) for x in langs}
    top, out = levels([trees[x][-1][0] for x in langs]), []
    for k, x in enumerate(langs):
        for i, r in enumerate(own[x]):
            path, n = beside(trees[x], i) + beside(top, k), r[4]
            if n is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                n += 1
            node = leaf(r, n)
            for h, left in path:
                node = digest(h, node) if left else digest(node, h)
            out.append((r[0], trees[x][0][i], trees[x][-1][0], top[-1][0], digest(*[h for h, _ in path]), node, node == top[-1][0]))
    return sorted(out, key=repr)


def made(spark, docs, rows, every, extra=()):
    docs(())                                   # the session is prepared
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for c in extra:
        df = df.withColumn(c, F.lit(1))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, op.leaf_digest(n_chars=F.col("n_chars") + 1))
    found = op.verify(op.proofs(op.manifest(df, every, tampered=tampered)), "coalesce(tampered, leaf)")
    return rows_of(found.selectExpr("doc_id", "leaf", "subroot", "root", "sha2(array_join(path.digest, ''), 256)", "folded_root", "verified"))


@pytest.mark.parametrize("n,every", [(1, 2), (2, 2), (3, 1), (33, 2), (64, 3), (65, 3), (200, 2), (200, 8)])
def test_trees_of_every_shape(spark, docs, n, every):
    """One language with most documents, one with few, some with one: full, broken and single subtrees at every kept level."""
    rows = [(i, f"text {i}", "en" if i % 5 else ("fr" if i % 10 else f"l{i}"), "s", i) for i in range(n)]
    assert made(spark, docs, rows, every) == brute(rows)


def test_cases(spark, docs):
    rows = [(7, None, None, None, None), (8, "", "", "", 0), (None, "x", "en", "s", 1), (5, "same", "en", "s", 4), (5, "same", "en", "s", 4),
            (5, "other", "en", "s", 5), (-3, "é𝄞\n", "é", "ü", 3), (9, "long " * 200_000, "z", "s", None), (10, "-", "-", "-", 1), (11, "1:-", None, "s", 3)]
    assert made(spark, docs, rows, 2, extra=("tree", "idx", "digest", "size", "path", "kept")) == brute(rows)
    assert made(spark, docs, [], 2) == []


def test_only_every_few_levels_are_kept(spark, docs):
    docs(())
    kept = op.manifest(spark.createDataFrame([(i, "t", "en", "s", 1) for i in range(1000)], DOCS), every=3).languages.levels
    assert [x.count() for x in kept] == [1000, 125, 16, 2, 1]


def test_a_proof_fails_for_any_other_leaf(spark, docs):
    docs(())
    df = spark.createDataFrame([(i, f"t{i}", "en" if i % 3 else "de", "s", 1) for i in range(40)], DOCS)
    proved = op.proofs(op.manifest(df, 2))
    assert op.verify(proved).where("verified").count() == 40
    assert op.verify(proved, "sha2(leaf, 256)").where("verified").count() == 0


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert rows_of(QUERIES["op13_merkle_manifest"](spark, d)) == brute(rows)
