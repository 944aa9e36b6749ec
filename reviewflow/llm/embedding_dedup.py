"""Embedding near-dedup by an inverted multi-index (operator 10).

Vectors are scaled to length one and cut in halves; each half has a codebook
of its own (k-means), and the pairs of codewords form the cells of a product
grid, kept per label.  Every vector is filed in its cell.  For a query the
multi-sequence traversal visits cells by rising sum of both halves'
distances; how many it visits is measured on a sample, so that the wanted
recall is met both for the sample's own linked pairs and for pairs made at
exactly the threshold.  What lies in a visited cell is verified by the
cosine in double precision, block against block; a block gives, per vector,
the number of its links and a spanning tree, never all pairs.

Only the codebooks and the number of visits come from the sample (the
``sample_rows`` vectors with the smallest seeded hash); all vectors are
indexed and all are queries.

Cases: vectors that are null, empty, zero, or hold null or non-finite
components, and those without a label, link with nothing; vectors of
different length never link; equal vectors of one label are joined as one and
counted each; null ids are kept and never name a component unless all its ids
are null; rows that repeat an id stay rows of their own; other columns are
never read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import stage
from reviewflow.llm.graph import components

COSINE = 0.93
WORDS = 16              # codewords of a half: WORDS ** 2 cells per label
SAMPLE_ROWS = 4000
RECALL = 0.995
SEED = 7
BLOCK = 512             # vectors of a cell, and queries to it, that one group verifies


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; by the largest component first, so nothing overflows."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1)).clip(0)


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Codewords of one half; started at seeded rows, a word that loses all rows stays where it is."""
    words = x[np.sort(np.random.default_rng(seed).permutation(len(x))[:k])].copy()
    for _ in range(rounds):
        at = distances(x, words).argmin(1)
        for j in range(len(words)):
            if (at == j).any():
                words[j] = x[at == j].mean(0)
    return words


def multi_sequence(first: np.ndarray, second: np.ndarray):
    """Cells (i, j) by rising first[i] + second[j]: a heap of the cells whose left and upper neighbours were visited."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for u, v in ((i + 1, j), (i, j + 1)):
            if u < len(a) and v < len(b) and (u, v) not in seen:
                seen.add((u, v))
                heapq.heappush(heap, (first[a[u]] + second[b[v]], u, v))


class MultiIndex:
    """Codebooks of both halves, and how many cells a query visits."""

    def __init__(self, words: tuple[np.ndarray, np.ndarray], visits: int):
        self.words, self.visits = words, visits

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = x.shape[1] // 2
        return distances(x[:, :cut], self.words[0]), distances(x[:, cut:], self.words[1])

    def order(self, x: np.ndarray, visits: int | None = None) -> list[list[int]]:
        """Cell numbers in the order of the traversal, for each row."""
        n = len(self.words[1])
        out = []
        for first, second in zip(*self.halves(x)):
            way = multi_sequence(first, second)
            out.append([i * n + j for _, (i, j) in zip(range(visits or self.visits), way)])
        return out


def fit(sample: np.ndarray, labels: np.ndarray, cosine: float = COSINE, words: int = WORDS, recall: float = RECALL,
        seed: int = SEED) -> MultiIndex:
    """Codebooks from the sample, and the visits that meet ``recall`` on it.

    A pair counts as found when either vector visits the other's cell.
    Measured are the sample's linked pairs, and for every sample vector one
    made pair at exactly the threshold in a random direction.
    """
    x = unit(sample)
    cut = x.shape[1] // 2
    index = MultiIndex((kmeans(x[:, :cut], words, seed), kmeans(x[:, cut:], words, seed + 1)), 1)
    cells = len(index.words[0]) * len(index.words[1])
    rng = np.random.default_rng(seed + 2)
    probe = x[rng.permutation(len(x))[:500]]
    turn = rng.normal(size=probe.shape)
    turn -= (turn * probe).sum(1, keepdims=True) * probe
    pairs = []
    if x.shape[1] > 1:                      # one component has no other direction
        pairs.append((probe, cosine * probe + np.sqrt(1 - cosine * cosine) * unit(turn)))
    near = []
    for value in np.unique(labels):
        rows = np.flatnonzero(labels == value)
        for at in range(0, len(rows), 1000):
            i, j = np.nonzero(x[rows[at:at + 1000]] @ x[rows].T >= cosine)
            near += [(rows[at + a], rows[b]) for a, b in zip(i, j) if at + a < b]
    if near:
        picked = np.array(near)[rng.permutation(len(near))[:500]]
        pairs.append((x[picked[:, 0]], x[picked[:, 1]]))
    for left, right in pairs:
        a, b = index.order(left, cells), index.order(right, cells)
        ranks = sorted(min(p.index(q[0]), q.index(p[0])) + 1 for p, q in zip(a, b))
        index.visits = max(index.visits, ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)])
    return index


def sample_of(classes: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and label hashes of the sample: at most ``rows`` vectors come to the driver."""
    got = classes.orderBy(F.xxhash64(F.lit(SEED), "class_id"), "class_id").limit(rows).select(F.xxhash64("label").alias("l"), "vector").toPandas()
    return np.array(got["vector"].tolist(), np.float64), got["l"].to_numpy()


def tree(found: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest over the pairs of a block."""
    root: dict[int, int] = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    out = []
    for i, j in zip(*np.nonzero(found)):
        a, b = top(int(left[i])), top(int(right[j]))
        if a != b:
            root[a] = b
            out.append((int(left[i]), int(right[j])))
    return out


def verify(cosine: float):
    """Verifies the queries of a block against its members; a pair that both directions find counts in the direction
    from the smaller class."""
    def block(rows: pd.DataFrame) -> pd.DataFrame:
        member = rows["member"].to_numpy(bool)
        if member.all() or not member.any():
            return pd.DataFrame({"a": [], "n": [], "b": []}).astype("int64")
        rows = rows.sort_values("class_id")
        member = rows["member"].to_numpy(bool)
        m, q = rows[member], rows[~member]
        close = unit(np.stack(q["vector"])) @ unit(np.stack(m["vector"])).T >= cosine
        mid, qid = m["class_id"].to_numpy(), q["class_id"].to_numpy()
        cell, bits = q["own_cell"].to_numpy(), np.stack([np.frombuffer(v, np.uint8) for v in m["visited"]])
        # does the member visit the query's cell? then only the smaller of the two asks
        back = (bits[:, cell >> 3] >> (cell & 7) & 1).astype(bool).T
        close &= (qid[:, None] < mid) | ((qid[:, None] > mid) & ~back)
        mn, qn = m["n"].to_numpy(), q["n"].to_numpy()
        counts = pd.DataFrame({"a": np.concatenate([qid, mid]), "n": np.concatenate([close @ mn, qn @ close]), "b": -1})
        links = pd.DataFrame(tree(close, qid, mid), columns=["a", "b"]).assign(n=0)
        return pd.concat([counts[counts["n"] > 0], links])[["a", "n", "b"]].astype("int64")
    return block


def link(classes: DataFrame, index: MultiIndex, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(a, n, b), staged: either n more links of class a (b = -1), or a link a - b of the spanning forest (n = 0)."""
    cells = len(index.words[0]) * len(index.words[1])
    kind = pa.struct([("order", pa.list_(pa.int32())), ("visited", pa.binary())])

    @F.arrow_udf("struct<order:array<int>,visited:binary>")
    def filed(vectors: pa.Array) -> pa.Array:
        out = []
        if len(vectors):
            for order in index.order(unit(np.array(vectors.to_pylist(), np.float64))):
                bits = np.zeros(cells, np.uint8)
                bits[order] = 1
                out.append({"order": order, "visited": np.packbits(bits, bitorder="little").tobytes()})
        return pa.array(out, kind)

    placed = stage(classes.withColumn("f", filed("vector")).select(
        "class_id", "label", "n", "vector", F.get("f.order", F.lit(0)).alias("own_cell"), "f.order", "f.visited"), "vectors-filed")
    # members and queries of a cell are dealt to blocks by their numbers, so a cell of any size makes groups of one size
    asked = placed.select("label", F.explode("order").alias("cell"), F.col("own_cell"))
    blocks = lambda n: F.greatest(F.ceil(F.coalesce(n, F.lit(0)) / block), F.lit(1)).cast("int")
    sizes = stage(asked.groupBy("label", "cell").agg(
        blocks(F.count(F.lit(1))).alias("asks"), blocks(F.sum((F.col("cell") == F.col("own_cell")).cast("long"))).alias("holds")), "vectors-cells")
    deal = lambda n: F.pmod(F.xxhash64("class_id"), n).cast("int")
    rest = ["class_id", "n", "vector", "own_cell", "visited"]
    members = (placed.withColumn("cell", F.col("own_cell")).join(sizes, ["label", "cell"])
               .select("label", "cell", deal(F.col("holds")).alias("mb"), F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("qb"),
                       F.lit(True).alias("member"), *rest))
    queries = (placed.withColumn("cell", F.explode("order")).join(sizes, ["label", "cell"])
               .select("label", "cell", F.explode(F.sequence(F.lit(0), F.col("holds") - 1)).alias("mb"), deal(F.col("asks")).alias("qb"),
                       F.lit(False).alias("member"), *rest))
    return stage(members.union(queries).groupBy("label", "cell", "mb", "qb").applyInPandas(verify(cosine), "a long, n long, b long"),
                 "vectors-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, words: int = WORDS, recall: float = RECALL,
                    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept (vec_id = component_id)."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
                       & F.exists(v, lambda x: x != 0) & F.col(label_col).isNotNull(), F.lit(False))
    rows = stage(vectors.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("vec_id"),
                                F.struct(F.col(label_col).alias("label"), F.size(v).alias("dim")).alias("label"), F.col(vector_col).alias("vector"),
                                F.when(sound, F.sha2(F.array_join(v.cast("array<string>"), ",").cast("binary"), 256)).alias("digest")), "vectors")
    # equal vectors of one label are one class from here on; counted before the shuffle
    classes = stage(rows.where("digest IS NOT NULL").groupBy("label", "digest").agg(
        F.min("row_id").alias("class_id"), F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id")).alias("first"),
        F.first("vector").alias("vector")), "vector-classes")
    by_class = classes.select("class_id", "label", "digest", (F.col("n") - 1).alias("more"), "first")
    degrees = links = None
    for dim in [r.dim for r in classes.select("label.dim").distinct().collect()]:     # one index per vector length
        own = classes.where(F.col("label.dim") == dim).select("class_id", "label", "n", "vector")
        found = link(own, fit(*sample_of(own), cosine, words, recall), cosine)
        degree, edge = found.where("b < 0").groupBy("a").agg(F.sum("n").alias("links")), found.where("b >= 0").select("a", "b")
        degrees, links = (degree, edge) if degrees is None else (degrees.union(degree), links.union(edge))
    if degrees is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    labels = components(links, "vectors")
    named = (by_class.join(degrees.withColumnRenamed("a", "class_id"), "class_id", "left")
             .join(labels.select(F.col("node").alias("class_id"), F.col("label").alias("top")), "class_id", "left")
             .select("label", "digest", F.coalesce("top", "class_id").alias("top"), "first",
                     (F.col("more") + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = stage(named, "vector-named")
    best = stage(named.groupBy("top").agg(F.min("first").alias("best")), "vector-best")
    of_class = stage(named.join(best, "top").select("label", "digest", "n_links", F.col("best.vec_id").alias("component_id")), "vector-of-class")
    out = rows.join(of_class, ["label", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
