"""Toxicity by a classifier chain (operator 5).

The categories are predicted one after another by logistic regressions over
the words of the whole text and their beginnings; each model also gets the
probabilities of the categories before it.  For training these come from
models that have not seen the row (out of fold), so a later model learns how
far the earlier ones can be trusted.  The last category's threshold is the
one with the best F1 out of fold.

The models are fitted on a bounded sample: the ``max_rows`` labelled
documents with the smallest seeded hash of their id.  Every fit is a group of
that sample on an executor; scoring reads all documents.

Cases: a null text is an empty one; a label row without id, or whose document
is missing, is not used; a null label leaves its row out of that category's
fit; a document labelled or given twice counts once, with its largest labels
and text; without labels of both kinds a category's probability is its share
of ones (0 without labels) and nothing is rejected by it.  Other columns are
passed through unread.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import stage, whole_text

# Chain order: name, and the column of labels with the value that counts as one.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
MAX_ROWS = 8000         # labelled documents that a fit uses
MAX_FEATURES = 1000     # features of one model, by the weight of their evidence
MIN_ROWS = 5            # documents a feature must be in
FOLDS = 4
SEED = 5
BEGINNINGS = (4, 5)
MARKS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "«»“”„‘’…¿¡"
WORDS_KEPT = 300_000
FITTED = "part int, kind string, key long, value double"


def word_features(token: str) -> tuple[int, ...]:
    """Features of one lower-cased token: the word without marks, and its beginnings."""
    word = token.strip(MARKS)
    if not word:
        return ()
    return tuple(crc32(x.encode("utf-8", "surrogatepass")) - (1 << 31)
                 for x in (word, *(f"{n}:{word[:n]}" for n in BEGINNINGS if len(word) >= n)))


def features(text: str) -> list[int]:
    return sorted({f for token in set(text.lower().split()) for f in word_features(token)})


def select(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The features that tell ones from zeros best, by the z value of their log odds."""
    if not len(rows) or not sum(map(len, rows)):
        return np.empty(0, np.int64)
    flat, at = np.unique(np.concatenate(rows), return_inverse=True)
    ones = np.bincount(at, np.repeat(y, [len(r) for r in rows]), len(flat))
    n, n1 = np.bincount(at, minlength=len(flat)), y.sum()
    a, b, c, d = ones + .5, n - ones + .5, n1 - ones + .5, (len(y) - n1) - (n - ones) + .5
    z = np.abs(np.log(a / b) - np.log(c / d)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    z[n < MIN_ROWS] = 0
    best = np.lexsort((flat, -z))[:MAX_FEATURES]
    return np.sort(flat[best[z[best] > 0]])


def matrix(rows: list[np.ndarray], chosen: np.ndarray, previous: np.ndarray) -> np.ndarray:
    x = np.zeros((len(rows), len(chosen) + previous.shape[1]), np.float32)
    for i, r in enumerate(rows):
        x[i, np.searchsorted(chosen, r[np.isin(r, chosen)])] = 1
    x[:, len(chosen):] = previous
    return x


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2 logistic regression, by accelerated gradient steps."""
    n = len(y)
    share = y.mean() if n else 0.0
    w = np.zeros(x.shape[1] + 1)
    if share in (0.0, 1.0):
        return w[:-1], float("-inf") if share == 0 else float("inf")
    x1 = np.hstack([x, np.ones((n, 1), np.float32)])
    v = np.ones(x1.shape[1], np.float32)
    for _ in range(20):
        v = x1.T @ (x1 @ v)
        v /= np.linalg.norm(v)
    penalty = np.full(x1.shape[1], 1 / n)
    penalty[-1] = 0
    rate = 1 / (0.26 * float(np.linalg.norm(x1 @ v)) ** 2 / n + 1 / n)
    w[-1] = np.log(share / (1 - share))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ ahead.astype(np.float32), -30, 30)))
        new = ahead - rate * (x1.T @ (p - y).astype(np.float32) / n + penalty * ahead)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, w = new + (before - 1) / t * (new - w), new
    return w[:-1], float(w[-1])


def probability(score):
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def fit_part(rows: pd.DataFrame) -> pd.DataFrame:
    """One fit: part f is fitted without fold f and predicts it; part -1 is fitted on all rows and gives the weights."""
    rows = rows.sort_values("row_id")
    part = int(rows["part"].iloc[0])
    inside = (rows["fold"] != part).to_numpy() & rows["y"].notna().to_numpy()
    feats = [np.asarray(r, np.int64) for r in rows["features"]]
    previous = np.array(rows["previous"].tolist(), np.float64).reshape(len(rows), -1)
    y = rows["y"].to_numpy(float)
    own = [feats[i] for i in np.flatnonzero(inside)]
    chosen = select(own, y[inside])
    w, bias = logistic(matrix(own, chosen, previous[inside]), y[inside])
    if part < 0:
        return pd.DataFrame({"part": part, "kind": ["f"] * len(chosen) + ["p"] * (len(w) - len(chosen)) + ["b"],
                             "key": [*chosen, *range(len(w) - len(chosen)), 0], "value": [*w, bias]})
    out = np.flatnonzero((rows["fold"] == part).to_numpy())
    score = matrix([feats[i] for i in out], chosen, previous[out]) @ w + bias
    return pd.DataFrame({"part": part, "kind": "y", "key": rows["row_id"].to_numpy()[out], "value": probability(score)})


class Model:
    """Weights by feature, weights of the probabilities before, intercept: at most MAX_FEATURES numbers and a few."""

    def __init__(self, rows):
        self.words = {r.key: r.value for r in rows if r.kind == "f"}
        self.before = [r.value for r in sorted((r for r in rows if r.kind == "p"), key=lambda r: r.key)]
        self.bias = next((r.value for r in rows if r.kind == "b"), float("-inf"))


class Chain:
    """A fitted chain: one model per category, and the last one's threshold."""

    def __init__(self, names: list[str], models: list[Model], threshold: float):
        self.names, self.models, self.threshold = names, models, threshold
        self.known = set().union(*(m.words for m in models))
        self.memo: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def hits(self, text: str) -> set[int]:
        """The models' features that the text has."""
        found, memo = set(), self.memo
        for token in set(text.lower().split()):
            hit = memo.get(token)
            if hit is None:
                hit = tuple(f for f in word_features(token) if f in self.known)
                if len(memo) >= WORDS_KEPT:
                    memo.clear()
                if len(token) <= 64:
                    memo[token] = hit
            if hit:
                found.update(hit)
        return found

    def predict(self, text: str) -> list[float]:
        found, out = sorted(self.hits(text)), []
        for m in self.models:
            score = m.bias + sum(m.words.get(f, 0.0) for f in found) + sum(w * p for w, p in zip(m.before, out))
            out.append(float(probability(score)))
        return out

    def column(self, text: Column) -> Column:
        """Array of the categories' probabilities."""
        chain = self

        @F.arrow_udf("array<double>")
        def predicted(texts: pa.Array) -> pa.Array:
            return pa.array([chain.predict(t or "") for t in texts.to_pylist()], pa.list_(pa.float64()))

        return predicted(text)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which on F1 is best, half way down to the next lower one; infinite without ones."""
    if not len(y) or not y.sum():
        return float("inf")
    order = np.argsort(-p, kind="stable")
    p, hit = p[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + y.sum())
    f1[:-1][p[:-1] == p[1:]] = -1       # equal probabilities go together
    k = int(np.argmax(f1))
    return float((p[k] + p[k + 1]) / 2) if k + 1 < len(p) else float(p[k])


def fit(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = MAX_ROWS) -> Chain:
    wanted = [F.max(F.when(F.col(c).isNotNull(), (F.col(c) == one).cast("int"))).alias(f"y{k}") for k, (_, c, one) in enumerate(categories)]
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("row_id")).agg(*wanted)
    known = known.where(F.coalesce(*[F.col(f"y{k}") for k in range(len(categories))]).isNotNull())
    known = known.orderBy(F.xxhash64(F.lit(SEED), "row_id"), "row_id").limit(max_rows)

    @F.arrow_udf("array<int>")
    def feature_list(texts: pa.Array) -> pa.Array:
        return pa.array([features(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))

    # at most max_rows ids and a few numbers each, which the planner knows by the limit: it broadcasts them, so that no
    # text is shuffled but the sample's
    own = (docs.select(F.col(id_col).alias("row_id"), whole_text(text_col).alias("text")).join(known, "row_id")
           .groupBy("row_id").agg(F.max("text").alias("text"), *[F.max(f"y{k}").alias(f"y{k}") for k in range(len(categories))]))
    sample = stage(own.select("row_id", *[f"y{k}" for k in range(len(categories))], F.array().cast("array<double>").alias("previous"),
                              F.pmod(F.xxhash64(F.lit(SEED + 1), "row_id"), F.lit(FOLDS)).cast("int").alias("fold"),
                              feature_list("text").alias("features")), "toxicity-sample")
    models, parts = [], F.explode(F.array(*[F.lit(f) for f in range(-1, FOLDS)]))
    for k in range(len(categories)):
        fitted = stage(sample.select(parts.alias("part"), "row_id", "fold", F.col(f"y{k}").alias("y"), "previous", "features")
                       .groupBy("part").applyInPandas(fit_part, FITTED), f"toxicity-fit{k}")
        models.append(Model(fitted.where("part < 0").collect()))        # MAX_FEATURES + k + 1 rows
        held = fitted.where("kind = 'y'").select(F.col("key").alias("row_id"), F.col("value").alias("held"))
        sample = stage(sample.join(held, "row_id").withColumn("previous", F.concat("previous", F.array("held"))).drop("held"),
                       f"toxicity-held{k}")
    last = len(categories) - 1
    seen = sample.where(F.col(f"y{last}").isNotNull()).select("row_id", F.col(f"y{last}").alias("y"),
                                                              F.get("previous", F.lit(last)).alias("p")).toPandas()    # max_rows rows
    seen = seen.sort_values("row_id")
    return Chain([name for name, _, _ in categories], models, best_threshold(seen["p"].to_numpy(float), seen["y"].to_numpy(float)))


def score(docs: DataFrame, chain: Chain, text_col: str = "text", into: str = "scores") -> DataFrame:
    """``docs`` with a struct of the categories' probabilities and ``rejected``."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(own.alias("doc"), chain.column(whole_text(text_col)).alias("p"))
    scores = F.struct(*[F.get("p", F.lit(k)).alias(f"p_{name}") for k, name in enumerate(chain.names)],
                      (F.get("p", F.lit(len(chain.names) - 1)) >= F.lit(chain.threshold)).alias("rejected"))
    return rows.select("doc", scores.alias(into))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without those that the chain, fitted on them, rejects."""
    return score(docs, fit(docs, labels, **options)).where("NOT scores.rejected").select("doc.*")
