"""Labelling and scoring review text.

Two contracts, as in the source pipeline:

* ``label_text``  — a classifier: blank text → '', otherwise logits → argmax
  → label name.
* ``score_text``  — a scorer: text → struct(label, score), unpacked into two
  columns, label by the ±0.25 rule.

The scorer is pluggable.  Neither the source's transformer weights nor its
cloud service are reachable here, so the defaults are lexicon scorers built
on the fixed adjective lists.  They satisfy the column contracts; they do
not reproduce the source models' outputs.

``lexicon_score`` is the native (Catalyst) form and is what to use at scale.
The pandas forms show the slow path for real models: an iterator pandas UDF
receives Arrow batches, loads the model once per Python worker and scores a
whole batch per call.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewflow import constants as K
from reviewflow.functions import exprs as X
from reviewflow.session import scratch_path

TOKEN_SPLIT = "[^a-z-]+"           # hyphen is a word character (top-notch, run-of-the-mill)


# ------------------------------------------------------------ native lexicon

def tokens(text) -> Column:
    return F.split(F.lower(F.col(text) if isinstance(text, str) else text), TOKEN_SPLIT)


def count_in(toks, words: list) -> Column:
    """Number of tokens (an array column) that are in ``words``."""
    own = sorted(set(words))        # a set predicate: one hash lookup per token
    return F.size(F.filter(F.col(toks) if isinstance(toks, str) else toks, lambda t: t.isin(*own)))


def lexicon_count(text, words: list) -> Column:
    return count_in(tokens(text), words)


def lexicon_score(df: DataFrame, text: str, positive: list = K.ADJECTIVES_POSITIVE,
                  negative: list = K.ADJECTIVES_NEGATIVE, prefix: str = "") -> DataFrame:
    """Counts of positive / negative words, score (p-n)/(p+n) (0 when none), label.

    NULL text scores NULL.
    """
    df = df.withColumn("__tok", tokens(text))          # split once, count per lexicon
    df = df.withColumns({f"{prefix}n_pos": count_in("__tok", positive),
                         f"{prefix}n_neg": count_in("__tok", negative)}).drop("__tok")
    pc, nc = F.col(f"{prefix}n_pos"), F.col(f"{prefix}n_neg")
    score = F.when(F.col(text).isNull(), F.lit(None).cast("double")) \
        .when(pc + nc == 0, F.lit(0.0)) \
        .otherwise((pc - nc).cast("double") / (pc + nc).cast("double"))
    return df.withColumn(f"{prefix}score", score).withColumn(f"{prefix}label", X.score_label(f"{prefix}score"))


def lexicon_classify(df: DataFrame, text: str, lexicons=(K.ADJECTIVES_NEGATIVE, K.ADJECTIVES_NEUTRAL,
                                                        K.ADJECTIVES_POSITIVE),
                     id2label: dict | None = None, label_col: str = "sentiment") -> DataFrame:
    """U1 in Catalyst: logits = word counts per lexicon, argmax → label; blank → ''.

    Same rule as ``LexiconClassifier`` through ``label_text``, without a
    Python worker.
    """
    id2label = id2label or dict(enumerate(K.RATING_CLASSES))
    # tokens and logits get their own projections: each is read several times,
    # and nothing inside a CASE branch is shared, so inlined they would be
    # recomputed per reference
    out = df.withColumn("__tok", tokens(text))
    logits = F.array(*[count_in("__tok", lex).cast("double") for lex in lexicons])
    out = out.withColumn("__logits", F.when(~X.is_blank(text), logits)).drop("__tok")
    name = X.lookup(id2label, X.argmax(F.col("__logits")))
    return out.withColumn(label_col, F.when(X.is_blank(text), F.lit("")).otherwise(name)).drop("__logits")


# --------------------------------------------------------- pluggable scorers

class LexiconScorer:
    """Python twin of ``lexicon_score``: score(texts) → DataFrame(label, score)."""

    def __init__(self, positive=K.ADJECTIVES_POSITIVE, negative=K.ADJECTIVES_NEGATIVE,
                 hi: float = K.SCORE_POSITIVE_ABOVE, lo: float = K.SCORE_NEGATIVE_BELOW):
        self.positive, self.negative = frozenset(positive), frozenset(negative)
        self.hi, self.lo = hi, lo
        self._split = None

    def load(self) -> None:               # a real model would load its weights here
        self._split = re.compile(TOKEN_SPLIT)

    def _score_one(self, t):
        if t is None:
            return None
        toks = self._split.split(t.lower())
        p = sum(1 for w in toks if w in self.positive)
        n = sum(1 for w in toks if w in self.negative)
        return 0.0 if p + n == 0 else (p - n) / (p + n)

    def score(self, texts: pd.Series) -> pd.DataFrame:
        s = texts.map(self._score_one)
        pos, neg, mixed = K.SCORE_LABELS
        label = s.map(lambda v: None if v is None or pd.isna(v) else
                      pos if v > self.hi else neg if v < self.lo else mixed)
        return pd.DataFrame({"label": label, "score": s.astype("float64")})


class LexiconClassifier:
    """Three-class classifier: logits = counts of negative / neutral / positive words."""

    id2label = dict(enumerate(K.RATING_CLASSES))

    def __init__(self, lexicons=(K.ADJECTIVES_NEGATIVE, K.ADJECTIVES_NEUTRAL, K.ADJECTIVES_POSITIVE)):
        self.lexicons = [frozenset(x) for x in lexicons]
        self._split = None

    def load(self) -> None:
        self._split = re.compile(TOKEN_SPLIT)

    def logits(self, texts: pd.Series) -> pd.Series:
        def one(t):
            if t is None or not t.strip():
                return None
            toks = self._split.split(t.lower())
            return [float(sum(1 for w in toks if w in lex)) for lex in self.lexicons]
        return texts.map(one)


class OnnxTextClassifier:
    """A transformer text classifier exported to ONNX, run inside Python workers.

    The executor-side form of a model-based labeller: ``load()`` opens the
    tokenizer (``tokenizers`` JSON file) and the ONNX session once per worker;
    ``logits(texts)`` tokenises a whole Arrow batch (padded; cut
    only at ``max_length``, the model's own limit, when given), runs the model in chunks of ``batch_size`` and
    returns one logit vector per text (NULL for blank text, which never
    reaches the model).  Use with ``label_text(df, col, OnnxTextClassifier(…))``
    or ``jobs label-reviews --variant model --scorer module:Class``.
    Both libraries are optional; they are imported in ``load()``.
    """

    def __init__(self, model_path: str, tokenizer_path: str, id2label: dict, max_length: int | None = None,
                 batch_size: int = 32, input_names=("input_ids", "attention_mask")):
        self.model_path, self.tokenizer_path = model_path, tokenizer_path
        self.id2label = dict(id2label)
        self.max_length, self.batch_size, self.input_names = max_length, batch_size, tuple(input_names)
        self._tok = self._sess = None

    def load(self) -> None:
        import onnxruntime as ort
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(self.tokenizer_path)
        if self.max_length:
            tok.enable_truncation(max_length=self.max_length)
        tok.enable_padding()
        self._tok = tok
        self._sess = ort.InferenceSession(self.model_path, providers=["CPUExecutionProvider"])

    def logits(self, texts: pd.Series) -> pd.Series:
        import numpy as np

        keep = [i for i, t in enumerate(texts) if t is not None and t.strip()]
        out = [None] * len(texts)
        for start in range(0, len(keep), self.batch_size):
            idx = keep[start:start + self.batch_size]
            enc = self._tok.encode_batch([texts.iloc[i] for i in idx])
            feeds = {self.input_names[0]: np.array([e.ids for e in enc], dtype=np.int64)}
            if len(self.input_names) > 1:
                feeds[self.input_names[1]] = np.array([e.attention_mask for e in enc], dtype=np.int64)
            scores = self._sess.run(None, feeds)[0]
            for i, row in zip(idx, scores):
                out[i] = [float(x) for x in row]
        return pd.Series(out, index=texts.index, dtype=object)


_LOADED: tuple | None = None


def _token(scorer) -> str:
    """What a scorer is, by content: tasks unpickle copies, and copies of one scorer share a token."""
    return hashlib.sha256(cloudpickle.dumps(scorer)).hexdigest()


def _loaded(scorer, token: str):
    """The loaded scorer of a Python worker process: loaded once for all its tasks and batches.

    One entry is held; another scorer takes its place, so workers that live
    through many queries do not grow.
    """
    global _LOADED
    if _LOADED is None or _LOADED[0] != token:
        _LOADED = None          # let the old weights go before the new ones come
        scorer.load()
        _LOADED = (token, scorer)
    return _LOADED[1]


def _ship() -> None:
    from pyspark.sql import SparkSession

    from reviewflow.session import ship_package
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)


def score_udf(scorer):
    _ship()
    token = _token(scorer)
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(schema)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        s = _loaded(scorer, token)
        for texts in batches:
            yield s.score(texts)
    return _score


def logits_udf(classifier):
    _ship()
    token = _token(classifier)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = _loaded(classifier, token)
        for texts in batches:
            yield c.logits(texts)
    return _logits


def score_text(df: DataFrame, text: str, scorer=None, label_col: str = "sentiment",
               score_col: str = "sentiment_score") -> DataFrame:
    """One scorer call per row through a single struct column, then unpacked.

    Keeping one struct column means one ArrowEvalPython node, so unpacking two
    fields does not call the scorer twice.
    """
    scorer = scorer or LexiconScorer()
    r = score_udf(scorer)(F.col(text))
    out = df.withColumn("__r", r)
    return out.withColumns({label_col: F.col("__r.label"), score_col: F.col("__r.score").cast("float")}) \
        .drop("__r")


def label_text(df: DataFrame, text: str, classifier=None, label_col: str = "sentiment") -> DataFrame:
    """Blank → ''; else argmax of the classifier's logits → label name.

    Blank rows are answered in Catalyst; the classifier also returns NULL for
    them, so a model never sees an empty input.
    """
    classifier = classifier or LexiconClassifier()
    logits = logits_udf(classifier)(F.col(text))
    name = X.lookup(classifier.id2label, X.argmax(F.col("__logits")))
    out = df.withColumn("__logits", F.when(~X.is_blank(text), logits))
    return out.withColumn(label_col, F.when(X.is_blank(text), F.lit("")).otherwise(name)).drop("__logits")


# ------------------------------------------------------------- trained scorer

def train_scorer(train: DataFrame, text: str, label: str, num_features: int = 1 << 18, max_iter: int = 20,
                 save_path: str | None = None):
    """U4: a distributed text classifier (tokenise → hashed TF → IDF → logistic regression).

    The fitted pipeline is saved (by default below the shared checkpoint
    folder) and loaded back: the loaded model is what executors receive, and
    it carries no training summary (which holds the session and must not be
    shipped with the scoring UDFs).
    """
    from pyspark import StorageLevel
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    tok = RegexTokenizer(inputCol=text, outputCol="__tok", pattern=TOKEN_SPLIT, toLowercase=True)
    htf = HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features)
    # term frequencies are read by the IDF pass and by every optimizer
    # iteration: tokenise once and keep them (memory, spilling to disk)
    tf = htf.transform(tok.transform(train)).select(label, "__tf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        idf = IDF(inputCol="__tf", outputCol="__features").fit(tf)
        lr = LogisticRegression(featuresCol="__features", labelCol=label, maxIter=max_iter,
                                predictionCol="__prediction", probabilityCol="__probability",
                                rawPredictionCol="__raw").fit(idf.transform(tf))
    finally:
        tf.unpersist()
    model = PipelineModel(stages=[tok, htf, idf, lr])
    path = save_path or scratch_path(train.sparkSession, "scorer-model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def apply_trained(model, df: DataFrame, id2label: dict, label_col: str = "sentiment",
                  score_col: str = "sentiment_score") -> DataFrame:
    """Score with a trained pipeline: label name by argmax (the prediction), score = P(class 1)."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    prob = vector_to_array(F.col("__probability"))
    out = out.withColumns({
        label_col: X.lookup(id2label, F.col("__prediction").cast("int")),
        score_col: F.element_at(prob, -1).cast("float"),
    })
    return out.drop("__tok", "__tf", "__features", "__raw", "__probability", "__prediction")


# ------------------------------------------------------- naive Bayes by counts

MICRO = 1_000_000       # weights are whole millionths of a natural log, so sums are exact in any order
HEAD_TOKENS, HEAD_LENGTH = 1 << 17, 64      # the most tokens of a model's head and their longest, so a task holds some 15 MB
HEAD_ROW = 18           # bytes a row of the staged head has at most beside its token's letters


@dataclass
class CountsModel:
    """Naive Bayes by counts: a staged table (token, weight) of any size, and the weight every text has.

    ``head``, staged on its own, holds the most frequent tokens, ``tail`` all others (None, None: not split)."""

    weights: DataFrame
    prior: int
    head: DataFrame | None = None
    tail: DataFrame | None = None


def _broadcast_limit(spark) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _words(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return df.select(*keys, F.explode(tokens(text)).alias("token")).filter("token <> ''")


def _counted(words: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, token, times): the tokens of each text, counted before they are shuffled by token."""
    return words.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("times"))


def train_counts(train: DataFrame, text: str, label: str) -> CountsModel:
    """U4: multinomial naive Bayes by aggregates over every token of the labelled rows.

    ``label`` is 0/1 (NULL rows are left out), with add-one smoothing over the
    whole vocabulary; a weight is the log odds of class 1 in millionths.  The
    counts are staged as a table and never come to the driver; only their
    three sums, the two class sizes and how many tokens have about which
    count do.  The head is the counts' upper end, as far as it has no more
    than ``HEAD_TOKENS`` tokens and Spark broadcasts a table of that size.
    """
    spark = train.sparkSession
    known = train.filter(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("y"), text)
    hits = known.select("y", F.explode(tokens(text)).alias("token")).filter("token <> ''")
    counts = hits.groupBy("token").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    path = scratch_path(spark, "token-counts")
    counts.write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    total = counts.agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("size")).first()
    rows = known.agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).first()

    def share(c):
        return F.log((F.col(c) + 1) / F.lit(float((total[c] or 0) + total["size"])))
    weight = F.round((share("p") - share("n")) * MICRO).cast("long").alias("weight")
    # quarters of a power of two; tokens too long for the head come last
    size = F.when(F.length("token") <= HEAD_LENGTH, F.floor(F.log2(F.col("p") + F.col("n")) * 4)).otherwise(F.lit(-1))
    tokens_held, bytes_held, least = 0, 0, None
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("token") + HEAD_ROW).alias("bytes")).collect(), reverse=True):
        tokens_held, bytes_held = tokens_held + r["n"], bytes_held + r["bytes"]
        if r["size"] < 0 or tokens_held > HEAD_TOKENS or bytes_held > _broadcast_limit(spark):
            break
        least = r["size"]
    head = tail = None
    if least is not None:
        head, path = counts.where(size >= least).select("token", weight), scratch_path(spark, "token-head")
        head.hint("rebalance").write.parquet(path)
        head, tail = spark.read.schema(head.schema).parquet(path), counts.where(size < least).select("token", weight)
    prior = round((math.log((rows["p"] or 0) + 1) - math.log((rows["n"] or 0) + 1)) * MICRO)
    return CountsModel(counts.select("token", weight), prior, head, tail)


def apply_counts(model: CountsModel, df: DataFrame, key: str, text: str, id2label: dict, label_col: str = "sentiment") -> DataFrame:
    """Score with ``train_counts``: key, log_odds (millionths), label name; tokens the model lacks weigh nothing.

    Most occurrences are of few tokens: those of the model's head are weighed
    where the text is read and sent as one sum a text.  For all other tokens,
    and for all where the session does not broadcast a table of the head's size,
    each text sends one row per different token to the join; a token that a
    large part of all texts have is split by AQE, as both sides may be large.
    Every key has the prior, so texts without tokens are kept.
    """
    words, far, near = _words(df, [key], text), model.weights, None
    if model.head is not None and int(str(model.head._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= _broadcast_limit(df.sparkSession):
        near = words.join(model.head, "token").select(key, "weight")
        words, far = words.join(model.head.select("token"), "token", "left_anti"), model.tail
    weighed = _counted(words, [key]).join(far, "token").select(key, (F.col("weight") * F.col("times")).alias("weight"))
    weighed = weighed if near is None else weighed.union(near)
    every = df.select(key, F.lit(model.prior).cast("long").alias("weight"))
    out = weighed.union(every).groupBy(key).agg(F.sum("weight").alias("log_odds"))
    return out.withColumn(label_col, F.when(F.col("log_odds") > 0, F.lit(id2label[1])).otherwise(F.lit(id2label[0])))
