"""Subword tokens and a classifier trained on them.

A text's words are runs of letters and digits, or single other characters
(A-Z lower-cased if asked; control characters and spaces only separate).  A
word, with a space before it, is cut into the longest vocabulary entries from
left to right, over its UTF-8 bytes; a byte at which no entry starts is a
piece of its own, ``UNKNOWN``.

Texts are cut where they lie: no shuffle, and a Python worker cuts a word once
as long as it remembers it.  (Cutting each distinct word of the table once, into
a staged table that all word occurrences are joined with, gives the same pieces
but shuffles eight times the input.)  ``limit`` is the number of pieces that a
model takes of one text (None: all of them).

The vocabulary is a public file with an entry a line, base64 of its bytes and
its id.  It is read by the driver and sent to the workers, so its size is
checked.  Null and blank texts have no pieces.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.operators.sentiment import MICRO, _loaded, _ship, _token
from reviewflow.session import scratch_path

WORD = r"[\p{L}\p{N}]+|[^\x00-\x20\p{L}\p{N}]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# ``WORD`` for texts of ASCII alone, which need no character classes.
ASCII_WORD = re.compile(r"[A-Za-z0-9]+|[^\x00-\x20A-Za-z0-9]")
UNKNOWN = -1
# Entries of a vocabulary: what the driver and every Python worker hold.
MAX_ENTRIES = 1 << 20
# Words whose pieces a worker remembers, and their longest; when it is full it starts anew.
MEMO, MEMO_CHARS = 1 << 18, 64


@dataclass
class Vocabulary:
    """Entries (bytes → id); ``load`` makes the trie, a table of every prefix of an entry."""

    entries: dict
    prefixes: dict = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self):
        if len(self.entries) > MAX_ENTRIES:
            raise ValueError(f"{len(self.entries)} entries; at most {MAX_ENTRIES} are sent to the workers")

    def __getstate__(self):
        return {"entries": self.entries, "prefixes": {}}

    def load(self) -> None:
        for entry in self.entries:
            for end in range(1, len(entry)):
                self.prefixes.setdefault(entry[:end], UNKNOWN)
        self.prefixes |= self.entries

    def cut(self, word: str) -> list[int]:
        data, out, at = (" " + word).encode(), [], 0
        while at < len(data):
            piece, after, end = UNKNOWN, at + 1, at + 1
            while end <= len(data) and (found := self.prefixes.get(data[at:end])) is not None:
                if found != UNKNOWN:
                    piece, after = found, end
                end += 1
            out.append(piece)
            at = after
        return out


def read_vocabulary(path: str) -> Vocabulary:
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, lines)})


class _Memo(dict):
    """word → its pieces; a word that is not there is cut."""

    def __init__(self, cut):
        super().__init__()
        self.cut = cut

    def __missing__(self, word: str) -> list[int]:
        if len(word) > MEMO_CHARS:
            return self.cut(word)
        if len(self) >= MEMO:
            self.clear()
        pieces = self[word] = self.cut(word)
        return pieces


class Cutter:
    """The pieces of texts; loaded once for each Python worker."""

    def __init__(self, vocabulary: Vocabulary, limit: int | None = None, lower: bool = True):
        self.vocabulary, self.limit, self.lower = vocabulary, limit, lower
        self._words = self._memo = None

    def load(self) -> None:
        import regex

        self.vocabulary.load()
        self._words, self._memo = regex.compile(WORD), _Memo(self.vocabulary.cut)

    def words(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_WORD.findall(text.lower() if self.lower else text)
        if self.lower:                                  # bytes.lower changes A-Z only
            text = text.encode().lower().decode()
        return self._words.findall(text)

    def pieces(self, text: str | None) -> list[int]:
        words = self.words(text) if text else []
        if self.limit is not None:                      # a word has one piece at least
            words = words[: self.limit]
        return list(chain.from_iterable(map(self._memo.__getitem__, words)))[: self.limit]


def encode(text: str, vocabulary: Vocabulary, limit: int | None = None, lower: bool = True) -> Column:
    """array<int>: the pieces of a text in order."""
    _ship()
    cutter = Cutter(vocabulary, limit, lower)
    token = _token(cutter)

    @F.pandas_udf("array<int>")
    def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = _loaded(cutter, token)
        for texts in batches:
            yield texts.map(lambda t: np.array(c.pieces(t), np.int32))
    return _encode(F.col(text))


class SubwordClassifier:
    """Logits of a text: what each class weighs of itself plus the weights of the text's pieces.

    For ``sentiment.label_text`` and ``jobs label-reviews --variant model``.
    Weights are whole millionths, so sums are exact in any order.  Pieces
    that training did not see weigh nothing.
    """

    def __init__(self, cutter: Cutter, weights: np.ndarray, prior: np.ndarray, id2label: dict):
        self.cutter, self.weights, self.prior, self.id2label = cutter, weights, prior, dict(id2label)

    def load(self) -> None:
        self.cutter.load()
        # the last row, at UNKNOWN, weighs nothing
        self._rows = [*map(tuple, self.weights.tolist()), (0,) * len(self.prior)]
        self._of_word = _Memo(lambda word: self._weigh(self.cutter.vocabulary.cut(word)))

    def _weigh(self, pieces: list[int]) -> tuple:
        if len(pieces) == 1:
            return self._rows[pieces[0]]
        return tuple(map(sum, zip(*map(self._rows.__getitem__, pieces)))) if pieces else self._rows[UNKNOWN]

    def logits(self, texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None or not text.strip():
                return None
            if self.cutter.limit is not None:           # a word may be cut off in its middle
                found = [self._weigh(self.cutter.pieces(text))]
            else:                                       # what a word weighs is summed up once, as long as it is remembered
                found = map(self._of_word.__getitem__, self.cutter.words(text))
            flat = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, len(self.prior))
            return (self.prior + flat.sum(axis=0)).astype(float).tolist()
        return texts.map(one)


def train_subwords(train: DataFrame, text: str, label: str, id2label: dict, vocabulary: Vocabulary, limit: int | None = None,
                   lower: bool = True) -> SubwordClassifier:
    """Multinomial naive Bayes over the pieces of all labelled texts.

    ``label`` is a class number of ``id2label`` (rows of others or NULL are
    left out); add-one smoothing over the pieces seen.  The driver receives
    one row per piece seen, at most the entries of the vocabulary.
    """
    spark, classes = train.sparkSession, sorted(id2label)
    if classes != list(range(len(classes))):
        raise ValueError("classes are numbered from 0 on")
    known = train.where(F.col(label).isin(classes)).select(F.col(label).alias("y"), text)
    of = [F.sum((F.col("y") == c).cast("long")).alias(f"c{c}") for c in classes]
    path = scratch_path(spark, "piece-counts")
    ids = known.select("y", encode(text, vocabulary, limit, lower).alias("ids"))
    pieces = ids.select("y", F.explode("ids").alias("piece")).where(F.col("piece") != UNKNOWN)
    pieces.groupBy("piece").agg(*of).write.parquet(path)
    counts = spark.read.schema("piece int, " + ", ".join(f"c{c} long" for c in classes)).parquet(path)
    total = counts.agg(F.count(F.lit(1)).alias("size"), *[F.coalesce(F.sum(f"c{c}"), F.lit(0)).alias(f"c{c}") for c in classes]).first()
    rows = known.agg(*[F.coalesce(n, F.lit(0)).alias(f"c{c}") for c, n in zip(classes, of)]).first()

    def weight(c):
        return F.round(F.log((F.col(f"c{c}") + 1) / F.lit(float(max(1, total[f"c{c}"] + total["size"])))) * MICRO).cast("long")
    seen = counts.select("piece", *[weight(c).alias(f"c{c}") for c in classes]).toPandas()
    weights = np.zeros((max(vocabulary.entries.values(), default=0) + 1, len(classes)), np.int64)
    weights[seen["piece"].to_numpy(np.int64)] = seen[[f"c{c}" for c in classes]].to_numpy(np.int64)
    prior = np.rint(np.log([rows[f"c{c}"] + 1 for c in classes]) * MICRO).astype(np.int64)
    return SubwordClassifier(Cutter(vocabulary, limit, lower), weights, prior, id2label)
