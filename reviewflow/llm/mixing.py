"""Mixing sources to target weights by subset-sum budget fitting (operator 3).

Documents are counted by exact length in words.  A source whose target is
``t`` words and which has ``S`` words is taken ``t // S`` times as a whole;
the rest of its budget takes the same share of every length, rounded down,
then single documents by largest remainder, and the last stretch of the
budget is fitted by a bounded-knapsack dynamic program over the documents of
each length that are still free.  Where that misses the budget, the longest
documents are chosen anew by their subset sums over the whole of it and the
others fill what they leave; the closer plan is kept.  Which documents of a length are taken is
decided by a seeded hash.

Cases: null and blank texts have size 0 and are never taken; a null source is
a source of its own, the last; sources of size 0 get target 0; rows that
repeat id, source and text are dealt with one by one; an empty table gives an
empty result.  Other columns are passed through unread.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import stage, whole_text, word_count

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 11
# Longest stretch of words that the dynamic program fits; it bounds its memory, not the documents it may use below it.
FIT_WORDS = 1 << 16
# So many documents (in powers of two of each length) have their subset sums taken over the whole budget at full resolution.
STEPS = 4096
# Documents of one source and length are told apart by hash in so many slices; only one slice is ranked.
SLICES = 4096


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources in code point order, null last, weigh ``weights`` repeating.  A
    target is min(cap, level * weight) where the level makes the targets add
    up to all words: the level that resharing the excess again and again ends
    at.  Sources are sorted by cap per weight; the level is that at the first
    source which stays under its cap, the highest of all that do.
    """
    every = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                      (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")))
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    order = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    # words and weights of the sources from here on, were all before capped
    level = weighed.withColumn("level", (
        F.sum(F.col("source_size").cast("double")).over(every)
        - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    level = level.withColumn("level", F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(every))
    return level.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def fit(lengths: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take so that the words come closest to ``budget`` from below.

    Bounded knapsack: ``used[v]`` says which length first made v words
    reachable and how often it was used, which is all that tracing back needs.
    Ends as soon as the budget itself is reachable.
    """
    taken = np.zeros(len(lengths), np.int64)
    reach = np.zeros(budget + 1, bool)
    reach[0] = True
    by, used = np.full(budget + 1, -1, np.int64), np.zeros(budget + 1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        size, before = int(lengths[i]), reach.copy()
        for times in range(1, min(int(free[i]), budget // size) + 1):
            fresh = np.flatnonzero(before[: budget + 1 - size * times]) + size * times
            fresh = fresh[~reach[fresh]]
            if not len(fresh):
                if times * size > budget:
                    break
                continue
            reach[fresh], by[fresh], used[fresh] = True, i, times
        if reach[budget]:
            break
    left = int(np.flatnonzero(reach)[-1])
    while left:
        i, times = by[left], used[left]
        taken[i] += times
        left -= int(lengths[i]) * int(times)
    return taken


def spread(lengths: np.ndarray, counts: np.ndarray, budget: int, fit_words: int) -> np.ndarray:
    """The same share of every length, then by largest remainder, then longest first, the last stretch by ``fit``."""
    share = counts * (budget / int((lengths * counts).sum()))
    extra = np.minimum(np.floor(share).astype(np.int64), counts)
    left = budget - int((extra * lengths).sum())
    for i in np.lexsort((lengths, extra - share)):      # largest remainder first
        if left <= fit_words:
            break
        if lengths[i] <= left and extra[i] < counts[i]:
            extra[i] += 1
            left -= int(lengths[i])
    for i in np.argsort(-lengths, kind="stable"):       # lengths so uneven that one of each leaves much
        if left <= fit_words:
            break
        more = min(int(counts[i] - extra[i]), left // int(lengths[i]))
        extra[i] += more
        left -= more * int(lengths[i])
    return extra + _fill(lengths, counts - extra, left, fit_words)


def _fill(lengths: np.ndarray, free: np.ndarray, left: int, fit_words: int) -> np.ndarray:
    more, near = np.zeros(len(lengths), np.int64), np.flatnonzero((lengths <= left) & (free > 0))
    if 0 < left <= fit_words and len(near):
        more[near] = fit(lengths[near], free[near], left)
    return more


def long_first(lengths: np.ndarray, counts: np.ndarray, budget: int, fit_words: int, steps: int = STEPS) -> np.ndarray:
    """A plan whose longest documents are chosen before the others, over the whole budget.

    Subset sums of the long documents at a resolution of ``fit_words`` steps
    (fewer, if there are many documents; each word a step, if the budget is
    no longer): a step keeps one exact sum.  Of the sums that the short
    documents can fill up to the budget, or come closest to it with, the one
    nearest to the long documents' share is taken; the short ones then get
    the rest.  All documents longer than ``fit_words`` are long, and as many
    others as ``steps`` allows.
    """
    order, items = np.argsort(-lengths, kind="stable"), []
    long = np.zeros(len(lengths), bool)
    for i in order:
        n, parts = int(counts[i]), []
        while n:                                        # any number up to n is a sum of these parts
            parts.append(min(1 << len(parts), n))
            n -= parts[-1]
        if lengths[i] <= fit_words and len(items) + len(parts) > steps:
            break
        long[i] = True
        items += [(i, m) for m in parts]
    bins = max(1, min(fit_words, budget, fit_words * steps // max(1, len(items))))
    sums, by, prev = (np.full(bins + 1, -1, np.int64) for _ in range(3))
    sums[0] = 0
    for k, (i, m) in enumerate(items):
        at = np.flatnonzero(sums >= 0)
        value = sums[at] + int(lengths[i]) * m
        at, value = at[value <= budget], value[value <= budget]
        to, one = np.unique(value * bins // budget, return_index=True)
        one = one[sums[to] < 0]
        to = to[sums[to] < 0]
        sums[to], by[to], prev[to] = value[one], k, at[one]
    short = int((lengths * counts)[~long].sum())
    share = budget * (1 - short / int((lengths * counts).sum()))
    found = np.flatnonzero(sums >= 0)
    v = found[np.lexsort((np.abs(sums[found] - share), np.maximum(budget - sums[found] - short, 0)))[0]]
    extra = np.zeros(len(lengths), np.int64)
    left = budget - int(sums[v])
    while by[v] >= 0:
        i, m = items[by[v]]
        extra[i] += m
        v = prev[v]
    if short:
        extra[~long] = counts[~long] if left >= short else spread(lengths[~long], counts[~long], left, fit_words)
    return extra + _fill(lengths, counts - extra, budget - int((extra * lengths).sum()), fit_words)


def plan_source(lengths: np.ndarray, counts: np.ndarray, target: float, fit_words: int = FIT_WORDS) -> tuple[int, np.ndarray]:
    """(times every document is taken, how many of each length once more) for lengths > 0.

    ``spread`` never takes a document back; where it misses the budget
    ``long_first`` is tried too, and the closer one is kept.
    """
    total = int((lengths * counts).sum())
    times = int(target // total)
    budget = int(target) - times * total
    extra = spread(lengths, counts, budget, fit_words)
    if int((extra * lengths).sum()) < budget:
        other = long_first(lengths, counts, budget, fit_words)
        if int((other * lengths).sum()) > int((extra * lengths).sum()):
            extra = other
    return times, extra


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    times, extra = plan_source(lengths, counts, float(rows["target"].iloc[0]))
    return pd.DataFrame({"source": rows["source"], "size": lengths, "times": times, "extra": extra})


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_repeat: int = MAX_REPEAT, seed: int = SEED, carry: bool = True) -> DataFrame:
    """One row per input row: doc (its columns, if ``carry``), doc_id, size, source_size, target, copies, taken."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(None).cast("string")
    rows = stage(docs.select(
        own.alias("doc"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(whole_text(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("pick")), "mix-rows")
    rows = rows.withColumn("slice", F.pmod("pick", F.lit(SLICES)).cast("int"))
    slices = stage(rows.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n")), "mix-slices")
    lengths = stage(slices.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-lengths")
    aims = stage(targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                         weights, max_repeat), "mix-targets")
    # one group per source holds its distinct lengths, which no number of documents makes more than the longest text
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    counted = lengths.where("size > 0").alias("n").join(aims.alias("t"), F.expr("n.source <=> t.source"))
    plan = stage(counted.select("n.source", "n.size", "n.n", "t.target").groupBy("source").applyInPandas(
        _plan, "source string, size long, times long, extra long"), "mix-plan")
    # how many of a slice are taken: what the slices before it leave of its length's number
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = (slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).alias("s")
           .join(plan.alias("p"), F.expr("s.source <=> p.source AND s.size = p.size"), "left")
           .join(aims.alias("t"), F.expr("s.source <=> t.source"))
           .select("s.source", "s.size", "s.slice", F.coalesce("p.times", F.lit(0)).alias("times"), "t.source_size", "t.target",
                   F.coalesce(F.col("p.extra") - F.col("s.before"), F.lit(0)).alias("extra")))
    cut = stage(cut, "mix-cut")
    # ranked within a slice: a third of all rows in one source and length are still spread over the slices
    rank = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("pick", "doc_id"))
    ranked = rows.withColumn("rank", rank)
    joined = ranked.alias("r").join(cut.alias("c"), same(ranked, cut) & (ranked["size"] == cut["size"])
                                    & (ranked["slice"] == cut["slice"]))
    copies = (F.col("c.times") + (F.col("r.rank") <= F.col("c.extra")).cast("long")) * (F.col("r.size") > 0).cast("long")
    return joined.select("r.doc", "r.doc_id", "r.size", "c.source_size", "c.target", copies.alias("copies"),
                         (F.col("r.size") * copies).alias("taken"))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken; all columns as they were."""
    mixed = mix(docs, **options).where("copies > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
