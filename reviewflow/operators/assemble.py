"""Assembling API results.

The source pipeline followed page tokens and called a detail endpoint in
driver-side loops.  Here the landed pages and details are tables, and the
loops become joins and aggregates that partition on their keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow.operators.clean import dedup_on_key
from reviewflow.operators.flatten import FIRST_CHILD
from reviewflow.session import scratch_path

FIRST_PAGE_OK = ("OK", "ZERO_RESULTS")
NEXT_PAGE_OK = "OK"
_NO_CUT = 2 ** 31 - 1
_SLICES = 16


def first_n(arr, n: int = K.REAL_REVIEWS_LIMIT):
    """L1/A4: first ``n`` elements in source order; NULL array → empty."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.slice(F.coalesce(a, F.array()), 1, n)


def union_batches(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing in a batch become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def page_cuts(pages: DataFrame, request: str = "request_id", page_no: str = "page_no",
              status: str = "status", token: str = "next_page_token", results: str = "results") -> DataFrame:
    """Per request, the first bad page (the cut); requests without a bad page have no row.

    Page 1 is bad if its status is not OK/ZERO_RESULTS or it has no results
    (the whole request yields nothing).  Page k > 1 is bad if page k-1 is
    missing, page k-1 carried no token, or its own status is not OK.  The
    previous page is found by an equi-join on (request, page_no - 1) — no
    window over a request, so a request with a huge number of pages still
    spreads over many tasks — and only light columns (no result arrays) take
    part in that join.
    """
    light = pages.filter(F.col(page_no) >= 1).select(
        request, page_no, status, F.col(token).isNotNull().alias("__has_token"),
        F.coalesce(F.size(results), F.lit(0)).alias("__n"))
    prev = light.select(F.col(request), (F.col(page_no) + 1).alias(page_no), F.lit(True).alias("__has_prev"),
                        F.col("__has_token").alias("__prev_token"))
    j = light.join(prev, [request, page_no], "left")
    first_bad = (~F.coalesce(F.col(status).isin(*FIRST_PAGE_OK), F.lit(False))) | (F.col("__n") <= 0)
    next_bad = F.col("__has_prev").isNull() | ~F.coalesce(F.col("__prev_token"), F.lit(False)) | \
        ~F.coalesce(F.col(status) == NEXT_PAGE_OK, F.lit(False))
    bad = F.when(F.col(page_no) == 1, first_bad).otherwise(next_bad)
    return j.filter(bad).groupBy(request).agg(F.min(page_no).alias("cut"))


def assemble_pages(pages: DataFrame, request: str = "request_id", page_no: str = "page_no",
                   status: str = "status", token: str = "next_page_token", results: str = "results",
                   result_col: str = "result") -> DataFrame:
    """Results of pages 1..k-1 where k is the first bad page, one row per result.

    Output: request, page_no, pos (position within the page), result.  The
    pages (with their result arrays) are joined once to ``page_cuts`` — one
    row per request with a bad page — so AQE can broadcast the cuts once
    measured small, or split a skewed request partition otherwise.
    """
    kept = kept_pages(pages, request, page_no, status, token, results)
    return kept.select(request, page_no, F.posexplode(results).alias("pos", result_col))


def kept_pages(pages: DataFrame, request: str = "request_id", page_no: str = "page_no", status: str = "status",
               token: str = "next_page_token", results: str = "results", carry: list | None = None) -> DataFrame:
    """J2 by page: request, page_no, results (and ``carry`` columns) of pages 1..k-1 before the first bad page k."""
    cuts = page_cuts(pages, request, page_no, status, token, results)
    return pages.filter(F.col(page_no) >= 1).select(request, page_no, results, *(carry or [])) \
        .join(cuts, request, "left").filter(F.col(page_no) < F.coalesce(F.col("cut"), F.lit(_NO_CUT))).drop("cut")


def follow_tokens(pages: DataFrame, request: str = "request_id", token: str = "page_token", status: str = "status",
                  next_token: str = "next_page_token", results: str = "results", result_col: str = "result") -> DataFrame:
    """J2 where pages carry no usable number: the pages that following the tokens from the first page reaches.

    ``token`` is the token a page was asked for with, NULL for a request's
    first page.  A page's successor is the one asked for with its
    ``next_token``, if that page is there and OK; the walk of a request ends
    where there is none, and a request whose first page is bad or empty yields
    nothing.  A token that leads back to a page of the walk ends it as well;
    pages that no walk reaches, in loops of their own or behind a gap, are
    left out.  Of pages of one request and token the first by status, next
    token and a hash of the results counts.

    Output as ``assemble_pages``: request, page_no (place in the walk), pos, result.

    The walks are not stepped along: pointers are doubled, so a walk of any
    length takes a number of rounds logarithmic in it.  Each round joins
    tables of two numbers per page by page, not by request.
    """
    spark = pages.sparkSession

    def staged(df, name):
        path = scratch_path(spark, f"walk-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    every = pages.select(F.col(request), F.col(token).alias("__token"), F.col(status).alias("__status"), F.col(next_token).alias("__next"),
                         F.coalesce(results, F.array().cast(pages.schema[results].dataType)).alias("__results"))
    unlike = [F.col("__status").asc_nulls_last(), F.col("__next").asc_nulls_last(), F.xxhash64("__results")]
    one = staged(dedup_on_key(every, [request, "__token"], unlike).withColumn("page", F.monotonically_increasing_id()), "pages")
    starts = (one.filter(F.col("__token").isNull() & F.col("__status").isin(*FIRST_PAGE_OK) & (F.size("__results") > 0))
              .select("page", F.lit(0).cast("long").alias("at")))
    goals = one.filter(F.col("__token").isNotNull() & (F.col("__status") == NEXT_PAGE_OK)).select(
        request, F.col("__token").alias("__next"), F.col("page").alias("to"))
    jump = staged(one.select(request, "__next", "page").join(goals, [request, "__next"]).select("page", "to"), "links")
    reached, known, step = staged(starts, "start"), -1, 1
    while True:
        n = reached.count()
        if n == known:
            break
        further = reached.join(jump, "page").select(F.col("to").alias("page"), (F.col("at") + step).alias("at"))
        # a page met again, through a loop, keeps its first place
        reached, known = staged(reached.union(further).groupBy("page").agg(F.min("at").alias("at")), f"reached{step}"), n
        jump = staged(jump.join(jump.select(F.col("page").alias("to"), F.col("to").alias("beyond")), "to").select("page", F.col("beyond").alias("to")),
                      f"links{step}")
        step *= 2
    return one.join(reached, "page").select(request, (F.col("at") + 1).cast("int").alias("page_no"),
                                            F.posexplode("__results").alias("pos", result_col))


def request_outcomes(pages: DataFrame, request: str = "request_id", page_no: str = "page_no",
                     status: str = "status", token: str = "next_page_token", results: str = "results") -> DataFrame:
    """Per request — 'failed' (page 1 missing or bad status), 'empty' (no results), or 'ok';
    with the number of pages and results ``assemble_pages`` keeps.

    One partially aggregated pass over the pages joined to their cut (no
    explode: results are counted by array size).  The join is on (request,
    slice of pages), the cuts being repeated for the slices, so a request
    with a large part of all pages meets its cut in ``_SLICES`` tasks, and
    each of them hands one partial row to the final aggregate.
    """
    cuts = page_cuts(pages, request, page_no, status, token, results) \
        .withColumn("__slice", F.explode(F.sequence(F.lit(0), F.lit(_SLICES - 1))))
    j = pages.select(request, page_no, status, F.coalesce(F.size(results), F.lit(0)).alias("__n"),
                     F.pmod(F.coalesce(page_no, F.lit(0)), F.lit(_SLICES)).alias("__slice")) \
        .join(cuts, [request, "__slice"], "left")
    kept = (F.col(page_no) >= 1) & (F.col(page_no) < F.coalesce(F.col("cut"), F.lit(_NO_CUT)))
    # 2 failed, 1 empty, 0 ok — decided by page 1 (no page 1: failed)
    code = F.when(~F.coalesce(F.col(status).isin(*FIRST_PAGE_OK), F.lit(False)), 2) \
        .when(F.col("__n") <= 0, 1).otherwise(0)
    agg = j.groupBy(request).agg(
        F.max(F.when(F.col(page_no) == 1, code)).alias("__code"),
        F.sum(F.when(kept, 1).otherwise(0)).cast("long").alias("n_pages"),
        F.sum(F.when(kept, F.col("__n")).otherwise(0)).cast("long").alias("n_results"))
    outcome = F.when(F.col("__code") == 0, "ok").when(F.col("__code") == 1, "empty").otherwise("failed")
    return agg.select(request, outcome.alias("outcome"), "n_pages", "n_results")


def attach_details(places: DataFrame, details: DataFrame, key: str = "place_id",
                   limit: int = K.REAL_REVIEWS_LIMIT, reviews: str = "reviews", ok: str = "ok",
                   fetched_at: str | None = "fetched_at") -> DataFrame:
    """Place ⋈ its detail; failed or missing detail drops the place; first ``limit`` reviews.

    Failed details go and arrays are cut before anything is shuffled; then
    duplicates are reduced to one per key (the latest; of equally late ones
    that with the smallest hash of its kept reviews), so the join cannot
    multiply places.  NULL keys never match.  A successful detail without
    reviews keeps the place with an empty array.
    """
    good = details.filter(F.col(key).isNotNull() & F.coalesce(F.col(ok), F.lit(False))).select(
        key, F.slice(F.coalesce(F.col(reviews), F.array()), 1, limit).alias(reviews),
        *([fetched_at] if fetched_at and fetched_at in details.columns else []))
    order = [F.col(fetched_at).desc_nulls_last()] if fetched_at in good.columns else []
    good = dedup_on_key(good, [key], [*order, F.xxhash64(reviews)]).select(key, reviews)
    base = places.drop(reviews) if reviews in places.columns else places
    return base.join(good, key, "inner")


def batch_totals(docs: DataFrame, data: str = "data", reviews: str = "reviews", by: list | None = None,
                 chunk_col: str | None = None) -> DataFrame:
    """Number of parents and total nested children per batch (``by`` columns).

    A parent landed in several documents is counted once, on the one that
    holds its first child (``chunk_col`` 0; landed documents carry
    ``first_review``), while children are summed over all.  Only array sizes
    are read, and both totals are partial aggregates: a hot batch costs one
    partial row per map task.
    """
    by = list(by or [])
    chunk_col = chunk_col or (FIRST_CHILD if FIRST_CHILD in docs.columns else None)
    keep = by + ([chunk_col] if chunk_col else [])
    h = docs.select(*keep, F.explode(data).alias("h"))
    parents = F.count(F.lit(1)) if not chunk_col else \
        F.coalesce(F.sum(F.when(F.coalesce(F.col(chunk_col), F.lit(0)) == 0, 1).otherwise(0)), F.lit(0))
    aggs = [parents.cast("long").alias("total_hospitals"),
            F.coalesce(F.sum(F.coalesce(F.size(f"h.{reviews}"), F.lit(0))), F.lit(0)).cast("long")
            .alias("total_reviews")]
    return h.groupBy(*by).agg(*aggs) if by else h.agg(*aggs)


def child_totals(children: DataFrame, parent: str, by: list) -> DataFrame:
    """G2/G3 over flat children: distinct parents and children per batch, without nesting anything.

    Children are counted per (batch, parent) first, partially before the
    shuffle, then parents per batch: no text moves and no parent is held.
    """
    each = children.groupBy(*by, parent).agg(F.count(F.lit(1)).alias("__n"))
    return each.groupBy(*by).agg(F.count(F.lit(1)).alias("total_hospitals"), F.sum("__n").cast("long").alias("total_reviews"))
