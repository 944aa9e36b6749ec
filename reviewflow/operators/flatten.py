"""Flattening landed documents and nesting flat children back.

Explode is a narrow operator: a document is split into rows inside the task
that read it, so flattening never shuffles.  Nesting is the only step here
that groups, and it groups into *bounded* records: children are nested per
(parent, chunk) with at most ``chunk_size`` children in one array, so a
parent holding a third of all rows still spreads over many records and
tasks instead of one unbounded array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.functions import exprs as X

DEFAULT_CHUNK = 1_000


def project(df: DataFrame, mapping: dict) -> DataFrame:
    """Select dotted paths (or columns) under new names, in mapping order."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


# --------------------------------------------------------------- places (A1)

def place_columns() -> dict:
    return {
        "name": "p.name",
        "business_status": "p.business_status",
        "address": "p.formatted_address",
        "latitude": "p.geometry.location.lat",
        "longitude": "p.geometry.location.lng",
        "open_now": "p.opening_hours.open_now",
        "rating": "p.rating",
        "user_ratings_total": "p.user_ratings_total",
        "types": F.concat_ws(",", F.col("p.types")),        # A3: NULL array → '', NULL items skipped
        "place_id": "p.place_id",
    }


def flatten_places(docs: DataFrame, keep: list | None = None) -> DataFrame:
    """A1: one row per place of ``results`` (inner explode: NULL/empty → no rows)."""
    exploded = docs.select(*(keep or []), F.explode("results").alias("p"))
    return exploded.select(*(keep or []), *[(F.col(v) if isinstance(v, str) else v).alias(k)
                                            for k, v in place_columns().items()])


# -------------------------------------------------------------- reviews (A2)

def review_columns(with_extras: bool = False, with_position: bool = False) -> dict:
    cols = {
        "hospital_name": "h.name",
        "address": "h.formatted_address",
        "place_id": "h.place_id",
        "hospital_rating": "h.rating",
        "author_name": "r.author_name",
        "author_id": X.author_id("r.author_name"),
        "author_url": "r.author_url",
        "language": "r.language",
        "original_language": "r.original_language",
        "profile_photo_url": "r.profile_photo_url",
        "review_rating": "r.rating",                           # narrowed by the conformance step, which flags what does not fit
        "relative_time_description": "r.relative_time_description",
        "review": "r.text",                                  # D1: the table column is `review`
        "time": X.epoch_to_timestamp("r.time"),
        "translated": X.bool_to_int("r.translated"),
    }
    if with_extras:                                          # D11: produced upstream, optional here
        cols["review_type"] = "r.review_type"
        cols["date"] = "r.date"
    if with_position:
        cols = {"hospital_pos": "hpos", "review_pos": "rpos", **cols}
    return cols


FIRST_CHILD = "first_review"        # a landed document's field: the position of its first review in the whole hospital


def flatten_reviews(docs: DataFrame, keep: list | None = None, with_extras: bool = False,
                    with_position: bool = False, columns: dict | None = None) -> DataFrame:
    """A2: two-level inner explode data[] → reviews[], keeping hospital columns."""
    keep = keep or []
    # a hospital that is landed in several documents goes on counting where the one before stopped
    first = F.coalesce(F.col(FIRST_CHILD), F.lit(0)) if FIRST_CHILD in docs.columns else F.lit(0)
    hospitals = docs.select(*keep, first.cast("int").alias("__first"), F.posexplode("data").alias("hpos", "h"))
    reviews = hospitals.select(*keep, "hpos", "h", "__first", F.posexplode("h.reviews").alias("__rpos", "r"))
    reviews = reviews.withColumn("rpos", F.col("__first") + F.col("__rpos"))
    cols = columns or review_columns(with_extras, with_position)
    return reviews.select(*keep, *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in cols.items()])


# ------------------------------------------------------------------ nest

def nest_children(df: DataFrame, keys: list, pos: str, fields: list[str], array_name: str = "children",
                  chunk_size: int = DEFAULT_CHUNK, chunk_col: str = "chunk", carry: list | None = None,
                  spread: bool = True) -> DataFrame:
    """Flat children → one row per (parent keys, chunk) holding an ordered array<struct>.

    ``pos`` must be unique within its parent: the child's 0-based position
    (what ``posexplode`` yields or ``top_up_groups`` generates) or any unique
    integer key.  Chunk ``k`` holds positions ``[k*chunk_size,
    (k+1)*chunk_size)``, so every array is bounded whatever the parent's
    size; the grouping shuffles (parent, chunk) keys, which spreads a hot
    parent over many tasks.
    Arrays are sorted by position (``collect_list`` alone has no order).
    ``carry`` names parent attributes that depend on the keys only; they ride
    along as ``any_value`` instead of widening the shuffle key.  ``spread``
    forces the shuffle on (parent, chunk) even when the input is already
    partitioned by the parent; pass False when every parent is known to be
    small (e.g. after a top-n), to reuse that partitioning.
    """
    carry = list(carry or [])
    # Shuffle on (parent, chunk) explicitly: an input already hash-partitioned
    # by the parent alone would otherwise "satisfy" the grouping and keep a
    # hot parent in one task.
    chunked = df.withColumn(chunk_col, F.floor(F.col(pos) / F.lit(chunk_size)).cast("int"))
    if spread:
        chunked = chunked.repartition(*keys, chunk_col)
    grouped = (chunked.groupBy(*keys, chunk_col)
                 .agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("__pos"), *[F.col(f) for f in fields])))
                      .alias("__arr"), *[F.any_value(c).alias(c) for c in carry]))
    return grouped.select(*keys, *carry, chunk_col,
                          F.transform("__arr", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
                          .alias(array_name))


def unnest_children(df: DataFrame, keys: list, array_name: str, chunk_col: str = "chunk",
                    chunk_size: int = DEFAULT_CHUNK, pos: str = "pos") -> DataFrame:
    """Inverse of ``nest_children`` for dense 0-based positions: posexplode and restore
    the parent-level position (chunk * chunk_size + index within the chunk)."""
    out = df.select(*keys, chunk_col, F.posexplode(array_name).alias("__i", "__c"))
    return out.select(*keys, (F.col(chunk_col) * F.lit(chunk_size) + F.col("__i")).cast("long").alias(pos), "__c.*")


def explode_children(df: DataFrame, array_name: str, keep: list, pos: str = "pos") -> DataFrame:
    """posexplode an array<struct> column into flat rows with a 0-based position."""
    return df.select(*keep, F.posexplode(array_name).alias(pos, "__c")).select(*keep, pos, "__c.*")


def to_json_text(c, pretty: bool = False, keep_nulls: bool = True) -> Column:
    """struct/array → JSON text; UTF-8 kept; nulls written unless told otherwise."""
    opts = {"ignoreNullFields": "false" if keep_nulls else "true"}
    if pretty:
        opts["pretty"] = "true"
    return F.to_json(F.col(c) if isinstance(c, str) else c, opts)
