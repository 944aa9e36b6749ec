"""Synthetic reviews, padding sparse groups, synthetic hospitals.

The source pipeline drew from an unseeded random generator on the driver.
Here every drawn value is a hash of the row's key and a salt, computed in
Catalyst: the same input always yields the same rows, whichever executor
runs the task and however often it is retried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow import constants as K
from reviewflow.functions import exprs as X

TEMPLATES = {"positive": K.POSITIVE_TEMPLATES, "neutral": K.NEUTRAL_TEMPLATES, "negative": K.NEGATIVE_TEMPLATES}
ADJECTIVES = {"positive": K.ADJECTIVES_POSITIVE, "neutral": K.ADJECTIVES_NEUTRAL, "negative": K.ADJECTIVES_NEGATIVE}


CLASS_ORDER = ("positive", "neutral", "negative")
ALL_TEMPLATES = [t for c in CLASS_ORDER for t in TEMPLATES[c]]
ALL_ADJECTIVES = [w for c in CLASS_ORDER for w in ADJECTIVES[c]]
_PER_CLASS = len(K.POSITIVE_TEMPLATES)
assert all(len(TEMPLATES[c]) == _PER_CLASS and len(ADJECTIVES[c]) == _PER_CLASS for c in CLASS_ORDER)


def _class_offset(cls: Column) -> Column:
    """Start of the rating class's block in the concatenated lists (every class has 20 entries)."""
    return (F.when(cls == "positive", 0).when(cls == "neutral", _PER_CLASS).otherwise(2 * _PER_CLASS))


def text_digest(keys, salt: str = "review") -> Column:
    """Digits 1-4 pick the template, 5-20 the four adjectives."""
    return X.digest(f"{salt}:text", keys)


def review_digest(keys, salt: str = "review") -> Column:
    """Digits 1-12 name the author, 13-20 pick the date, 21-24 the rating, 25-28 the months."""
    return X.digest(salt, keys)


def drawn_rating(digest) -> Column:
    lo, hi = K.SYNTHETIC_REVIEW_RATING
    return F.lit(lo) + X.part(digest, 21, 4, hi - lo + 1)


def review_text(rating, keys, salt: str = "review", digest: Column | None = None) -> Column:
    """template of the rating's class filled with four adjectives of that class.

    The five picks come from separate digits of one digest (``text_digest``),
    each looked up at the class's offset in one concatenated list — one
    lookup per pick, no CASE per class (expressions inside a CASE branch are
    not shared, so nested per-class CASEs would recompute the rating).
    """
    digest = text_digest(keys, salt) if digest is None else digest
    off = _class_offset(X.rating_class(rating))
    template = X.pick_from(ALL_TEMPLATES, off + X.part(digest, 1, 4, _PER_CLASS))
    words = [X.pick_from(ALL_ADJECTIVES, off + X.part(digest, 1 + 4 * i, 4, _PER_CLASS)) for i in range(1, 5)]
    return X.fill_template(template, words)


def _upto(n: int) -> Column:
    """Array 0..n-1; empty for n <= 0 (a sequence from 0 to -1 would run downwards)."""
    return F.sequence(F.lit(0), F.lit(n - 1)) if n > 0 else F.array().cast("array<int>")


def synthetic_review(keys, salt: str = "review", own: Column | None = None, text: Column | None = None) -> Column:
    """One generated review struct, shaped like a landed review (review_type 'fake').

    Fields drawn per key: rating 1-5, months-ago 1-12, a date in
    2020-01-01..2024-12-31 (its epoch is midnight UTC), the text.  Name and
    URLs are placeholders derived from the key.  Two digests carry all picks;
    ``own`` and ``text`` hand them in where they are already columns.
    """
    own = review_digest(keys, salt) if own is None else own
    text = text_digest(keys, salt) if text is None else text
    r = drawn_rating(own)
    day = F.date_add(F.to_date(F.lit(K.SYNTHETIC_DATE_FIRST)), X.part(own, 13, 8, X.date_span()).cast("int"))
    lo, hi = K.SYNTHETIC_MONTHS_AGO
    tag = F.substring(own, 1, 12)
    return F.struct(
        F.concat(F.lit("Reviewer "), tag).alias("author_name"),
        F.concat(F.lit("https://reviews.invalid/a/"), tag).alias("author_url"),
        F.lit(K.SYNTHETIC_LANGUAGE).alias("language"),
        F.lit(K.SYNTHETIC_LANGUAGE).alias("original_language"),
        F.lit(None).cast("string").alias("profile_photo_url"),
        r.cast("long").alias("rating"),
        X.months_ago_text(F.lit(lo) + X.part(own, 25, 4, hi - lo + 1)).alias("relative_time_description"),
        review_text(r, keys, salt, text).alias("text"),
        F.unix_timestamp(day.cast("timestamp")).alias("time"),
        F.lit(False).alias("translated"),
        F.lit(K.FAKE_REVIEW_TYPE).alias("review_type"),
        F.date_format(day, "yyyy-MM-dd").alias("date"),
    )


def top_up_groups(children: DataFrame, parents: DataFrame, key: str, pos: str = "pos",
                  min_count: int = K.MIN_REVIEWS_PER_HOSPITAL, gen=None, salt: str = "topup",
                  parent_cols: list | None = None, fanout_partitions: int | None = None) -> DataFrame:
    """Pad every parent to ``min_count`` children with generated ones.

    Existing children are untouched; parents at or above the minimum are
    unchanged; a second call adds nothing (idempotent).  Counting is a
    partially aggregated group-by (a hot parent costs one partial count per
    map task), and the padding rows are bounded by ``min_count`` per parent.
    Generated children take positions n..min_count-1 after the existing
    0..n-1.  ``gen(key_col, pos_col)`` returns the child struct; by default
    a synthetic review.  ``parent_cols`` (present on ``parents`` and on the
    children) are copied onto the generated rows.
    """
    parent_cols = list(parent_cols or [])
    counts = children.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    need = parents.select(key, *parent_cols).join(counts, key, "left") \
        .withColumn("__n", F.coalesce("__n", F.lit(0)).cast("int")) \
        .filter(F.col("__n") < F.lit(min_count))
    if fanout_partitions:
        need = need.repartition(fanout_partitions, key)
    added = need.select(key, *parent_cols, F.explode(F.sequence(F.col("__n"), F.lit(min_count - 1))).alias(pos))
    gen = gen or (lambda k, p: synthetic_review([k, p], salt))
    child = gen(F.col(key), F.col(pos))
    added = added.select(key, *parent_cols, F.col(pos).cast(children.schema[pos].dataType), child.alias("__g")) \
        .select(key, *parent_cols, pos, "__g.*")
    return children.unionByName(added, allowMissingColumns=True)


def pad_children(df: DataFrame, array_col: str, keys: list, keep: list | None = None,
                 min_count: int = K.MIN_REVIEWS_PER_HOSPITAL, gen=None, salt: str = "topup",
                 pos: str = "pos", fanout_partitions: int | None = None) -> DataFrame:
    """A6 for parents that hold their children as a bounded array: flat, padded rows.

    Each parent yields its existing children at positions 0..n-1 and
    generated ones at n..min_count-1 (``gen(key_cols, pos)``; by default a
    synthetic review keyed by (keys…, position)).  Parents at or above the
    minimum are only flattened; padding again adds nothing.  One generator
    over small (position, existing?, child) slots and one projection — the
    input is read once, with no aggregate and no join.

    ``fanout_partitions``: the padding fans rows out up to ``min_count``-fold,
    but a preceding shuffle was sized (and AQE-coalesced) for the small
    input; a count re-spreads the input by key first (dropped by the
    optimizer when the input is already partitioned that way).
    """
    keep = list(dict.fromkeys([*keys, *(keep or [])]))
    if fanout_partitions:
        df = df.repartition(fanout_partitions, *keys)
    elem = df.schema[array_col].dataType.elementType
    arr = F.coalesce(F.col(array_col), F.array().cast(df.schema[array_col].dataType))
    n = F.size(arr)
    real = F.transform(arr, lambda c, i: F.struct(i.alias("p"), F.lit(True).alias("real"), c.alias("c")))
    extra = F.transform(F.filter(_upto(min_count), lambda p: p >= n),
                        lambda p: F.struct(p.alias("p"), F.lit(False).alias("real"), F.lit(None).cast(elem).alias("c")))
    slots = df.select(*keep, F.explode(F.concat(real, extra)).alias("__s")) \
        .select(*keep, F.col("__s.p").alias(pos), F.col("__s.real").alias("__real"), F.col("__s.c").alias("__c0"))
    key_cols = [F.col(k) for k in keys]
    if gen is None:
        # the digests are made once, outside the CASE below (CASE branches share nothing)
        at = [*key_cols, F.col(pos)]
        slots = slots.withColumns({"__own": review_digest(at, salt), "__text": text_digest(at, salt)})
        made = synthetic_review(at, salt, own=F.col("__own"), text=F.col("__text"))
    else:
        made = gen(key_cols, F.col(pos))
    child = F.when(F.col("__real"), F.col("__c0")).otherwise(made.cast(elem))
    return slots.select(*keep, pos, child.alias("__c")).select(*keep, pos, "__c.*")


def generate_hospitals(cities: DataFrame, city: str = "city", per_city: int = K.SYNTHETIC_HOSPITALS_PER_CITY,
                       reviews_per_hospital: int = K.MIN_REVIEWS_PER_HOSPITAL, salt: str = "hospital") -> DataFrame:
    """``per_city`` synthetic hospitals per city, each with ``reviews_per_hospital`` reviews.

    Flat output, one row per review: city, hospital_no, review_no, the
    hospital fields (name '<city> <type>', one-line address, NULL place_id,
    hospital_rating 1.0-5.0 in tenths, ratings total 50-5000) and the review
    fields.
    Rows come from ``sequence`` explodes on each city row — narrow, so the
    work spreads with the city table's partitions.
    """
    h = cities.select(F.col(city), F.explode(_upto(per_city)).alias("hospital_no"))
    hk = [F.col(city), F.col("hospital_no")]
    h = h.select(
        city, "hospital_no",
        F.concat(F.col(city), F.lit(" "),
                 X.pick_from(K.HOSPITAL_TYPES, X.hash_pick(f"{salt}:type", hk, len(K.HOSPITAL_TYPES))))
        .alias("name"),
        X.newline_to_comma(F.concat(X.hash_int(f"{salt}:street", hk, 1, 9999).cast("string"),
                                    F.lit(" Main Street\n"), F.col(city))).alias("formatted_address"),
        F.lit(None).cast("string").alias("place_id"),
        X.hash_tenths(f"{salt}:rating", hk, *K.SYNTHETIC_HOSPITAL_RATING).alias("hospital_rating"),
        X.hash_int(f"{salt}:total", hk, *K.SYNTHETIC_RATINGS_TOTAL).cast("long").alias("user_ratings_total"),
    )
    r = h.select("*", F.explode(_upto(reviews_per_hospital)).alias("review_no"))
    rk = [F.col(city), F.col("hospital_no"), F.col("review_no")]
    drawn = r.withColumns({"__own": review_digest(rk, f"{salt}:review"), "__text": text_digest(rk, f"{salt}:review")})
    made = synthetic_review(rk, own=F.col("__own"), text=F.col("__text"))
    return drawn.select(*r.columns, made.alias("review")).select(*r.columns, "review.*")
