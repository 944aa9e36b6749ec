"""Scalar column expressions (F-series, A7).

All of them are built from ``pyspark.sql.functions`` so they compile into
whole-stage codegen; none calls back into Python.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewflow import constants as K


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------- identifiers

def author_id(name) -> Column:
    """32-bit Murmur3 hash (seed 42) of the author name, as text; NULL → '42'."""
    return F.hash(_c(name)).cast("string")


def slug(c, lower: bool = True) -> Column:
    """lower-case (optional) and spaces → underscores."""
    x = _c(c)
    return F.replace(F.lower(x) if lower else x, F.lit(" "), F.lit("_"))


def newline_to_comma(c) -> Column:
    """F8: multi-line address → one line joined with ', '."""
    return F.replace(_c(c), F.lit("\n"), F.lit(", "))


# -------------------------------------------------------------- time values

def epoch_to_timestamp(c) -> Column:
    """epoch seconds → timestamp (rendered in the session time zone, UTC)."""
    return F.timestamp_seconds(_c(c))


def bool_to_int(c) -> Column:
    """boolean → 0/1."""
    return _c(c).cast("int")


def epoch_date(c) -> Column:
    """epoch seconds → 'yyyy-MM-dd'; NULL and 0 (falsy) → 'N/A'."""
    t = _c(c)
    return (F.when(t.isNull() | (t == 0), F.lit(K.NO_DATE_TEXT))
            .otherwise(F.date_format(F.timestamp_seconds(t), "yyyy-MM-dd")))


def load_time_text(ts) -> Column:
    """timestamp → 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")


def compact_time_text(ts) -> Column:
    """F16: timestamp → 'yyyyMMdd_HHmmss'."""
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def months_ago_text(n) -> Column:
    """'<n> months ago'."""
    return F.format_string("%d months ago", _c(n))


# ------------------------------------------------------------ text guards

# Characters Python's str.strip() removes: Unicode White_Space plus the four
# ASCII information separators 0x1C-0x1F.
_NON_BLANK = r"[^\x{1C}-\x{1F}\p{IsWhite_Space}]"


def is_blank(c) -> Column:
    """NULL, empty, or whitespace only (Unicode-aware, like str.strip())."""
    x = _c(c)
    return F.coalesce(~x.rlike(_NON_BLANK), F.lit(True))


# ------------------------------------------------------------ labels/classes

def score_label(score, hi: float = K.SCORE_POSITIVE_ABOVE, lo: float = K.SCORE_NEGATIVE_BELOW) -> Column:
    """score → Positive (> hi) / Negative (< lo) / Mixed; strict bounds.

    NaN compares greater than everything in Spark, so it is caught first and
    labelled Mixed, as a float NaN falls through both tests in Python.  NULL
    stays NULL.
    """
    s = _c(score)
    pos, neg, mixed = K.SCORE_LABELS
    return (F.when(s.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(s), F.lit(mixed))
            .when(s > F.lit(hi), F.lit(pos))
            .when(s < F.lit(lo), F.lit(neg))
            .otherwise(F.lit(mixed)))


def rating_class(rating) -> Column:
    """rating >= 4 positive, == 3 neutral, otherwise negative; NULL → NULL."""
    r = _c(rating)
    neg, neu, pos = K.RATING_CLASSES
    return (F.when(r.isNull(), F.lit(None).cast("string"))
            .when(r >= 4, F.lit(pos))
            .when(r == 3, F.lit(neu))
            .otherwise(F.lit(neg)))


def argmax(arr) -> Column:
    """0-based index of the first maximum of an array; NULL/empty → NULL."""
    a = _c(arr)
    return F.when(F.size(a) > 0, F.array_position(a, F.array_max(a)) - 1)


def lookup(mapping: dict, key) -> Column:
    """Id → name through a literal map (a broadcast-free lookup)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), _c(key))


def numbered_label(idx, prefix: str = "LABEL_") -> Column:
    """J3 for generated label names: any index has its name; NULL → NULL."""
    return F.concat(F.lit(prefix), _c(idx).cast("string"))


# ------------------------------------------------------ repeatable "random"

def hash_pick(salt: str, keys, n) -> Column:
    """repeatable pick in [0, n): first 32 bits of md5('salt:k1:k2…') mod n.

    Depends only on the row's key, so retries and repartitioning give the
    same rows (``rand()`` would not).
    """
    parts = [F.lit(salt)] + [_c(k).cast("string") for k in (keys if isinstance(keys, (list, tuple)) else [keys])]
    h = F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, n if isinstance(n, Column) else F.lit(n))


def digest(salt: str, keys) -> Column:
    """32 hex digits of the row's key and a salt: several ``part`` picks from one hash."""
    parts = [F.lit(salt)] + [_c(k).cast("string") for k in (keys if isinstance(keys, (list, tuple)) else [keys])]
    return F.md5(F.concat_ws(":", *parts))


def part(digest_col, start: int, length: int, n) -> Column:
    """pick in [0, n) from ``length`` hex digits of a digest; picks from separate digits are independent."""
    return F.pmod(F.conv(F.substring(_c(digest_col), start, length), 16, 10).cast("bigint"), F.lit(n))


def hash_int(salt: str, keys, lo: int, hi: int) -> Column:
    """repeatable integer in [lo, hi]."""
    return F.lit(lo) + hash_pick(salt, keys, hi - lo + 1)


def hash_tenths(salt: str, keys, lo: float, hi: float) -> Column:
    """repeatable one-decimal real in [lo, hi] (exact tenths)."""
    lo10, hi10 = int(round(lo * 10)), int(round(hi * 10))
    return (F.lit(lo10) + hash_pick(salt, keys, hi10 - lo10 + 1)) / F.lit(10.0)


def hash_date(salt: str, keys, first: str = K.SYNTHETIC_DATE_FIRST, last: str = K.SYNTHETIC_DATE_LAST) -> Column:
    """repeatable date in [first, last]."""
    return F.date_add(F.to_date(F.lit(first)), hash_pick(salt, keys, date_span(first, last)).cast("int"))


def date_span(first: str = K.SYNTHETIC_DATE_FIRST, last: str = K.SYNTHETIC_DATE_LAST) -> int:
    """Days in [first, last]."""
    return (date.fromisoformat(last) - date.fromisoformat(first)).days + 1


def pick_from(values: list, idx) -> Column:
    """Element ``idx`` (0-based) of a literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), _c(idx).cast("int") + 1)


def fill_template(template, words: list) -> Column:
    """substitute {adjective}, {adjective2}, … with the given word columns."""
    out = _c(template)
    for ph, w in zip(K.PLACEHOLDERS, words):
        out = F.replace(out, F.lit(ph), _c(w))
    return out
