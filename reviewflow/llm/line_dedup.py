"""Line dedup by overlapping three-line windows (operator 1).

Every three consecutive lines of a document are hashed; a window that occurs
at more than one place is kept at the first (smallest doc_id, then position)
and its lines are removed everywhere else.  Removed windows overlap, so the
lines they cover are merged per document first.  A line goes only where it is
covered by a window whose first occurrence lies elsewhere or earlier, so
every line's text stays somewhere.

Cases: null text has no lines and stays null; texts of fewer than three lines
have no window; a window of three blank lines counts for nothing; a null
doc_id comes after all others; rows that repeat both id and text are one
occurrence and are treated alike; other columns are passed through unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import stage

WINDOW = 3
# Two hashes from different seeds, 128 bits together: windows are compared by them alone.
SEEDS = (1, 2)


def windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(none, doc_id, body, pos, h1, h2): one row for each window; ``body`` tells apart texts that share an id."""
    def line_hashes(seed):
        return F.transform(F.split("text", "\n"), lambda line: F.xxhash64(F.lit(seed), line))

    hashes = [line_hashes(seed) for seed in SEEDS]
    lines = rows.where(F.col("text").isNotNull()).select(
        "none", "doc_id", "body", *[h.alias(f"l{k}") for k, h in enumerate(hashes)],
        F.transform(F.split("text", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\r\x0b\x0c", "    "))) == 0).alias("blank"))

    def at(i):
        def pair(k):
            return F.xxhash64(F.lit(SEEDS[k]), *[F.get(f"l{k}", i + j) for j in range(window)])
        blank = F.get("blank", i)
        for j in range(1, window):
            blank = blank & F.get("blank", i + j)
        return F.struct(pair(0).alias("h1"), pair(1).alias("h2"), blank.alias("blank"))

    places = F.when(F.size("l0") >= window, F.transform(F.sequence(F.lit(0), F.size("l0") - window), at))
    return (lines.select("none", "doc_id", "body", F.posexplode(places).alias("pos", "w"))
            .where("NOT w.blank").select("none", "doc_id", "body", "pos", "w.h1", "w.h2"))


def repeated_starts(found: DataFrame) -> DataFrame:
    """(none, doc_id, body, starts): where each document has windows to remove; ``found`` is staged."""
    place = F.struct("none", "doc_id", "body", "pos")
    # first and last place are combined before the shuffle: a passage in a third of all documents is one row per task
    firsts = stage(found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .where("first <> last").select("h1", "h2", "first"), "repeated-windows")
    later = found.join(firsts, ["h1", "h2"]).where(place != F.col("first"))
    # distinct: rows that repeat id and text add each place once
    return stage(later.groupBy("none", "doc_id", "body").agg(F.collect_set("pos").alias("starts")), "covered-windows")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                carry: bool = True) -> DataFrame:
    """One row for each input row: doc (its columns but the text, if ``carry``), doc_id, n_lines, n_removed, text.

    The join with what is to go is always by sort and merge: broadcast while
    the repeats are few, the plan and its cost would change with the input.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    own = F.struct(*others) if carry and others else F.lit(None).cast("string")
    rows = docs.select(own.alias("doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # the lines are cut here, before the join: below it each of them would be looked up in a text cut anew
    rows = rows.select("doc", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0).cast(rows.schema["doc_id"].dataType)).alias("doc_id"),
                       F.xxhash64("text", F.length("text")).alias("body"), "text")
    covered = repeated_starts(stage(windows(rows, window), "windows"))
    joined = rows.withColumn("lines", F.split("text", "\n")).drop("text").join(covered.hint("merge"), ["none", "doc_id", "body"], "left")
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (window - 1)))))
    lines = joined.select("doc", F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "lines", gone.alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(kept, lambda i: F.get("lines", i)))
    return lines.select("doc", "doc_id", F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.array_join(left, "\n").alias("text"))


def clean(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars", **options) -> DataFrame:
    """``docs`` with the repeated lines taken out and ``count_col``, if there is one, counted anew; a document of
    which nothing but blank lines is left goes, one that was empty before stays."""
    out = dedup_lines(docs, text_col=text_col, **options)
    left = out.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    def column(c):
        if c == text_col:
            return F.col("text")
        old = F.col(f"doc.`{c}`")
        return F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(old) if c == count_col else old
    return left.select(*[column(c).alias(c) for c in docs.columns])
