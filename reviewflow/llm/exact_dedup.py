"""Exact dedup against a persistent digest index (operator 4).

The index is a Spark table bucketed and sorted by the SHA-256 digest of the
normalised text, one row for each text ever kept.  An arriving batch is
reduced to one row per digest, anti-joined with the index by sort-merge on
the bucketed digest, and what is new is appended.  The index side is not
shuffled; Spark sorts each of its buckets for the merge, as a bucket has one
sorted file for every batch appended.

Every indexed row carries the name of the batch that appended it.  A batch
that is run again under its name, because its job ended after the append,
takes its own rows as new again: it gives the same rows as before and appends
what is missing.

Cases: a null text counts as empty; among equal texts of one batch the row
with the largest doc_id stays (a null doc_id is the smallest; of rows that
tie, one stays); a text already in the index keeps the indexed row.  Empty
batches append nothing.  Other columns are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm.common import lower_ascii, stage, whole_text
from reviewflow.session import scratch_path

DEFAULT_BUCKETS = 64
# Above the two staged sides of the anti-join, so that it is a sort-merge join whatever their sizes.
MERGE = "merge"


class DigestIndex:
    """A digest table at ``path``: created when absent, else registered again with its buckets."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS, name: str | None = None):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
        spark.sql(f"""CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet
                      CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{path}'""")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def new_of(self, firsts: DataFrame, batch: str | None = None) -> DataFrame:
        """Rows of ``firsts`` (digest, ...) whose digest is not in the index, or there from ``batch`` itself."""
        held = self.table() if batch is None else self.table().where(F.col("batch") != batch)
        return firsts.hint(MERGE).join(held, "digest", "left_anti")

    def holds(self, batch: str) -> bool:
        """Did ``batch`` append before?"""
        return not self.table().where(F.col("batch") == batch).isEmpty()

    def forget(self) -> None:
        """Take the table out of the catalog; its files stay at ``path``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, rows: DataFrame, batch: str) -> None:
        """Append (digest, keep_id) under the batch's name; the digests must be new.

        One write task, and so one sorted file, per bucket; the write is
        committed as a whole, so a batch that fails half-way can run again.
        """
        (rows.select("digest", "keep_id", F.lit(batch).alias("batch")).repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", self.path).saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_id, doc_id, digest), staged: from here on texts are not read again."""
    return stage(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("doc_id"),
                             F.unhex(F.sha2(lower_ascii(whole_text(text_col)).cast("binary"), 256)).alias("digest")),
                 "digests")


def add_batch(rows: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Add staged ``digests`` to the index; the digests that ``batch`` brought to it: (digest, keep_id, keep_row)."""
    # count and maximum are combined before the shuffle, so a text that a third of all rows share is one row per task
    firsts = (rows.groupBy("digest").agg(F.max(F.struct("doc_id", (-F.col("row_id")).alias("r"))).alias("top"))
              .select("digest", F.col("top.doc_id").alias("keep_id"), (-F.col("top.r")).alias("keep_row")))
    again = index.holds(batch)
    new = stage(index.new_of(firsts, batch if again else None), "new-digests")
    index.append(stage(index.new_of(new), "missing-digests") if again else new, batch)
    return new


def dedup(batches: list[DataFrame], index: DigestIndex, names: list[str] | None = None) -> DataFrame:
    """Run staged batches through the index in order; one row for each input row:
    doc_id, keep_id, group_size (over these batches), kept, text_sha256.

    ``names`` make a batch safe to run again; without one, a batch is always a new one.
    """
    appended = None
    tagged = None
    for k, rows in enumerate(batches):
        new = add_batch(rows, index, names[k] if names else uuid.uuid4().hex).withColumn("batch", F.lit(k))
        part = rows.withColumn("batch", F.lit(k))
        appended = new if appended is None else appended.union(new)
        tagged = part if tagged is None else tagged.union(part)
    sizes = tagged.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    # a text that was in the index before these batches has no row in appended: its keep_id comes from the index
    groups = stage(sizes.join(index.table().drop("batch"), "digest").join(
        appended.select("digest", "keep_row", F.col("batch").alias("keep_batch")), "digest", "left"), "digest-groups")
    return tagged.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce((F.col("batch") == F.col("keep_batch")) & (F.col("row_id") == F.col("keep_row")), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def dedup_documents(docs: DataFrame, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Whole table through a fresh index as two arrivals, the upper half of the ids first.

    An indexed row stays when an equal text arrives later, so with this order
    the row with the largest doc_id of all stays.
    """
    spark = docs.sparkSession
    span = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    middle = ((span["lo"] or 0) + (span["hi"] or 0)) // 2
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets)
    upper = F.coalesce(F.col("doc_id") > middle, F.lit(False))
    rows = digests(docs)
    found = dedup([rows.where(upper), rows.where(~upper)], index, ["upper", "lower"])
    index.forget()                  # the result reads staged tables only
    return found
