"""Incremental ingest of landed documents with Structured Streaming.

The batch loaders list the landing folder and load everything each run.
As files keep arriving, the same flows run as a file-source stream: each
micro-batch holds only files not seen before (tracked in the checkpoint),
and ``availableNow`` drains what is there and stops — a restartable batch
job.  Every micro-batch is written to its own ``batch_id=<n>`` folder with
overwrite, so a batch replayed after a lost executor or driver replaces its
own output instead of appending twice.  The checkpoint lies with the output
unless named, so a restarted stream goes on where the last one stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewflow import schemas as S
from reviewflow.operators.clean import split_conformed
from reviewflow.plans import flows as PL
from reviewflow.sinks.keyed import merge_by_key


def landing_stream(spark: SparkSession, path: str, schema: S.T.StructType, multi_line: bool = False,
                   suffix: str = ".json", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(schema)
              .option("multiLine", "true" if multi_line else "false")
              .option("pathGlobFilter", f"*{suffix}")
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)


def _checkpoint_of(out_path: str) -> str:
    """A stream's checkpoint belongs to its output: the same folder on every start, beside the batch folders
    (hidden from readers of the output by its underscore)."""
    return os.path.join(out_path, "_checkpoint")


def _write_split(frame: DataFrame, batch_id: int, out_path: str, rejects_path: str | None) -> None:
    """Good rows and rejects of one micro-batch, each to its own batch folder.

    The batch is persisted for its outputs (the documented way to write a
    micro-batch to several places), so its files are parsed once.  Rows that
    do not fit fail the batch when no rejects path takes them: it is not
    committed, and runs again once there is one.
    """
    frame = frame.persist()
    try:
        good, bad = split_conformed(frame)
        if rejects_path:
            bad.write.mode("overwrite").parquet(os.path.join(rejects_path, f"batch_id={batch_id}"))
        elif n := bad.count():
            raise PL.RejectedRows({"batch": batch_id, "rejected": n})
        good.write.mode("overwrite").parquet(os.path.join(out_path, f"batch_id={batch_id}"))
    finally:
        frame.unpersist()


def _writer(out_path: str, rejects_path: str | None):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _write_split(batch, batch_id, out_path, rejects_path)
    return write_batch


def stream_reviews(spark: SparkSession, landing: str, out_path: str, load_ts=None,
                   checkpoint: str | None = None, rejects_path: str | None = None,
                   multi_line: bool = False, available_now: bool = True) -> StreamingQuery:
    """Flow B as a stream: new review documents → flatten → conform → parquet table."""
    src = landing_stream(spark, landing, PL.REVIEW_READ_SCHEMA, multi_line=multi_line)
    frame = PL.reviews_frame(src, load_ts)
    ckpt = checkpoint or _checkpoint_of(out_path)
    w = frame.writeStream.foreachBatch(_writer(out_path, rejects_path)).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_places(spark: SparkSession, landing: str, out_path: str, load_ts=None,
                  checkpoint: str | None = None, rejects_path: str | None = None,
                  multi_line: bool = False, available_now: bool = True) -> StreamingQuery:
    """Flow A as a stream: new place documents → flatten → required columns → conform → parquet."""
    src = landing_stream(spark, landing, S.PLACES_DOCUMENT, multi_line=multi_line)
    frame = PL.places_frame(src, load_ts)
    ckpt = checkpoint or _checkpoint_of(out_path)
    w = frame.writeStream.foreachBatch(_writer(out_path, rejects_path)).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_labels(spark: SparkSession, reviews_path: str, out_path: str, variant: str = "score",
                  checkpoint: str | None = None, rejects_path: str | None = None,
                  available_now: bool = True, buckets: int | None = None) -> StreamingQuery:
    """Flow C as a stream over the reviews written by ``stream_reviews``.

    Each micro-batch of new review rows is labelled with the batch
    ``label_frame`` (scoring, one row per author id within the batch,
    conformance) and written to its own ``batch_id=`` folder.  With
    ``buckets`` the output is a keyed table instead: every batch is merged
    into it, so an author has one row over all batches (the first by review
    text and then the other columns, as within a batch), and a batch that is
    replayed changes nothing.
    """
    spec = S.MODEL_SENTIMENT if variant == "model" else S.SCORE_SENTIMENT
    schema = spark.read.parquet(reviews_path).schema
    src = spark.readStream.schema(schema).parquet(reviews_path)

    def write_batch(batch, batch_id: int) -> None:
        frame = PL.label_frame(batch, skip_labelled=variant != "model", spec=spec, variant=variant)
        if not buckets:
            return _write_split(frame, batch_id, out_path, rejects_path)
        if rejects_path:
            split_conformed(frame)[1].write.mode("overwrite").parquet(os.path.join(rejects_path, f"batch_id={batch_id}"))
        elif n := split_conformed(frame)[1].count():
            raise PL.RejectedRows({"batch": batch_id, "rejected": n})
        good = split_conformed(frame)[0]
        first = ["review", *[c for c in good.columns if c not in ("review", "author_id", "loaddatetime")], "loaddatetime"]
        merge_by_key(good, out_path, ["author_id"], [F.col(c).asc_nulls_last() for c in first], buckets)

    ckpt = checkpoint or _checkpoint_of(out_path)
    w = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
