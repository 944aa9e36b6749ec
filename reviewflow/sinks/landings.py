"""Landings as of a time.

Every landing is a folder of its own, and a manifest row is written after its
last file: name, time, files, bytes, documents and a digest of the file names
and lengths (exclusive-or of hashes, the same in any order).  A landing
without that row was not finished and is never read; readers choose the last
complete landing not later than a time, and can ask that its files are still
those of the manifest.

The row is one small Parquet file, which appears as a whole when its job
commits.  A landing's time and a name of its own make the folder's name, so
jobs that land at the same time do not meet.  Of landings of one time the one
whose name sorts last counts.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewflow.sinks.envelope import landing_folder, write_envelope
from reviewflow.sinks.tables import observed
from reviewflow.sources.landing import NoLandedFiles, scan_landing

MANIFEST = "landing string, at timestamp, files long, bytes long, documents long, digest long"


class ChangedLanding(RuntimeError):
    pass


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/manifests"


def _files(spark: SparkSession, path: str, landing: str, suffix: str) -> dict:
    """Number, bytes and digest of a landing's files, from a listing alone."""
    there = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true")
             .load(f"{path.rstrip('/')}/{landing}").select("path", "length"))
    name = F.substring_index("path", f"/{landing}/", -1)
    return there.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                     F.coalesce(F.bit_xor(F.xxhash64(name, "length")), F.lit(0)).alias("digest")).first().asDict()


def write_files(docs: DataFrame, path: str, at, suffix: str = ".json", **options) -> dict:
    """The files of a landing, without its manifest row, which is returned.  ``options`` are those of ``write_envelope``."""
    at = datetime.fromisoformat(at) if isinstance(at, str) else at
    landing = f"{landing_folder('', at).lstrip('/')}_{uuid.uuid4().hex[:12]}"
    counted, seen = observed(docs, f"landing-{uuid.uuid4().hex}")
    write_envelope(counted, f"{path.rstrip('/')}/{landing}", mode="errorifexists", **options)
    found = _files(docs.sparkSession, path, landing, suffix)
    # the planner leaves the count out where it knows that there are no rows
    return {"landing": landing, "at": at, "documents": seen.get["rows"] if found["bytes"] else 0, **found}


def complete(spark: SparkSession, path: str, row: dict) -> None:
    """Write the manifest row of a landing whose files are all there."""
    numbers = [F.lit(row[k]).cast("long").alias(k) for k in ("files", "bytes", "documents", "digest")]
    row = spark.range(1).select(F.lit(row["landing"]).alias("landing"), F.lit(row["at"].isoformat(" ")).cast("timestamp").alias("at"), *numbers)
    row.coalesce(1).write.mode("append").parquet(_folder(path))


def land(docs: DataFrame, path: str, at, **options) -> str:
    """One landing below ``path`` as of ``at`` (time or ISO text, in the session's time zone); its name.

    A job lost on the way leaves a folder that nothing reads; run again, it lands under another name.
    """
    row = write_files(docs, path, at, **options)
    complete(docs.sparkSession, path, row)
    return row["landing"]


def landings(spark: SparkSession, path: str) -> DataFrame:
    """The complete landings below ``path``, one row each."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_folder(path))
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(_folder(path))


def landing_as_of(spark: SparkSession, path: str, at=None) -> dict:
    """Manifest of the last complete landing not later than ``at`` (None: the last of all)."""
    known = landings(spark, path)
    if at is not None:
        known = known.where(F.col("at") <= F.lit(at if isinstance(at, str) else at.isoformat(" ")).cast("timestamp"))
    found = known.orderBy(F.col("at").desc(), F.col("landing").desc()).limit(1).collect()
    if not found:
        raise NoLandedFiles(f"no complete landing under {path}" + (f" as of {at}" if at is not None else ""))
    return found[0].asDict()


def read_as_of(spark: SparkSession, path: str, schema: T.StructType, at=None, verify: bool = True, suffix: str = ".json") -> DataFrame:
    """The documents of ``landing_as_of``.  ``verify``: raise where its files are not those of the manifest (a listing, no contents)."""
    chosen = landing_as_of(spark, path, at)
    if not chosen["documents"]:
        return spark.createDataFrame([], schema)
    if verify:
        found = _files(spark, path, chosen["landing"], suffix)
        if any(found[k] != chosen[k] for k in ("files", "bytes", "digest")):
            raise ChangedLanding(f"{chosen['landing']}: {found} instead of {chosen}")
    return scan_landing(spark, f"{path.rstrip('/')}/{chosen['landing']}", schema, suffix=suffix)
