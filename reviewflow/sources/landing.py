"""Landed JSON documents.

The reader is given an explicit schema: no inference pass over the files,
and a narrowed schema prunes nested arrays at the scan.  Pretty-printed
single documents (one per file) need ``multi_line=True`` and cost one task
per file; the documents this library lands itself are JSON Lines, which
Spark splits by byte range like any text file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class NoLandedFiles(FileNotFoundError):
    pass


def _suffixes(suffix) -> tuple:
    return (suffix,) if isinstance(suffix, str) else tuple(suffix)


def _glob(suffix) -> str:
    sfx = _suffixes(suffix)
    return f"*{sfx[0]}" if len(sfx) == 1 else "*{" + ",".join(sfx) + "}"


def has_landed_file(spark: SparkSession, path: str, suffix=".json") -> bool:
    """True as soon as one visible ``*<suffix>`` file exists below ``path``.

    Walks the file system lazily (Hadoop ``listFiles`` iterator) and stops at
    the first match, so the check costs one listing call, not a full listing
    carried through the driver.  Hidden files (``_``/``.`` prefixes, which
    Spark skips) do not count.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if name.endswith(_suffixes(suffix)) and not name.startswith(("_", ".")):
            return True
    return False


def scan_landing(spark: SparkSession, path, schema: T.StructType, multi_line: bool = False,
                 suffix=".json", corrupt_col: str | None = None, with_file: bool = False) -> DataFrame:
    """Every ``*<suffix>`` file below ``path`` (recursively) as one relation.

    Raises ``NoLandedFiles`` when nothing matches: with an explicit schema
    Spark would otherwise return an empty frame silently.  Malformed records
    become NULL rows (PERMISSIVE); pass ``corrupt_col`` to keep their text.
    ``with_file`` adds the source file path (from the hidden ``_metadata``
    column, read at no extra cost).  ``suffix`` may be a tuple, e.g.
    ``(".json", ".json.gz")`` — compressed files are decompressed by Spark
    (one task per compressed file).
    """
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    reader = (spark.read.schema(schema)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", _glob(suffix))
              .option("multiLine", "true" if multi_line else "false")
              .option("mode", "PERMISSIVE"))
    if corrupt_col:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    paths = [path] if isinstance(path, str) else list(path)
    if not any(has_landed_file(spark, p, suffix) for p in paths):
        raise NoLandedFiles(f"no {suffix} files under {paths}")
    df = reader.json(paths)
    if with_file:
        df = df.select("*", F.col("_metadata.file_path").alias("source_file"))
    return df


def landed_file_count(df: DataFrame) -> int:
    """Number of input files of a scan (from the planner's file index; no data read,
    and only the count crosses into Python)."""
    return len(df._jdf.inputFiles())          # a JVM array reference; only its length is fetched


def compact_landing(spark: SparkSession, path, out_path: str, schema: T.StructType, fmt: str = "parquet",
                    multi_line: bool = True, suffix: str = ".json", mode: str = "append") -> int:
    """Rewrite landed documents into a splittable format, once.

    Pretty-printed single documents (the source's landing) can only be read
    one file per task; later loads of the compacted copy (Parquet, or JSON
    Lines with ``fmt="json"``) split by size and read only the columns they
    need.  Returns the number of documents written.
    """
    from reviewflow.sinks.tables import observed

    docs, obs = observed(scan_landing(spark, path, schema, multi_line=multi_line, suffix=suffix, with_file=True))
    docs.write.mode(mode).format(fmt).save(out_path)
    return obs.get["rows"]
