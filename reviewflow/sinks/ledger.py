"""Ledgers of loads: runs, appends made once, and landed files loaded once.

A ledger is a folder of small Parquet records below one path, shared by all
jobs that load a target.  Nothing in it is ever changed: a load writes what it
is about to do, does it, and writes that it is done.

* ``append_once`` appends the rows of a load to a catalog table exactly once,
  however often the load is run.  The rows are staged first and the intent is
  recorded with their digest (count and exclusive-or of row hashes, the same
  in any order).  Spark commits an append as a whole; a run that finds an
  intent without its end looks for the append among the files that came to
  the table since, by digest, before it appends.
* ``new_files`` gives the landed files that no finished load has read; a load
  that was begun and not finished is given back first, with just its files.
* ``runs`` is the ledger read as a table: what every run did, with its counts.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reviewflow.sinks.tables import append_catalog_table, target_exists

RUNS = "load_id string, target string, state string, rows long, digest long, job string, counts map<string,long>, at timestamp"
FILES = "target string, path string, length long, modified timestamp, load_id string, state string"
BEGUN, DONE, NO_TARGET = "begun", "done", "no target"
# Spark names a file of an append part-<task>-<id of the writing job>...
WRITER = r"part-\d+-([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"


def row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def _digest(columns: list[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(row_hash(columns)), F.lit(0)).alias("digest")]


@dataclass
class Ledger:
    """Records of loads below ``path``."""

    spark: SparkSession
    path: str
    fresh_stage: bool = False           # did the last call of ``staged`` write the stage?

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _read(self, part: str, schema: str) -> DataFrame:
        folder = os.path.join(self.path, part)
        jvm, fs = self._fs()
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(folder)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def _done(self, folder: str) -> bool:
        jvm, fs = self._fs()
        return fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "_SUCCESS")))

    # ------------------------------------------------------------------ runs

    def runs(self, target: str | None = None) -> DataFrame:
        """What runs recorded, one row a record."""
        records = self._read("runs", RUNS)
        return records if target is None else records.where(F.col("target") == target)

    def record(self, load_id: str, target: str, state: str, rows: int = 0, digest: int = 0, job: str | None = None,
               counts: dict | None = None) -> None:
        row = self.spark.range(1).select(
            F.lit(load_id).alias("load_id"), F.lit(target).alias("target"), F.lit(state).alias("state"), F.lit(rows).cast("long").alias("rows"),
            F.lit(digest).cast("long").alias("digest"), F.lit(job).cast("string").alias("job"),
            F.create_map(*[x for k, v in (counts or {}).items() for x in (F.lit(k), F.lit(int(v)).cast("long"))]).cast("map<string,bigint>").alias("counts"),
            F.current_timestamp().alias("at"))
        row.coalesce(1).write.mode("append").parquet(os.path.join(self.path, "runs"))

    def state(self, load_id: str, target: str) -> dict | None:
        """The load's last record: done if it ever was, else begun; None if it is not known."""
        found = self.runs(target).where(F.col("load_id") == load_id).orderBy(F.col("state") != DONE, "at").limit(1).collect()
        return found[0].asDict() if found else None

    # ---------------------------------------------------------- append once

    def staged(self, rows: DataFrame, load_id: str, target: str) -> DataFrame:
        """The load's rows as a table of their own: written by its first run, read by later ones."""
        folder = os.path.join(self.path, "stages", f"{target}-{load_id}")
        self.fresh_stage = not self._done(folder)
        if self.fresh_stage:
            rows.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def appended_since(self, target: str, columns: list[str], since) -> DataFrame:
        """(job, rows, digest) of every append whose files came to the table since a time.

        The bound on the files' times prunes the listing, so older files are not read."""
        new = self.spark.table(target).where(F.col("_metadata.file_modification_time") >= F.lit(since))
        job = F.regexp_extract(F.col("_metadata.file_name"), WRITER, 1)
        return new.select(job.alias("job"), *columns).groupBy("job").agg(*_digest(columns))

    def append_once(self, rows: DataFrame, target: str, load_id: str, counts: dict | None = None, staged: bool = False) -> dict:
        """Append ``rows`` to the catalog table ``target`` unless load ``load_id`` did: {state, rows, appended}.

        ``counts`` (read, rejected, ...) are kept with the record.  Rows are
        those of the load's first run: a run again need not make them anew.
        ``staged``: ``rows`` read a stage of this load already.
        """
        if not target_exists(self.spark, target):
            print(f"target table {target} does not exist; load skipped")
            self.record(load_id, target, NO_TARGET, counts=counts)
            return {"state": NO_TARGET, "rows": 0, "appended": False}
        known = self.state(load_id, target)
        if known and known["state"] == DONE:
            return {"state": DONE, "rows": known["rows"], "appended": False}
        columns = self.spark.table(target).columns
        stage = rows.select(*columns) if staged else self.staged(rows.select(*columns), load_id, target)
        total = stage.agg(*_digest(columns)).first()
        if known is None or known["state"] != BEGUN:
            self.record(load_id, target, BEGUN, total["rows"], total["digest"], counts=counts)
        job = self._find(target, columns, load_id, total) if known and known["state"] == BEGUN else None
        appended = job is None and total["rows"] > 0
        if appended:
            append_catalog_table(stage, target)
            self.spark.catalog.refreshTable(target)
            job = self._find(target, columns, load_id, total)
        self.record(load_id, target, DONE, total["rows"], total["digest"], job, counts)
        return {"state": DONE, "rows": total["rows"], "appended": appended}

    def _find(self, target: str, columns: list[str], load_id: str, total) -> str | None:
        """The append of this load, if it is in the table: same rows, none of another load's, and not before its intent."""
        intent = self.runs(target).where((F.col("load_id") == load_id) & (F.col("state") == BEGUN))
        begun = intent.agg(F.min("_metadata.file_modification_time")).first()[0]        # by the file system's clock, as the table's files
        mine = self.appended_since(target, columns, begun).where((F.col("rows") == total["rows"]) & (F.col("digest") == total["digest"]))
        others = self.runs(target).where((F.col("state") == DONE) & F.col("job").isNotNull()).select("job")
        found = mine.join(others, "job", "left_anti").orderBy("job").limit(1).collect()
        return found[0]["job"] if found else None

    # -------------------------------------------------------- landed files

    def files(self, target: str | None = None) -> DataFrame:
        """Landed files and the loads that took them."""
        known = self._read("files", FILES)
        return known if target is None else known.where(F.col("target") == target)

    def _finished(self, target: str) -> DataFrame:
        return self.runs(target).where(F.col("state") == DONE).select("load_id").distinct()

    def pending(self, target: str) -> list[str]:
        """Loads that took files and did not finish; normally none, at most a few."""
        taken = self.files(target).select("load_id").distinct()
        return sorted(r[0] for r in taken.join(self._finished(target), "load_id", "left_anti").collect())

    def new_files(self, path, target: str, suffix: str = ".json") -> DataFrame:
        """(path, length, modified) of the files below ``path`` that no load of ``target`` took.

        A file that was written anew has another length or time and is new.
        Listing and anti-join run in Spark; contents are not read."""
        paths = [path] if isinstance(path, str) else list(path)
        there = (self.spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", "true").load(paths)
                 .select("path", "length", F.col("modificationTime").alias("modified")))
        return there.join(self.files(target).select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")

    def take(self, files: DataFrame, target: str) -> str | None:
        """Begin a load of ``files``: its id, or None where there are none.

        A REBALANCE gathers the rows into few files; a ``coalesce(1)`` would run the listing and its anti-join in one task."""
        load_id = uuid.uuid4().hex
        seen = Observation()
        taken = files.select(F.lit(target).alias("target"), "path", "length", "modified", F.lit(load_id).alias("load_id"), F.lit(BEGUN).alias("state"))
        taken.hint("rebalance").observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(os.path.join(self.path, "files"))
        return load_id if seen.get["n"] else None

    def taken(self, load_id: str) -> list[str]:
        """Paths of a load's files, for the reader: Spark lists the files of a scan on the driver as well."""
        return [r[0] for r in self.files().where(F.col("load_id") == load_id).select("path").orderBy("path").collect()]
