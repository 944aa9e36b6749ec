"""Landings as of a time: complete ones only, the last not later than the reader's time."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewflow.sinks import landings as op
from reviewflow.sources.landing import NoLandedFiles

SCHEMA = T.StructType([T.StructField("data", T.ArrayType(T.StringType()))])


def docs(spark, *names):
    return spark.createDataFrame([(f"city-{n % 3}", [name]) for n, name in enumerate(names)], "city_slug string, data array<string>")


def names(df):
    return sorted(x for r in df.collect() for x in r.data)


def test_readers_get_the_last_complete_landing_of_their_time(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(NoLandedFiles):
        op.read_as_of(spark, path, SCHEMA)
    op.land(docs(spark, "a", "b"), path, "2024-01-01 00:00:00")
    op.land(docs(spark, "a", "b", "c", "d"), path, datetime(2024, 1, 3))
    op.land(docs(spark, "late"), path, "2024-01-02 00:00:00")        # lands last, counts by its time
    assert names(op.read_as_of(spark, path, SCHEMA, "2024-01-01 23:00:00")) == ["a", "b"]
    assert names(op.read_as_of(spark, path, SCHEMA, datetime(2024, 1, 2, 12))) == ["late"]
    assert names(op.read_as_of(spark, path, SCHEMA)) == ["a", "b", "c", "d"]
    with pytest.raises(NoLandedFiles):
        op.read_as_of(spark, path, SCHEMA, "2023-12-31 00:00:00")
    known = op.landings(spark, path).orderBy("at").collect()
    assert [r.documents for r in known] == [2, 1, 4] and [r.files for r in known] == [2, 1, 3] and all(r.bytes > 0 for r in known)


@pytest.mark.parametrize("lost", ["complete", "_files"])
def test_a_half_written_landing_is_never_read(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path)
    op.land(docs(spark, "old"), path, "2024-01-01 00:00:00")

    def gone(*_a, **_k):
        raise RuntimeError("the driver is gone")
    with monkeypatch.context() as m:
        m.setattr(op, lost, gone)
        with pytest.raises(RuntimeError):
            op.land(docs(spark, "new"), path, "2024-01-02 00:00:00")
    assert names(op.read_as_of(spark, path, SCHEMA)) == ["old"]
    op.land(docs(spark, "new"), path, "2024-01-02 00:00:00")        # run again: its own folder, the torn one stays unread
    assert names(op.read_as_of(spark, path, SCHEMA)) == ["new"] and op.landings(spark, path).count() == 2


def test_a_write_that_fails_on_executors_leaves_the_old_landing(spark, tmp_path):
    path = str(tmp_path)
    op.land(docs(spark, "old"), path, "2024-01-01 00:00:00")
    broken = docs(spark, "x", "y", "z").withColumn("data", F.when(F.col("data")[0] == "z", F.raise_error(F.lit("boom")).cast("array<string>")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="boom"):
        op.land(broken, path, "2024-01-02 00:00:00")
    assert names(op.read_as_of(spark, path, SCHEMA)) == ["old"]


def test_landings_of_one_time_and_empty_ones(spark, tmp_path):
    path = str(tmp_path)
    both = sorted((op.land(docs(spark, x), path, "2024-01-01 00:00:00"), x) for x in "ab")
    assert names(op.read_as_of(spark, path, SCHEMA)) == [both[-1][1]]
    op.land(docs(spark, "c").where("false"), path, "2024-01-02 00:00:00")
    assert op.read_as_of(spark, path, SCHEMA).collect() == []       # nothing was there to land, and that is known


def test_changed_files_are_noticed(spark, tmp_path):
    path = str(tmp_path)
    landing = op.land(docs(spark, "a", "b", "c"), path, "2024-01-01 00:00:00")
    with open(os.path.join(path, landing, "extra.json"), "w") as f:
        f.write('{"data":["x"]}\n')
    with pytest.raises(op.ChangedLanding):
        op.read_as_of(spark, path, SCHEMA)
    assert "x" in names(op.read_as_of(spark, path, SCHEMA, verify=False))


def test_a_listing_of_many_folders_takes_a_bounded_number_of_tasks(spark, tmp_path):
    """Each task's result goes to the driver: a task a city would send it as much beside the files' names."""
    path, sc = str(tmp_path), spark.sparkContext
    many = spark.range(100).select(F.concat(F.lit("city-"), "id").alias("city_slug"), F.array(F.col("id").cast("string")).alias("data"))
    op.land(many, path, "2024-01-01 00:00:00")
    sc.setJobGroup("read-as-of", "")
    try:
        read = op.read_as_of(spark, path, SCHEMA)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("read-as-of") for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
    assert 32 < max(tasks) <= 64 and names(read) == sorted(str(n) for n in range(100))
