"""Appends made once, landed files loaded once, keyed merges; each with jobs that end half-way."""

import json
import os

import pytest
from pyspark.sql import functions as F

from reviewflow import schemas as S
from reviewflow.plans import flows as PL
from reviewflow.sinks import keyed
from reviewflow.sinks.ledger import BEGUN, DONE, NO_TARGET, Ledger
from reviewflow.sinks.tables import append_catalog_table

SCHEMA = "id long, name string"


@pytest.fixture
def database(spark, tmp_path):
    name = f"ledger_{os.path.basename(str(tmp_path)).replace('-', '_').lower()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def target(spark, database):
    spark.sql(f"CREATE TABLE {database}.t (id BIGINT, name STRING) USING parquet")
    return f"{database}.t"


def held(spark, target):
    spark.catalog.refreshTable(target)
    return sorted(tuple(r) for r in spark.table(target).collect())


class Lost(RuntimeError):
    """The driver is gone."""


def lose(monkeypatch, owner, name):
    def gone(*_a, **_k):
        raise Lost(name)
    monkeypatch.setattr(owner, name, gone)


def test_a_load_is_appended_once_however_often_it_runs(spark, target, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], SCHEMA)
    assert ledger.append_once(rows, target, "one") == {"state": DONE, "rows": 3, "appended": True}
    assert ledger.append_once(rows, target, "one") == {"state": DONE, "rows": 3, "appended": False}
    # equal rows under another name are another load
    assert ledger.append_once(rows, target, "two")["appended"] and len(held(spark, target)) == 6
    assert ledger.append_once(rows.where("false"), target, "empty") == {"state": DONE, "rows": 0, "appended": False}


def test_job_ends_between_append_and_record(spark, target, tmp_path, monkeypatch):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    append_catalog_table(spark.createDataFrame([(9, "old")], SCHEMA), target)
    rows = spark.createDataFrame([(i, str(i)) for i in range(50)], SCHEMA).repartition(3)
    with monkeypatch.context() as m:
        lose(m, spark.catalog.__class__, "refreshTable")            # the first thing after the append
        with pytest.raises(Lost):
            ledger.append_once(rows, target, "one", {"read": 60})
    assert ledger.state("one", target)["state"] == BEGUN and len(held(spark, target)) == 51
    # another load comes in between, with the very same rows
    assert ledger.append_once(rows, target, "two")["appended"] and len(held(spark, target)) == 101
    again = Ledger(spark, f"{tmp_path}/ledger").append_once(rows, target, "one")
    assert again == {"state": DONE, "rows": 50, "appended": False} and len(held(spark, target)) == 101
    assert {r.load_id for r in ledger.runs(target).where("state = 'done'").collect()} == {"one", "two"}


def test_job_ends_before_the_append(spark, target, tmp_path, monkeypatch):
    import reviewflow.sinks.ledger as module

    ledger = Ledger(spark, f"{tmp_path}/ledger")
    with monkeypatch.context() as m:
        lose(m, module, "append_catalog_table")
        with pytest.raises(Lost):
            ledger.append_once(spark.createDataFrame([(1, "a")], SCHEMA), target, "one")
    # the rows of the first run are appended, whatever a later run would make
    other = spark.createDataFrame([(7, "other")], SCHEMA)
    assert ledger.append_once(other, target, "one")["appended"] and held(spark, target) == [(1, "a")]


def test_an_absent_target_is_recorded_and_can_come_later(spark, database, tmp_path):
    ledger, rows = Ledger(spark, f"{tmp_path}/ledger"), spark.createDataFrame([(1, "a")], SCHEMA)
    assert ledger.append_once(rows, f"{database}.late", "one", {"read": 1})["state"] == NO_TARGET
    spark.sql(f"CREATE TABLE {database}.late (id BIGINT, name STRING) USING parquet")
    assert ledger.append_once(rows, f"{database}.late", "one")["appended"]
    assert [r.state for r in ledger.runs().orderBy("at").collect()] == [NO_TARGET, BEGUN, DONE]


def _document(folder, n, reviews=3, text="fine"):
    os.makedirs(folder, exist_ok=True)
    doc = {"data": [{"name": f"H{n}", "formatted_address": "a", "place_id": f"p{n}", "rating": 4.0, "reviews": [
        {"author_name": f"author {n} {i}", "rating": 4, "text": text, "time": 1700000000 + i} for i in range(reviews)]}]}
    with open(os.path.join(folder, f"d{n}.json"), "w") as f:
        f.write(json.dumps(doc) + "\n")


@pytest.fixture
def reviews(spark, database):
    S.create_target_tables(spark, database)
    return f"{database}.{S.HOSPITAL_REVIEWS.name}"


def test_landed_files_are_loaded_once(spark, reviews, tmp_path):
    ledger, land = Ledger(spark, f"{tmp_path}/ledger"), f"{tmp_path}/land"
    _document(land, 1)
    _document(f"{land}/nested", 2)
    load = lambda: PL.load_new_reviews(spark, land, ledger, "2025-01-01 00:00:00", reviews)
    assert load() == {"loads": 1, "files": 2, "rows": 6}
    assert load() == {"loads": 0, "files": 0, "rows": 0}
    _document(land, 3, 5)
    assert load() == {"loads": 1, "files": 1, "rows": 5}
    _document(land, 1, 4, text="written anew")                 # another length: a new file
    assert load()["rows"] == 4 and spark.table(reviews).count() == 15
    counts = [r.counts for r in ledger.runs(reviews).where("state = 'done'").orderBy("at").collect()]
    assert [(c["files"], c["read"], c["rejected"]) for c in counts] == [(2, 6, 0), (1, 5, 0), (1, 4, 0)]


def test_files_are_taken_in_many_tasks(spark, tmp_path):
    """The listing and its anti-join keep their tasks; the ledger's rows come to few files."""
    from pyspark import TaskContext

    ledger = Ledger(spark, f"{tmp_path}/ledger")
    task = F.udf(lambda _: str(TaskContext.get().taskAttemptId()))
    files = spark.range(0, 40, 1, 8).select(task("id").alias("path"), F.col("id").alias("length"), F.current_timestamp().alias("modified"))
    load = ledger.take(files, "t")
    assert len(set(ledger.taken(load))) == 8 and ledger.files("t").count() == 40
    assert ledger.files("t").select(F.col("_metadata.file_path")).distinct().count() < 8
    assert ledger.take(files.where("false"), "t") is None and ledger.take(files.where("length < 0"), "t") is None


@pytest.mark.parametrize("where", ["scan", "append", "record"])
def test_a_lost_load_is_finished_with_just_its_files(spark, reviews, tmp_path, monkeypatch, where):
    """Files that came after the load began are a load of their own; nothing is lost or doubled."""
    import reviewflow.sinks.ledger as module

    ledger, land = Ledger(spark, f"{tmp_path}/ledger"), f"{tmp_path}/land"
    _document(land, 1)
    with monkeypatch.context() as m:
        if where == "scan":
            lose(m, PL, "scan_landing")
        elif where == "append":
            lose(m, module, "append_catalog_table")
        else:
            lose(m, spark.catalog.__class__, "refreshTable")
        with pytest.raises(Lost):
            PL.load_new_reviews(spark, land, ledger, "2025-01-01 00:00:00", reviews)
    _document(land, 2, 2)
    done = PL.load_new_reviews(spark, land, Ledger(spark, f"{tmp_path}/ledger"), "2025-01-01 00:00:00", reviews)
    assert done == {"loads": 2, "files": 2, "rows": 5} and len(held(spark, reviews)) == 5
    assert PL.load_new_reviews(spark, land, ledger, "2025-01-01 00:00:00", reviews)["rows"] == 0


def test_rejects_go_to_the_folder_of_their_load(spark, reviews, tmp_path):
    ledger, land, rejects = Ledger(spark, f"{tmp_path}/ledger"), f"{tmp_path}/land", f"{tmp_path}/rejects"
    _document(land, 1, 2, text="x" * 70_000)
    with pytest.raises(PL.RejectedRows):
        PL.load_new_reviews(spark, land, ledger, "2025-01-01 00:00:00", reviews)
    _document(land, 2, 3)
    for _ in range(2):                      # the second run finds everything done
        PL.load_new_reviews(spark, land, ledger, "2025-01-01 00:00:00", reviews, rejects_path=rejects)
    assert spark.read.parquet(rejects).count() == 2 and spark.table(reviews).count() == 3
    counts = {r.rows: r.counts for r in ledger.runs(reviews).where("state = 'done'").collect()}
    assert counts[0]["rejected review"] == 2 and counts[3]["rejected"] == 0


# -------------------------------------------------------------------- keyed

def merged(spark, path, rows, buckets=4):
    order = [F.col("day").desc(), F.col("name").asc_nulls_last()]
    return keyed.merge_by_key(spark.createDataFrame(rows, "id long, name string, day int"), path, ["id"], order, buckets)


def table(spark, path):
    schema = spark.createDataFrame([], "id long, name string, day int, key_bucket int").schema
    return sorted(tuple(r) for r in keyed.read_keyed(spark, path, schema).drop("key_bucket").collect())


def test_one_row_per_key_over_arrivals_in_any_order(spark, tmp_path):
    arrivals = [[(1, "a", 1), (2, "b", 1), (None, "x", 1)], [(1, "c", 3), (1, "b", 3), (3, None, 1)], [(1, "late", 2), (2, "b", 1)]]
    want = [(1, "b", 3), (2, "b", 1), (3, None, 1)]
    for k, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 1, 0, 2, 0)]):
        for a in order:
            merged(spark, f"{tmp_path}/t{k}", arrivals[a])
        assert table(spark, f"{tmp_path}/t{k}") == want
    assert table(spark, f"{tmp_path}/none") == [] and merged(spark, f"{tmp_path}/none", []) == {"buckets": 0}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = f"{tmp_path}/t"
    merged(spark, path, [(i, "a", 1) for i in range(100)], buckets=8)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    assert merged(spark, path, [(5, "b", 2)], buckets=8) == {"buckets": 1}
    after = files()
    assert len(before) == 8 and sum(after.get(f) == t for f, t in before.items()) == 7 and len(table(spark, path)) == 100


def test_a_merge_that_ended_while_replacing_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    import shutil

    path = f"{tmp_path}/t"
    merged(spark, path, [(i, "a", 1) for i in range(40)])
    with monkeypatch.context() as m:
        lose(m, keyed, "_replace")
        with pytest.raises(Lost):
            merged(spark, path, [(i, "b", 2) for i in range(20)])
    # it had deleted a bucket already
    shutil.rmtree(next(os.path.join(path, d) for d in os.listdir(path) if d.startswith("key_bucket=")))
    merged(spark, path, [(100, "c", 1)])
    assert table(spark, path) == [(i, "b" if i < 20 else "a", 2 if i < 20 else 1) for i in range(40)] + [(100, "c", 1)]


def test_labels_of_a_stream_keep_one_row_per_author(spark, tmp_path):
    from reviewflow.streaming.landing_stream import stream_labels, stream_reviews

    land, out, labels = f"{tmp_path}/land", f"{tmp_path}/reviews", f"{tmp_path}/labels"
    for n, text in ((1, "great"), (2, "awful"), (1, "excellent care")):
        _document(f"{land}/{text[:3]}", n, 2, text=text)
        stream_reviews(spark, land, out).awaitTermination()
        stream_labels(spark, out, labels, buckets=4).awaitTermination()
    rows = spark.read.parquet(labels)
    assert sorted(r.review for r in rows.collect()) == ["awful", "awful", "excellent care", "excellent care"]
    assert rows.select("author_id").distinct().count() == 4
