import hashlib
import os
import tempfile

from reviewflow.llm import exact_dedup as op
from reviewflow.session import scratch_path

from .conftest import rows_of


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    out = []
    for i, t in rows:
        same = [j for j, u in rows if lower(u) == lower(t)]
        out.append((i, max(same), len(same), i == max(same), hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_whole_table_against_brute_force(docs):
    rows = [(1, "Aa"), (2, "aA"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 200_000), (8, "X" * 200_000)]
    rows += [(100 + i, "copy") for i in range(50)]
    got = op.dedup_documents(docs(rows, extra=("kept", "digest", "keep_id")), 4).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert rows_of(got) == brute(rows)


def test_repeated_rows_and_null_ids_keep_one(docs):
    got = op.dedup_documents(docs([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b")]), 2).collect()
    assert sorted((r.keep_id or -1, r.group_size) for r in got) == [(-1, 2), (-1, 2), (1, 3), (1, 3), (1, 3)]
    assert sum(r.kept for r in got) == 2 and [r.doc_id for r in got if r.kept and r.keep_id] == [1]


def test_empty_table(docs):
    assert op.dedup_documents(docs([(1, "a")]).where("false"), 2).collect() == []


def test_index_outlives_its_registration_and_takes_batches(spark, docs):
    path = scratch_path(spark, "index")
    first = op.DigestIndex(spark, path, 3)
    op.dedup([op.digests(docs([(1, "a"), (2, "b"), (3, "a")]))], first).collect()
    spark.sql(f"DROP TABLE {first.name}")
    again = op.DigestIndex(spark, path, 3)
    assert again.table().count() == 2
    got = op.dedup([op.digests(docs([(9, "A"), (8, "c"), (7, "c")]))], again).select("doc_id", "keep_id", "kept", "group_size")
    assert rows_of(got) == [(7, 8, False, 2), (8, 8, True, 2), (9, 3, False, 1)]
    assert again.table().count() == 3
    # a batch that runs twice adds nothing
    op.dedup([op.digests(docs([(8, "c")]))], again).collect()
    assert again.table().count() == 3


def test_anti_join_is_sort_merge_without_shuffle_of_the_index(spark, docs):
    index = op.DigestIndex(spark, scratch_path(spark, "index"), 3)
    op.add_batch(op.digests(docs([(1, "a"), (2, "b")])), index, "first")
    new = op.digests(docs([(3, "c")])).select("digest").repartition(3, "digest")
    plan = index.new_of(new)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in plan


def test_a_batch_whose_job_ended_after_its_append_gives_the_same_rows(spark, docs):
    index = op.DigestIndex(spark, scratch_path(spark, "index"), 3)
    op.dedup([op.digests(docs([(1, "a"), (2, "old")]))], index, ["monday"]).collect()
    rows = [(5, "a"), (6, "b"), (7, "B"), (8, "c"), (None, "d")]
    op.add_batch(op.digests(docs(rows)), index, "tuesday")                  # the append is committed, its result never read
    size = index.table().count()
    again = op.dedup([op.digests(docs(rows))], index, ["tuesday"])
    assert {r.doc_id: r.kept for r in again.collect()} == {5: False, 6: False, 7: True, 8: True, None: True}
    assert index.table().count() == size
    # run again with one row more: what is missing is appended
    more = op.dedup([op.digests(docs([*rows, (9, "e")]))], index, ["tuesday"])
    assert {r.doc_id for r in more.collect() if r.kept} == {7, 8, 9, None} and index.table().count() == size + 1
    # the same texts as another batch are there already
    assert not any(r.kept for r in op.dedup([op.digests(docs(rows))], index, ["wednesday"]).collect())


def test_no_index_stays_in_the_catalog(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    assert op.dedup_documents(docs([(1, "a")]), 2).count() == 1
    assert {t.name for t in spark.catalog.listTables()} == before
