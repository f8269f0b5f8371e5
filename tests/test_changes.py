"""Change reports, signed changes of tables, and tables kept up to date by them."""

import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierflow.operators import changes
from tierflow.operators.merge import upsert, upsert_or_delete
from tierflow.operators.repair import delete_where
from tierflow.plans import delta, report, run
from tierflow.sources.tables import SIGN, LayerStore


def test_change_rows_and_counts(rows):
    before = rows("k int, a string, b int", (1, "x", 1), (2, "x", None), (3, None, 3), (None, "n", 0), (5, "same", 5))
    after = rows("k int, a string, b long, c string", (1, "y", 1, None), (2, "x", 2, "new"), (4, "z", 4, None), (None, "m", 0, None), (5, "same", 5, None))
    got = values(changes.change_rows(before, after, ["k"]))
    assert got == sorted([
        (1, "updated", "a", "x", "y"), (2, "updated", "b", None, "2"), (2, "updated", "c", None, "new"), (3, "deleted", None, None, None),
        (4, "inserted", None, None, None), (None, "updated", "a", "n", "m"),
    ], key=lambda r: [(v is None, str(v)) for v in r])
    assert sorted(values(changes.change_counts(before, after, ["k"])), key=str) == sorted([
        ("inserted", None, 1), ("deleted", None, 1), ("updated", None, 3), ("unchanged", None, 1), ("updated", "a", 2), ("updated", "b", 1), ("updated", "c", 1),
    ], key=str)
    assert changes.change_rows(before, before, ["k"]).count() == 0
    with pytest.raises(PySparkException, match="occurs twice"):
        changes.change_rows(before.unionByName(before.limit(1)), after, ["k"]).collect()
    keys_only = rows("k int", (1,), (2,))
    assert values(changes.change_rows(keys_only, rows("k int", (2,), (3,)), ["k"]), "k", "change") == [(1, "deleted"), (3, "inserted")]


def test_upsert_or_delete(rows):
    target = rows("k int, v string", (1, "a"), (2, "b"), (None, "n"))
    source = rows("k int, v string, _gone boolean", (1, None, True), (2, "c", False), (3, "d", False), (None, "m", False), (9, None, True))
    assert values(upsert_or_delete(target, source, ["k"])) == [(2, "c"), (3, "d"), (None, "m"), (None, "n")]


def test_signed_changes_between_versions(spark, rows, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    store.publish("conformed", "t", rows("k int, v string", *[(i, "a") for i in range(20)], (None, "n")), bucket_keys=["k"], buckets=4)
    first = store.version("conformed", "t")
    store.merge("conformed", "t", rows("k int, v string", (3, "b"), (4, "a"), (30, "c"), (None, "n")), ["k"])
    second = store.version("conformed", "t")
    moved = [(3, "a", -1), (3, "b", 1), (30, "c", 1), (None, "n", 1)]
    assert values(store.changes("conformed", "t", first)) == sorted(moved, key=lambda r: [(v is None, str(v)) for v in r])
    lost = store.read("conformed", "t").filter("k < 2")
    store.switch("conformed", "t", store.stage_delete("conformed", "t", store.read("conformed", "t").filter("k >= 2 or k is null"), lost))
    assert values(store.changes("conformed", "t", second)) == [(0, "a", -1), (1, "a", -1)]
    assert values(store.changes("conformed", "t", first).filter(f"{SIGN} < 0"), "k") == [(0,), (1,), (3,)]
    assert store.changes("conformed", "t", store.version("conformed", "t")).count() == 0
    assert store.changes("conformed", "t", 0).agg(F.sum(SIGN)).first()[0] == store.read("conformed", "t").count()
    with pytest.raises(LookupError):
        store.changes("conformed", "t", 77)
    # Unchanged buckets are not read: the plan names the files of touched ones only.
    small = rows("k int, v string", (3, "z"))
    version = store.version("conformed", "t")
    store.merge("conformed", "t", small, ["k"])
    read = store.changes("conformed", "t", version).inputFiles()
    assert read and len({f.rsplit("/", 2)[-2] for f in read if "_bucket=" in f}) >= 1
    assert values(store.changes("conformed", "t", version)) == [(3, "b", -1), (3, "z", 1)]


def test_a_column_that_came_is_null_before(spark, rows, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    store.publish("conformed", "t", rows("k int", (1,)))
    store.publish("conformed", "t", rows("k int, v string", (1, "a"), (2, None)))
    assert values(store.changes("conformed", "t", 1).select("k", "v", F.col(SIGN))) == [(1, "a", 1), (1, None, -1), (2, None, 1)]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_merges_shuffle_each_side_once(rows):
    target = rows("k int, v string, w int", (1, "a", 1), (2, "b", 2), (None, "n", 0), (7, "g", 7))
    source = rows("k int, v string, w int", (2, "c", 1), (2, "d", 0), (3, "e", 5), (None, "m", 1), (None, "m", 1))
    target.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = upsert(target, source, ["k"], on_dup="last")
        assert shuffles(merged) == 2
        assert values(merged) == [(1, "a", 1), (2, "d", 0), (3, "e", 5), (7, "g", 7), (None, "m", 1), (None, "m", 1), (None, "n", 0)]
        marked = source.selectExpr("*", "false as _gone").unionByName(
            rows("k int, v string, w int, _gone boolean", (7, None, None, True), (9, None, None, True), (None, None, None, True))
        )
        after = upsert_or_delete(target, marked, ["k"], apart=True, update_cols=["v", "w"], on_dup="last", mark_changes=True)
        assert shuffles(after) == 2
        assert values(after.drop("_change")) == [r for r in values(merged) if r[0] != 7]
        assert values(after.filter("_change = 'inserted'"), "k") == [(3,), (None,), (None,)]
    finally:
        target.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_filter_of_a_table_is_written_where_it_lies(spark, rows, tmp_path, monkeypatch):
    store = LayerStore(spark, str(tmp_path))
    store.publish("conformed", "t", rows("k int, v int", *[(i, i % 3) for i in range(40)], (None, 0), (None, 1)), bucket_keys=["k"], buckets=4)
    dealt, hint = [], type(store.read("conformed", "t")).hint
    monkeypatch.setattr(type(store.read("conformed", "t")), "hint", lambda df, name, *a: dealt.append(name) or hint(df, name, *a))
    job = run.Repair("conformed", "t", lambda df: delete_where(df, F.col("v") == 1))
    assert run.run_repair(store, [job], "r", "gone") == {"t": 14}
    assert dealt == []
    left = store.read("conformed", "t")
    assert left.count() == 28 and left.filter("v = 1").isEmpty()
    store.merge("conformed", "t", rows("k int, v int", (0, 9), (1, 9)), ["k"])
    assert store.read("conformed", "t").count() == 29 and values(store.read("conformed", "t").filter("v = 9")) == [(0, 9), (1, 9)]


def test_moved_counts_name_groups_that_are_gone(rows):
    fact = "student_id int, resource_id int, title string, cohort_code string, college_name string, submission_status string, submitted_at int"
    before = rows(fact, (1, 1, "t", "c", None, "under review", 5), (1, 1, "t", "c", None, "under review", 3), (1, 2, None, "c", "x", "reviewed", 1), (2, 1, "t", "c", "x", "under review", 2))
    after = rows(fact, (1, 1, "t", "c", None, "under review", 3), (2, 1, "t", "c", "x", "under review", 2), (2, 1, "t", "c", "x", "under review", 9), (3, 3, "n", "c", "x", "rejected", 4))
    signed = rows(
        fact + ", _sign long", (1, 1, "t", "c", None, "under review", 5, -1), (1, 2, None, "c", "x", "reviewed", 1, -1),
        (2, 1, "t", "c", "x", "under review", 9, 1), (3, 3, "n", "c", "x", "rejected", 4, 1),
    )
    moved = delta.moved_counts(report.submission_counts(before, report.GROUP, with_rows=True), signed)
    assert values(moved.filter("rows <= 0"), "student_id", "resource_id") == [(1, 2)]
    want = report.submission_counts(after, report.GROUP, with_rows=True)
    assert values(delta.adjusted_counts(moved, after), *want.columns) == values(want)


def test_a_marked_key_that_is_upserted_too_stays(rows):
    target = rows("k string, v string, w string", ("a", "old", "x"), ("b", "old", "x"), ("c", "old", "x"))
    marked = rows(
        "k string, v string, w string, _gone boolean",
        ("a", None, None, True), ("a", None, None, False), ("b", None, None, True), ("b", None, None, True), ("d", None, None, True), ("e", "new", "y", False),
        (None, None, None, True), (None, "new", "y", False),
    )
    after = upsert_or_delete(target, marked, ["k"], apart=True, update_cols=["v", "w"], on_dup="last", mark_changes=True)
    assert values(after) == [("a", None, None, "updated"), ("c", "old", "x", None), ("e", "new", "y", "inserted"), (None, "new", "y", "inserted")]
