import pytest
from conftest import values

from tierflow.operators import dedupe

SCHEMA = "k string, g int, v string, seq long"
DATA = [("a", 1, "x", 1), ("a", 1, "y", 2), ("b", 1, "z", 3), (None, 1, "p", 4), (None, 1, "q", 5), ("a", None, "n", 6)]


def test_keep_last_keeps_every_null_key(rows):
    got = dedupe.dedupe_keep_last(rows(SCHEMA, *DATA), ["k", "g"], ["seq"])
    assert values(got, "v") == [("n",), ("p",), ("q",), ("y",), ("z",)]


def test_keep_first_treats_null_keys_as_equal(rows):
    got = dedupe.dedupe_keep_first(rows(SCHEMA, *DATA), ["k", "g"], ["seq"])
    assert values(got, "v") == [("n",), ("p",), ("x",), ("z",)]


def test_null_keys_both_ways(rows):
    df = rows(SCHEMA, *DATA)
    assert dedupe.dedupe_keep_last(df, ["k"], ["seq"], null_keys="equal").count() == 3
    assert dedupe.dedupe_keep_first(df, ["k"], ["seq"], null_keys="distinct").count() == 4
    with pytest.raises(ValueError):
        dedupe.dedupe_keep_last(df, ["k"], ["seq"], null_keys="other")


def test_identical_null_key_rows_all_stay(rows):
    df = rows(SCHEMA, *[(None, 1, "same", 1)] * 3)
    assert dedupe.dedupe_keep_last(df, ["k"], ["seq"]).count() == 3


def test_hot_key_is_cut_before_the_shuffle(rows):
    plan = dedupe.dedupe_keep_last(rows(SCHEMA, *DATA), ["k"], ["seq"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_report_groups_nulls_and_guard_raises(rows):
    df = rows(SCHEMA, *DATA)
    assert values(dedupe.duplicate_report(df, ["k", "g"])) == [("a", 1, 2), (None, 1, 2)]
    with pytest.raises(dedupe.DuplicateKeys):
        dedupe.require_unique(df, ["k", "g"])
    clean = dedupe.dedupe_keep_last(df, ["k", "g"], ["seq"])
    assert dedupe.require_unique(clean, ["k", "g"]) is clean
    with pytest.raises(dedupe.DuplicateKeys):
        dedupe.require_unique(clean, ["k", "g"], null_keys="equal")


def test_tag_by_max(rows):
    df = rows("id int, email string", (1, "a"), (2, "a"), (3, "a"), (4, "b"), (5, None), (6, None))
    child = rows("student_id int", (1,), (1,), (4,))
    got = dict((r["id"], r["disposition"]) for r in dedupe.tag_by_max(df, "email", "id", child, "student_id").collect())
    assert got == {1: "referenced", 2: "unreferenced", 3: "kept", 4: "kept", 5: "kept", 6: "kept"}
    dropped = dedupe.tag_by_max(df, "email", "id", child, "student_id", null_keys="drop")
    assert values(dropped.filter("email is null"), "disposition") == [("unreferenced",), ("unreferenced",)]


def test_tags_by_max_join_marks_once_without_sorting_rows(rows):
    df = rows("id int, mail string", (1, "a"), (2, "a"), (3, "a"), (3, "a"), (4, None), (None, "b"), (5, "b"), (6, "c"), (7, "c"))
    used = rows("sid long", (2,), (2,), (None,), (7,), (1 << 40,))
    got = dedupe.tag_by_max(df, "mail", "id", used, "sid")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in plan
    assert values(got, "id", "disposition") == sorted([
        (1, "unreferenced"), (2, "referenced"), (3, "kept"), (3, "kept"), (4, "kept"), (5, "kept"), (6, "unreferenced"), (7, "kept"), (None, "unreferenced"),
    ], key=lambda r: [(v is None, str(v)) for v in r])
