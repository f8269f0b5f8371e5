from conftest import values
from pyspark.sql import functions as F

from tierflow.operators import repair


def test_recode_follows_chains_in_order(rows):
    assert repair.resolve_in_order({"a": "b", "b": "c", "x": "a"}) == {"a": "c", "b": "c", "x": "a"}
    df = rows("v string", ("a",), (" b ",), ("x",), (" other ",), (None,))
    got = repair.recode(df, "v", {"a": "b", "b": "c", "x": "a"})
    assert values(got) == [(" other ",), ("a",), ("c",), ("c",), (None,)]


def test_recode_from_table(rows):
    df = rows("id int, v string", (1, " a "), (2, "q"), (3, None))
    mapping = rows("o string, n string", ("a", "A"))
    assert values(repair.recode_from_table(df, "v", mapping, "o", "n")) == [(1, "A"), (2, "q"), (3, None)]


def test_case_update(rows):
    df = rows("d string, s string", ("Agra ", "x"), ("Pune", "y"), (None, "z"))
    got = repair.case_update(df, "s", F.trim("d"), {"Agra": "Uttar Pradesh"})
    assert values(got) == [("Agra ", "Uttar Pradesh"), ("Pune", "y"), (None, "z")]


def test_delete_where_keeps_null_and_loses_nothing(rows):
    df = rows("id int, b boolean", (1, True), (2, False), (3, None))
    split = repair.delete_where(df, F.col("b"))
    assert values(split.kept, "id") == [(2,), (3,)] and values(split.removed, "id") == [(1,)]
    assert values(split.apply(dry_run=True)) == values(df)
    assert values(split.apply(), "id") == [(2,), (3,)]


def test_delete_listed_with_condition(rows):
    df = rows("e string, c int", (" a", 1), ("a", 0), ("b", 1), (None, 1), ("a", None))
    listed = rows("x string", ("a",), ("a",), (None,))
    split = repair.delete_listed(df, "e", listed, "x", F.col("c") == 1, normalise=F.trim)
    assert values(split.removed) == [(" a", 1)]
    assert values(split.kept) == [("a", 0), ("a", None), ("b", 1), (None, 1)]


def test_delete_cascade(rows):
    ids = rows("id int", (1,), (3,))
    tables = {"child": (rows("sid int, v int", (1, 1), (2, 2), (None, 3)), "sid"), "parent": (rows("id int", (1,), (2,)), "id")}
    got = repair.delete_cascade(tables, ids, "id")
    assert list(got) == ["child", "parent"]
    assert values(got["child"].kept) == [(2, 2), (None, 3)] and values(got["child"].removed) == [(1, 1)]
    assert values(got["parent"].kept) == [(2,)]


def test_update_listed(rows):
    target = rows("e string, b string", (" a@x", "old"), ("b@x", "old"), (None, "old"))
    keys = rows("Email string", ("a@x ",), ("a@x",), ("zz\t",), (None,))
    done = repair.update_listed(target, "e", keys, "Email", {"b": F.lit("new")})
    assert values(done.updated) == [(" a@x", "new"), ("b@x", "old"), (None, "old")]
    assert values(done.unmatched) == [("zz",)]


def test_deletes_hold_the_list_not_the_rows(rows, monkeypatch):
    table, ids = rows("id int", *[(i % 7,) for i in range(30)], (None,)), rows("id string", ("1",), ("1",), ("6",), ("x",), (None,))
    for limit, join in ((repair.BROADCAST_BYTES, "BroadcastHashJoin"), (0, "ShuffledHashJoin")):
        monkeypatch.setattr(repair, "BROADCAST_BYTES", limit)
        got = repair.delete_listed(table, "id", ids, "id")
        for part in (got.kept, got.removed):
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert join in plan and "SortMergeJoin" not in plan
        assert values(got.removed, "id") == sorted((i % 7,) for i in range(30) if i % 7 in (1, 6))
        assert got.kept.count() == 31 - got.removed.count()
