import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from tierflow.operators import merge

TARGET = "k string, v int, keep string"


@pytest.fixture
def target(rows):
    return rows(TARGET, ("a", 1, "A"), ("b", 2, "B"), (None, 9, "N"))


@pytest.mark.parametrize("small", [False, True])
def test_upsert(rows, target, small):
    source = rows("k string, v int", ("b", 20), ("c", 30), (None, 40))
    got = merge.upsert(target, source, ["k"], small_source=small)
    assert values(got) == [("a", 1, "A"), ("b", 20, "B"), ("c", 30, None), (None, 40, None), (None, 9, "N")]
    assert got.columns == target.columns


@pytest.mark.parametrize("small", [False, True])
def test_columns_outside_the_update_list_only_fill_new_rows(rows, target, small):
    source = rows(TARGET, ("b", 20, "changed"), ("c", 30, "C"))
    got = merge.upsert(target, source, ["k"], ["v"], small_source=small)
    assert values(got.filter("k is not null")) == [("a", 1, "A"), ("b", 20, "B"), ("c", 30, "C")]


def test_overwrite_with_null(rows, target):
    got = merge.upsert(target, rows("k string, v int", ("b", None)), ["k"])
    assert ("b", None, "B") in values(got)


def test_duplicate_source_key_raises_or_last_wins(rows, target):
    source = rows("k string, v int, seq int", ("c", 30, 1), ("c", 31, 2), ("b", 21, 2), ("b", 20, 1))
    with pytest.raises(Exception, match="merge key occurs twice"):
        merge.upsert(target, source.drop("seq"), ["k"]).collect()
    got = merge.upsert_in_order(target, source, ["k"], ["seq"])
    assert values(got.filter("k is not null")) == [("a", 1, "A"), ("b", 21, "B"), ("c", 31, None)]
    with pytest.raises(ValueError):
        merge.upsert(target, source, ["k"], on_dup="first")


def test_repeated_null_keys_insert_without_error(rows, target):
    source = rows("k string, v int", (None, 1), (None, 1))
    assert merge.upsert(target, source, ["k"]).count() == 5


def test_composite_key_with_null_part(rows):
    target = rows("a int, b int, v int", (1, None, 1), (1, 2, 2))
    source = rows("a int, b int, v int", (1, None, 10), (1, 2, 20))
    assert values(merge.upsert(target, source, ["a", "b"])) == [(1, 2, 20), (1, None, 1), (1, None, 10)]


def test_upsert_is_idempotent_for_complete_keys(rows, target):
    source = rows("k string, v int", ("b", 20), ("c", 30))
    once = merge.upsert(target, source, ["k"])
    assert values(merge.upsert(once, source, ["k"])) == values(once)


def test_unknown_columns_are_refused(rows, target):
    with pytest.raises(ValueError, match="add_column"):
        merge.upsert(target, rows("k string, extra int", ("a", 1)), ["k"])
    with pytest.raises(ValueError):
        merge.upsert(target, rows("k string, v int", ("a", 1)), ["k"], ["missing"])


@pytest.mark.parametrize("small", [False, True])
def test_audit_stamps(rows, small):
    old, now = dt.datetime(2020, 1, 1), dt.datetime(2024, 3, 1, 9, 30)
    target = rows("k string, v int, inserted_at timestamp_ntz", ("a", 1, old), ("b", 2, None), ("d", 4, old))
    source = rows("k string, v int", ("a", 10), ("b", 20), ("c", 30), (None, 5))
    got = merge.upsert(target, source, ["k"], audit=merge.Audit(now=now), small_source=small)
    assert values(got) == [
        ("a", 10, old, now), ("b", 20, None, now), ("c", 30, now, now), ("d", 4, old, None), (None, 5, now, now),
    ]


def test_patch_non_null_last_value_per_column(rows):
    target = rows("id int, x string, y string", (1, "x1", "y1"), (2, "x2", None), (None, "x3", "y3"))
    patch = rows("id int, x string, y string, seq int", (1, "p", None, 1), (1, None, "q", 2), (1, "r", None, 3), (9, "z", "z", 4), (None, "z", "z", 5))
    got = merge.patch_non_null(target, patch, "id", ["x", "y"], ["seq"])
    assert values(got) == [(1, "r", "q"), (2, "x2", None), (None, "x3", "y3")]


def test_fill_null_takes_the_smallest_match(rows):
    target = rows("id int, name string, loc int", (1, " Pune", None), (2, "Agra", 7), (3, "none", None), (4, None, None))
    lookup = rows("n string, l long", ("PUNE ", 5), ("pune", 3), ("agra", 1))
    norm = lambda c: F.lower(F.trim(F.col(c)))
    got = merge.fill_null_from_lookup(target, lookup, [(norm("name"), norm("n"))], "loc", "l")
    assert values(got, "id", "loc") == [(1, 3), (2, 7), (3, None), (4, None)]
    assert got.schema["loc"].dataType == target.schema["loc"].dataType


def test_update_where_sees_old_values(rows):
    df = rows("a int, b int", (1, 2), (3, None))
    got = merge.update_where(df, F.col("b") > 1, {"a": F.col("b"), "b": F.col("a")})
    assert values(got) == [(2, 1), (3, None)]


def test_columns_and_maps(rows):
    df = merge.add_column(rows("id int", (1,), (2,), (None,)), "d", "int")
    assert merge.add_column(df, "d", "int") is df
    assert values(merge.fill_from_map(df, "id", "d", {1: "4"})) == [(1, 4), (2, None), (None, None)]
    table = rows("id int, d int", (2, None), (1, 8))
    filled = merge.fill_from_table(df.fillna(5, ["d"]), "id", "d", table)
    assert values(filled) == [(1, 8), (2, None), (None, 5)]


def test_insert_select_casts_and_skips(rows):
    target = rows("id int, v string", (1, "a"))
    new = rows("id string", ("1",), ("2",))
    assert values(merge.insert_select(target, new)) == [(1, "a"), (1, None), (2, None)]
    assert values(merge.insert_select(target, new, skip_known=["id"])) == [(1, "a"), (2, None)]


def test_each_input_is_read_once(spark, tmp_path):
    for name in ("target", "source"):
        spark.range(4).selectExpr("nullif(id, 3) as k", "id as v").write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / n)) for n in ("target", "source"))
    for on_dup in ("last", "raise", "unique"):
        out = merge.upsert(target, source, ["k"], on_dup=on_dup)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") == 2, plan
        assert values(out) == [(0, 0), (1, 1), (2, 2), (None, 3), (None, 3)]


def test_equal_rows_with_a_null_key_all_stay(rows):
    target = rows("k int, v string", (None, "a"), (None, "a"), (1, "x"))
    source = rows("k int, v string", (None, "a"), (None, "a"), (1, "y"), (1, "z"))
    out = merge.upsert(target, source, ["k"], on_dup="last", mark_changes=True)
    assert values(out, "k", "v", "_change") == [(1, "z", "updated"), *[(None, "a", "inserted")] * 2, *[(None, "a", None)] * 2]
