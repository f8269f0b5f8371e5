import os

import pytest
from conftest import values
from pyspark.sql import functions as F

from tierflow.sources import csv_files, tables


def write(folder, name, content, age=0, encoding="utf-8"):
    path = folder / name
    path.write_bytes(content.encode(encoding))
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))
    return path


def test_separator_guess_ignores_quoted_text():
    assert csv_files.guess_separator('"a,b,c,d";x;y') == ";"
    assert csv_files.guess_separator("a\tb\tc") == "\t"
    assert csv_files.guess_separator("single") == ","


def test_load_csv_folder(spark, tmp_path):
    write(tmp_path, "My Sheet.csv", "﻿ Name ,City\nZoé,\"A, B\"\n", encoding="utf-8")
    write(tmp_path, "other.csv", "k;v\n1;x\n2;\n")
    write(tmp_path, "notes.txt", "no table")
    got = csv_files.load_csv_folder(spark, str(tmp_path), encoding="UTF-8")
    assert sorted(got) == ["my_sheet", "other"]
    assert got["my_sheet"].columns == ["Name", "City"]
    assert values(got["my_sheet"]) == [("Zoé", "A, B")]
    assert values(got["other"]) == [("1", "x"), ("2", None)]


def test_feed_kinds():
    assert csv_files.feed_kind(["user_id", "data_fields", "value", "email", "session_code"]) == "quiz"
    assert csv_files.feed_kind(["EMAIL", "Session_Code"]) == "session"
    assert csv_files.feed_kind(["assignment_id", "submitted_at", "Email"]) == "assignment"
    assert csv_files.feed_kind(["a"]) is None


def test_routing_by_header(spark, tmp_path):
    write(tmp_path, "q1.csv", "user_id,data_fields,value\na@x,Quiz 1,5\n", 1)
    write(tmp_path, "q2.csv", "value,user_id,data_fields\n7,a@x,Quiz 1\n", 2)
    write(tmp_path, "q3.csv", "user_id,data_fields,value\nb@x,Quiz 1,NaN\n", 3)
    write(tmp_path, "s1.csv", "email,session_code\na@x,WS1\n", 4)
    write(tmp_path, "junk.csv", "a,b\n1,2\n", 5)
    write(tmp_path, "empty.csv", "", 6)
    feeds, skipped = csv_files.route_by_header(spark, str(tmp_path))
    assert [(f.kind, len(f.files)) for f in feeds] == [("quiz", 2), ("quiz", 1)]
    assert [values(f.rows, "user_id", "data_fields", "value") for f in feeds] == [
        [("a@x", "Quiz 1", "5"), ("b@x", "Quiz 1", None)], [("a@x", "Quiz 1", "7")],
    ]
    assert sorted(p.rsplit("/", 1)[-1] for p in skipped) == ["junk.csv", "s1.csv"]
    only, _ = csv_files.route_by_header(spark, str(tmp_path), filter_text="q2")
    assert len(only) == 1


def test_sequence_follows_files_and_rows(spark, tmp_path):
    write(tmp_path, "b.csv", "k\n" + "\n".join(str(i) for i in range(50)) + "\n", 1)
    write(tmp_path, "a.csv", "k\n100\n101\n", 2)
    df = csv_files.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert [r["k"] for r in df.orderBy(csv_files.SEQ).collect()] == [*map(str, range(50)), "100", "101"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path, "f.csv", 'k,v\n1,"two\nlines, ""quoted"""\n2,x\n')
    assert values(csv_files.read_csv(spark, str(path)), "k", "v") == [("1", 'two\nlines, "quoted"'), ("2", "x")]


def test_store_versions(spark, rows, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path))
    with pytest.raises(LookupError):
        store.read("landing", "t")
    with pytest.raises(ValueError):
        store.publish("attic", "t", rows("k int", (1,)))
    assert store.publish("landing", "t", rows("k int, v string", (1, "a"))) == tables.Published(1, 1)
    # A version may be computed from the one it replaces.
    doubled = store.read("landing", "t").unionByName(rows("k int, v string", (2, "b")))
    assert store.publish("landing", "t", doubled, cluster_by=["k"]).rows == 2
    assert store.append("landing", "t", rows("k string", ("3",))) == tables.Published(3, 1)
    assert values(store.read("landing", "t")) == [(1, "a"), (2, "b"), (3, None)]
    assert store.rollback("landing", "t") == 2 and store.read("landing", "t").count() == 2
    assert store.rollback("landing", "t") == 1 and values(store.read("landing", "t", ["v"])) == [("a",)]
    with pytest.raises(LookupError):
        store.rollback("landing", "t")
    assert store.publish("landing", "t", doubled).version == 4


def test_materialise(spark, rows, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path))
    one, two = rows("k int", (1,)), rows("k int", (2,))
    assert store.materialise("enriched", "t", one).rows == 1
    assert store.materialise("enriched", "t", two) is None and values(store.read("enriched", "t")) == [(1,)]
    assert store.materialise("enriched", "t", two, "replace").version == 2
    with pytest.raises(ValueError):
        store.materialise("enriched", "t", one, "error")


def test_audit_rows_replace_their_own_run(spark, rows, tmp_path):
    for data in ([(1,), (2,)], [(3,)]):
        path = tables.write_audit(rows("k int", *data), str(tmp_path), "run1", "removed")
    tables.write_audit(rows("k int", (9,)), str(tmp_path), "run2", "removed")
    assert values(spark.read.parquet(path), "k", "run_id") == [(3, "run1"), (9, "run2")]
    path = tables.write_audit(rows("k int", (9,)), str(tmp_path), "r", "as_csv", "csv")
    assert spark.read.option("header", True).csv(path).columns == ["k", "run_id"]


def test_plain_append(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert tables.append(rows("k int", (1,), (2,)), path) == 2 and tables.append(rows("k int", (3,)), path) == 1
    assert spark.read.parquet(path).count() == 3


def test_null_tokens_on_named_columns(rows):
    df = rows("a string, b string, n int", ("NaN", "nan", 1), ("", "x", 2))
    assert values(csv_files.null_tokens(df, ["a"]), "a", "b") == [(None, "nan"), (None, "x")]
    assert values(csv_files.null_tokens(df).filter(F.col("b").isNull()), "n") == [(1,)]


def test_merge_rewrites_only_touched_buckets(spark, rows, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path))
    schema, keys = "s int, r int, v string", ["s", "r"]
    store.publish("conformed", "t", rows(schema, (1, 1, "a"), (2, 1, "b"), (1, 2, "c"), (1, 3, "d"), (5, None, "n")), bucket_keys=keys, buckets=8)
    done = store.merge("conformed", "t", rows(schema, (1, 1, "A"), (9, 2, "new"), (6, None, "m")), keys)
    want = [(1, 1, "A"), (1, 2, "c"), (1, 3, "d"), (2, 1, "b"), (9, 2, "new"), (5, None, "n"), (6, None, "m")]
    got = store.read("conformed", "t")
    assert sorted(map(str, values(got, "s", "r", "v"))) == sorted(map(str, want))
    assert done == tables.Published(2, 3, inserted=2, updated=1)  # affected rows, not rows written
    first, second = store._latest("conformed", "t")["folders"]
    assert 1 <= len(first["replaced"]) <= 2 and second["replaced"] == []
    store.append("conformed", "t", rows(schema, (7, 1, "plus")))
    assert store.read("conformed", "t").count() == 8
    assert store.rollback("conformed", "t") == 2
    assert sorted(map(str, values(store.read("conformed", "t"), "s", "r", "v"))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan
    # A table with another layout is rewritten once, and one with many folders is folded.
    store.publish("conformed", "u", rows(schema, (1, 1, "a"), (1, 2, "b")))
    for n in range(tables.MAX_FOLDERS + 1):
        assert store.merge("conformed", "u", rows(schema, (1, 2, str(n))), keys).updated == 1
        assert len(store._latest("conformed", "u")["folders"]) <= tables.MAX_FOLDERS
    assert values(store.read("conformed", "u"), "r", "v") == [(1, "a"), (2, str(tables.MAX_FOLDERS))]


def test_failed_publish_leaves_nothing_behind(spark, rows, tmp_path, monkeypatch):
    store = tables.LayerStore(spark, str(tmp_path))
    log = tables.LayerStore._log

    def fail(*_):
        raise OSError("log")

    for publish in (store.publish, lambda *a: store.publish(*a, bucket_keys=["k"], buckets=4)):
        monkeypatch.setattr(tables.LayerStore, "_log", fail)
        with pytest.raises(OSError):
            publish("landing", "t", rows("k int", (1,), (2,)))
        monkeypatch.setattr(tables.LayerStore, "_log", log)
        assert publish("landing", "t", rows("k int", (2,))).rows == 1
        assert values(store.read("landing", "t")) == [(2,)]


def test_file_names_and_quoted_headers(spark, tmp_path):
    write(tmp_path, "feed [1].csv", '"k, long",v\n1,x\n', 1)
    (f,) = csv_files.list_csv_files(spark, str(tmp_path))
    assert f.columns == ["k, long", "v"]
    assert values(csv_files.read_csv(spark, f.path).drop("_seq")) == [("1", "x")]


def test_landing_again_changes_nothing(spark, tmp_path):
    from tierflow.plans.landing import run_landing

    inbox = tmp_path / "in"
    inbox.mkdir()
    write(inbox, "a.csv", "user_id,data_fields,value\nu,f,1\n,f,2\nNaN,f,3\n", 1)
    write(inbox, "b.csv", "value,user_id,data_fields\n7,u,f\n8,w,f\n", 2)
    write(inbox, "c.csv", "user_id,data_fields,value\nw,f,9\n", 3)
    store = tables.LayerStore(spark, str(tmp_path / "store"))
    for _ in range(3):
        done = run_landing(spark, str(inbox), store)
        got = values(store.read("landing", "incubator_quiz_monitoring"), "user_id", "value")
        assert got == [("NaN", "3"), ("u", "7"), ("w", "9")]
    assert done.published["incubator_quiz_monitoring"].inserted == 0


def test_columns_a_file_lacks_stay(spark, tmp_path):
    from tierflow.plans.landing import run_landing

    inbox = tmp_path / "in"
    inbox.mkdir()
    write(inbox, "a.csv", "assignment_id,submitted_at,Email,x,y\n1,t,e,x1,y1\n", 1)
    write(inbox, "b.csv", "assignment_id,submitted_at,Email,x\n1,t,e,x2\n2,t,e,z\n", 2)
    store = tables.LayerStore(spark, str(tmp_path / "store"))
    run_landing(spark, str(inbox), store)
    run_landing(spark, str(inbox), store, filter_text="b")
    assert values(store.read("landing", "assignment_monitoring_data"), "assignment_id", "x", "y") == [("1", "x2", "y1"), ("2", "z", None)]


def test_publish_of_no_rows(spark, rows, tmp_path):
    store = tables.LayerStore(spark, str(tmp_path))
    assert store.publish("landing", "t", rows("k int")).rows == 0
    assert store.read("landing", "t").count() == 0


def test_feeds_of_many_headers_are_combined_by_plain_aggregates(spark):
    from tierflow.plans.landing import combined_feed
    from tierflow.sources.csv_files import SEQ, Feed

    # Seventy assignment feeds: each brings a column of its own, and its place in the order.
    feeds = []
    for n in range(70):
        df = spark.createDataFrame([("s1", "a1", "d1", f"v{n}", f"w{n}")], f"Email string, assignment_id string, submitted_at string, own{n % 35} string, all string")
        feeds.append(Feed("assignment", df.selectExpr("*", f"struct({n} as row) as {SEQ}"), ()))
    rows = combined_feed(feeds)
    assert "collect_set" not in rows._jdf.queryExecution().toString()
    keys = ("Email", "assignment_id", "submitted_at")
    got = rows.collect()
    assert len(got) == 1 and got[0]["all"] == "w69" and [got[0][f"own{i}"] for i in range(35)] == [f"v{i + 35}" for i in range(35)]
    assert sorted(got[0]["_has"]) == sorted(c for c in rows.columns if c not in (*keys, "_has"))
