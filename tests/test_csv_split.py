"""CSV files with line breaks in cells, cut into small blocks, against Python's reader."""

import csv
import io
import random

import pytest
from pyspark.errors import PySparkException

from tierflow.sources import csv_files, csv_split


@pytest.fixture
def small_blocks(spark):
    option = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(option)
    yield lambda size: spark.conf.set(option, str(size))
    spark.conf.set(option, before)


def written(path, data, end="\n", sep=","):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, delimiter=sep).writerows(data)
    path.write_bytes(out.getvalue().encode("latin-1"))


def cells(r, n):
    some = ["plain", "", "a\nb", 'say "hi"', '"', '""\n"', "x,y;z", "\n\n", "é ü", "line\r\nend", "  pad ", "\n"]
    return [[str(i), r.choice(some), r.choice(some), f"end{i}"] for i in range(n)]


@pytest.mark.parametrize("seed,end,size", [(1, "\n", 37), (2, "\r\n", 64), (3, "\n", 500), (4, "\n", 10**6)])
def test_equal_to_a_plain_reader(spark, tmp_path, small_blocks, seed, end, size):
    r, want = random.Random(seed), []
    for n in range(3):
        data = cells(r, r.randrange(1, 60))
        written(tmp_path / f"part {n}.csv", [["id", "a b", "c", "d"], *data], end)
        want += data
    small_blocks(size)
    files = csv_files.list_csv_files(spark, str(tmp_path))
    assert len(files) == 3 and all(f.columns == ["id", "a b", "c", "d"] and f.length > 0 for f in files)
    got = csv_files.read_csv(spark, [f.path for f in files], multi_line="split").drop(csv_files.SEQ).collect()
    assert sorted(tuple(x or "" for x in row) for row in got) == sorted(tuple(row) for row in want)
    if end == "\n":
        whole = csv_files.read_csv(spark, [f.path for f in files], multi_line=True).drop(csv_files.SEQ).collect()
        assert sorted(map(str, whole)) == sorted(map(str, got))


def test_order_within_a_file(spark, tmp_path, small_blocks):
    data = [[str(i), "a\nb" if i % 3 else "c"] for i in range(80)]
    written(tmp_path / "x.csv", [["id", "v"], *data], sep=";")
    small_blocks(50)
    rows = csv_files.read_csv(spark, str(tmp_path / "x.csv"), ";", multi_line="split").orderBy(csv_files.SEQ).collect()
    assert [r["id"] for r in rows] == [d[0] for d in data]


def test_many_tasks_read_one_file(spark, tmp_path, small_blocks):
    written(tmp_path / "x.csv", [["id", "v"], *[[str(i), "a\n" * 5] for i in range(200)]])
    small_blocks(256)
    assert csv_split.records(spark, [str(tmp_path / "x.csv")]).select("block").distinct().count() > 5


def test_header_only_blank_lines_and_a_quote_that_stays_open(spark, tmp_path, small_blocks):
    (tmp_path / "h.csv").write_text("a,b\n")
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "b.csv").write_text('a,b\n\n1,2\n   \n"3","4"')
    assert {f.path.rsplit("/", 1)[-1] for f in csv_files.list_csv_files(spark, str(tmp_path))} == {"h.csv", "b.csv"}
    assert csv_files.read_csv(spark, str(tmp_path / "h.csv"), multi_line="split").count() == 0
    got = csv_files.read_csv(spark, str(tmp_path / "b.csv"), multi_line="split").drop(csv_files.SEQ).collect()
    assert sorted(map(tuple, got)) == [("1", "2"), ("3", "4")]
    (tmp_path / "o.csv").write_text('a,b\n1,2\n"open,4\n' + "5,6\n" * 50)
    small_blocks(40)
    with pytest.raises(PySparkException, match="not closed"):
        csv_split.records(spark, [str(tmp_path / "o.csv")], limit=60).collect()


def test_paths_with_odd_characters(spark, tmp_path):
    for name in ("a%41 b.csv", "a[1]*.csv", "ü.csv"):
        written(tmp_path / name, [["id"], ["1"]])
    files = csv_files.list_csv_files(spark, str(tmp_path))
    assert len(files) == 3
    for f in files:
        assert csv_files.read_csv(spark, f.path).count() == csv_files.read_csv(spark, f.path, multi_line="split").count() == 1
        assert [g.path for g in csv_files.csv_files_at(spark, [(f.path, f.modified)])] == [f.path]


def test_blocks_grow_with_the_files():
    from tierflow.workload.store_queries import SPLIT_BLOCKS, split_block

    assert split_block([10, 20]) == split_block([]) == 64 << 10
    assert all(sum(n) / split_block(n) < SPLIT_BLOCKS + 1 for n in ([360 << 20], [1 << 30] * 3, [5 << 20] * 400))


@pytest.mark.parametrize("end,size", [("\n", 41), ("\r\n", 64), ("\n", 10**6)])
def test_files_of_one_line_records_stay_with_the_line_reader(spark, tmp_path, small_blocks, end, size):
    r = random.Random(size)
    some = ["plain", "", 'say "hi"', '"', "x,y;z", "é ü", "  pad ", "\t"]
    data = [[str(i), r.choice(some), r.choice(some)] for i in range(70)]
    written(tmp_path / "a.csv", [["id", "b", "c"], *data[:40], [], *data[40:]], end)
    small_blocks(size)
    split = csv_files.read_csv(spark, str(tmp_path / "a.csv"), multi_line="split")
    whole = csv_files.read_csv(spark, str(tmp_path / "a.csv"))
    got = [tuple(x)[:3] for x in split.orderBy(csv_files.SEQ).collect()]
    assert got == [tuple(x)[:3] for x in whole.orderBy(csv_files.SEQ).collect()] and len(got) == 70
    assert "MapInArrow" not in split._jdf.queryExecution().toString()


@pytest.mark.parametrize("body,lines", [
    (b'1,"a"\n2,b\n', True), (b"1,a\r\n2,b\r\n", True), (b"1,a\n\n  \n2,b\n", True), (b'1,"a\nb"\n', False), (b'1,"a\rb"\n', False), (b"1,a\n\t\n2,b\n", False),
])
def test_line_records_are_told_by_all_lines(spark, tmp_path, body, lines):
    (tmp_path / "a.csv").write_bytes(b"id,b\n" + body)
    assert csv_split.line_records(spark, [str(tmp_path / "a.csv")]) == lines
