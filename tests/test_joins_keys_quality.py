import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tierflow.operators import aggregate, joins, keys, quality, sizing

D = dt.date


@pytest.mark.parametrize("bucket", [1, 7, 400])
def test_range_join_against_nested_loop(rows, bucket):
    rng = random.Random(3)
    day = lambda: D(2023, 1, 1) + dt.timedelta(rng.randrange(300))
    points = [(i, day()) for i in range(120)] + [(500, None)]
    ranges = [(i, *sorted((day(), day()))) for i in range(25)] + [(90, D(2023, 5, 1), None), (91, D(2023, 6, 1), D(2023, 5, 1))]
    got = joins.range_join(
        rows("p int, d date", *points), rows("r int, a date, b date", *ranges), F.col("d"), F.col("a"), F.col("b"), bucket
    )
    want = sorted((p, r) for p, d in points for r, a, b in ranges if d and a and b and a <= d <= b)
    assert sorted((x["p"], x["r"]) for x in got.collect()) == want
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_range_ends_belong_to_the_range(rows):
    points = rows("d date", (D(2024, 1, 1),), (D(2024, 1, 5),), (D(2024, 1, 6),))
    ranges = rows("a date, b date", (D(2024, 1, 1), D(2024, 1, 5)), (D(2024, 1, 5), D(2024, 1, 5)))
    got = joins.range_join(points, ranges, F.col("d"), F.col("a"), F.col("b"))
    assert values(got, "d") == [(D(2024, 1, 1),), (D(2024, 1, 5),), (D(2024, 1, 5),)]


def test_normalised_join_and_unnest(rows):
    left = rows("a string, t string", (" X ", "p,q"), ("y", ""), (None, None))
    right = rows("b string", ("x",), ("Z",))
    assert values(joins.normalised_join(left, right, [("a", "b")]), "a", "b") == [(" X ", "x")]
    assert joins.normalised_join(left, right, [("a", "b")], "left").count() == 3
    assert values(joins.unnest_text(left, "t", "e"), "e") == [("p",), ("q",)]
    arrays = rows("i int, s array<int>", (1, [1, 2]), (2, []), (3, None))
    assert values(joins.unnest(arrays, "s", "e"), "i", "e") == [(1, 1), (1, 2)]


def test_look_up_one_and_match_split(rows):
    lookup = rows("k int, v string, o int", (1, "b", 1), (1, "a", 2))
    df = rows("k int", (1,), (2,))
    assert values(joins.look_up_one(df, lookup, ("k", "k"), "v", "x"), "k", "x") == [(1, "a"), (2, None)]
    assert values(joins.look_up_one(df, lookup, ("k", "k"), "v", "x", "o"), "k", "x") == [(1, "b"), (2, None)]
    assert values(joins.match_split(rows("k int", (1,), (1,), (2,)), lookup, ["k"])) == [(1, True), (2, False)]


def test_lists(rows):
    df = rows("g int, v string, n int", (1, "b", 2), (1, "a", None), (1, "b", 1), (1, None, 1), (2, None, None))
    got = df.groupBy("g").agg(aggregate.joined_distinct(F.col("v")), aggregate.distinct_array(F.col("n")))
    assert values(got) == [(1, "a, b", [1, 2, None]), (2, None, [None])]


@pytest.mark.parametrize("ids, want", [
    ([5, None, 7, None], [5, 7, 8, 9]), ([None, None], [1, 2]), ([4, 2], [2, 4]), ([-3, None], [-3, -2]),
])
def test_sequential_ids(rows, ids, want):
    df = rows("id int, o int", *[(i, n) for n, i in enumerate(ids)])
    got = keys.assign_sequential_ids(df, "id", ["o"])
    assert sorted(r["id"] for r in got.collect()) == want
    assert [r["id"] for r in got.filter(F.col("id") > max([i for i in ids if i is not None], default=0)).orderBy("o").collect()] == [
        w for w in want if w > max([i for i in ids if i is not None], default=0)
    ]


def test_sequential_ids_over_many_partitions(spark):
    df = spark.range(5000).repartition(13).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).alias("id"), F.xxhash64("id").alias("o"), F.lit("same").alias("hot")
    )
    got = keys.assign_sequential_ids(df, "id", ["hot", "o"])
    new = got.filter("id > 4998").orderBy("o").collect()
    assert [r["id"] for r in new] == list(range(4999, 4999 + len(new))) and got.count() == 5000


def test_quality(rows):
    df = rows("k int, s string, t string", (1, "F", "1.5"), (1, "x", "abc"), (2, None, None), (None, "M", "7"))
    rules = [quality.not_null("k"), quality.in_domain("s", ["F", "M", "O"]), quality.max_length("t", 2), quality.castable("t", "double")]
    assert [r["violations"] for r in quality.rule_counts(df, rules).collect()] == [1, 1, 2, 1]
    good, bad = quality.quarantine(df, rules)
    assert good.count() == 1
    assert [r["reasons"] for r in bad.orderBy("s").collect()] == [["max_length:t"], ["not_null:k"], ["domain:s", "max_length:t", "castable:t"]]
    assert quality.unique_count(df, ["k"]).first()["violations"] == 1
    parent = rows("id int", (2,))
    assert values(quality.orphans(df, "k", parent, "id"), "k", "s") == [(1, "F"), (1, "x")]
    assert quality.orphan_count(df, "k", parent, "id").first()["violations"] == 2
    with pytest.raises(quality.RuleViolation):
        quality.require_clean(quality.rule_counts(df, rules))
    quality.require_clean(quality.rule_counts(good, rules))


def test_broadcast_only_below_the_measured_limit(rows):
    df = rows("k int, s string", (1, "x" * 100), (2, None))
    assert sizing.measured_bytes(df) == 2 * 16 + 2 * 16 + 100
    assert "broadcast" in sizing.broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower()
    assert sizing.broadcast_if_small(df, 100) is df


# --- Intervals, top rows and lists of hot groups -------------------------------------------------


def test_interval_join_equals_brute_force(rows):
    import random

    r = random.Random(6)
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    points = [(i, day(500) if r.random() < 0.4 else day(int(r.expovariate(0.01))) if r.random() < 0.95 else None) for i in range(300)]
    spans = []
    for i in range(120):
        a = int(r.expovariate(0.01))
        spans.append((i, day(a), r.choice([day(a), day(a + 3), day(a + 400), day(a - 2), dt.date(9999, 12, 31), None])))
    spans += [(200, day(500), day(500)), (201, None, day(3))]
    want = sorted((p, s) for p, at in points for s, a, b in spans if at and a and b and a <= at <= b)
    for buckets, hot in ((64, 4), (5, 1), (2, 1)):
        got = joins.interval_join(rows("p int, at date", *points), rows("s int, a date, b date", *spans), "at", "a", "b", buckets, hot)
        assert sorted((x["p"], x["s"]) for x in got.collect()) == want
    for kind, make in (("double", lambda d: float(d.toordinal()) + 0.5), ("long", lambda d: d.toordinal()), ("timestamp_ntz", lambda d: dt.datetime(d.year, d.month, d.day, 1))):
        cast = lambda v: None if v is None else make(min(v, dt.date(3000, 1, 1)))
        got = joins.interval_join(rows(f"p int, at {kind}", *[(p, cast(a)) for p, a in points]), rows(f"s int, a {kind}, b {kind}", *[(s, cast(a), cast(b)) for s, a, b in spans]), "at", "a", "b", 8)
        assert sorted((x["p"], x["s"]) for x in got.collect()) == want
    empty = joins.interval_join(rows("p int, at date", *points), rows("s int, a date, b date"), "at", "a", "b")
    assert empty.count() == 0 and joins.interval_join(rows("p int, at date"), rows("s int, a date, b date", *spans), "at", "a", "b").count() == 0


def test_interval_totals_join_days_not_rows(rows, monkeypatch):
    import random

    r, met = random.Random(8), []
    at = lambda: dt.datetime(2020, 1, r.randint(1, 9), *r.choice([(0, 0, 0), (0, 0, 1), (13, 5, r.randint(0, 59))]))
    points = [(r.choice("ab"), at() if r.random() < 0.9 else None, r.randint(1, 9) if r.random() < 0.9 else None) for _ in range(400)]
    spans = [(r.choice("xy"), dt.datetime(2020, 1, a := r.randint(1, 9)), dt.datetime(2020, 1, a + r.choice([0, 1, 3]))) for _ in range(60)]
    want = {}
    for g, t, v in points:
        for h, a, b in spans:
            if t and a <= t <= b:
                n, total = want.get((h, g), (0, None))
                want[h, g] = (n + 1, total if v is None else (total or 0) + v)
    join = joins.interval_join
    monkeypatch.setattr(joins, "interval_join", lambda p, s, *rest: met.append((p.count(), s.count())) or join(p, s, *rest))
    left, right = rows("g string, t timestamp_ntz, v long", *points), rows("h string, a timestamp_ntz, b timestamp_ntz", *spans)
    for whole in (False, True):
        got = joins.interval_totals(left, right, "t", "a", "b", ["g"], ["h"], {"v": "total"}, whole_days=whole)
        assert {(x["h"], x["g"]): (x["n"], x["total"]) for x in got.collect()} == want
    assert met[1][0] <= 9 * 2 * 2 and met[1][1] <= 9 * 3 * 2


def test_range_join_equals_brute_force_on_any_length(rows):
    day = lambda i: dt.date(1960, 1, 1) + dt.timedelta(days=i)
    points = [(i, day(i * 17 % 9000)) for i in range(200)] + [(999, None)]
    spans = [(i, day(i * 37 % 9000), day(i * 37 % 9000 + 3**(i % 9))) for i in range(60)] + [(90, day(5), day(4)), (91, day(0), dt.date(9999, 12, 31))]
    want = sorted((p, s) for p, at in points for s, a, b in spans if at and a <= at <= b)
    for unit in (1, 7, 32):
        got = joins.range_join(rows("p int, at date", *points), rows("s int, a date, b date", *spans), F.col("at"), F.col("a"), F.col("b"), unit)
        assert sorted((x["p"], x["s"]) for x in got.collect()) == want


def test_top_rows_of_hot_keys(rows):
    from tierflow.operators.dedupe import top_rows

    data = [(i % 2 if i % 50 else None, i * 7 % 101, i) for i in range(400)]
    got = top_rows(rows("k int, v int, i int", *data), ["k"], [F.desc("v"), "i"], 3, parts=8)
    want = [r for k in (0, 1, None) for r in sorted((d for d in data if d[0] == k), key=lambda d: (-d[1], d[2]))[:3]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and got.columns == ["k", "v", "i"]


def test_sorted_lists_of_hot_groups(rows):
    from pyspark.errors import PySparkException

    from tierflow.operators.aggregate import sorted_lists

    data = [("hot", i % 97) for i in range(500)] + [("few", 2), ("few", 10), ("none", None), (None, 1), ("some", None), ("some", 3)]
    df = rows("g string, v int", *data)
    got = {r["g"]: r["vs"] for r in sorted_lists(df, ["g"], "v", "vs").collect()}
    assert got == {"hot": ", ".join(sorted(map(str, range(97)))), "few": "10, 2", "none": None, None: "1", "some": "3"}
    arrays = {r["g"]: r["vs"] for r in sorted_lists(df, ["g"], "v", "vs", separator=None).collect()}
    assert arrays["hot"] == list(range(97)) and arrays["few"] == [2, 10] and not arrays["none"]
    with pytest.raises(PySparkException, match="fits no row"):
        sorted_lists(df, ["g"], "v", "vs", limit=50).collect()
