import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierflow.functions import dates, jsondoc, numbers, text

D = dt.date


def each(rows, column, inputs, dtype="string"):
    df = rows(f"i int, x {dtype}", *enumerate(inputs))
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


def test_cohort_code_from_label(rows):
    labels = ["Incubator 7.0", "accelerator 12", "Other 1234", "one two three", None, "", "Stem -7", "x"]
    assert each(rows, text.cohort_code_from_label, labels) == [
        "INC007", "ACC012", "OTH1234", None, None, None, "STE-07", None,
    ]


def test_cohort_and_student_code(rows):
    df = rows("n int, d date, id long", (7, D(2024, 3, 1), 12), (1000, None, 123456789))
    got = df.select(
        text.cohort_code(F.lit("INC"), F.col("n")), text.student_code(F.col("d"), F.lit("INC007"), F.col("id"))
    ).collect()
    assert [tuple(r) for r in got] == [("INC007", "24INC0070000012"), ("INC000", None)]
    longer = rows("d date, id long", (D(2024, 3, 1), 12345678))
    assert longer.select(text.student_code(F.col("d"), F.lit("A"), F.col("id"))).first()[0] == "24A1234567"


@pytest.mark.parametrize("full, first, last", [
    ("A. Bee", "Bee", "A"), ("Asha Rao", "Asha", "Rao"), ("Asha", "Asha", "Asha"),
    ("Asha Rao ", "Asha Rao", ""), ("A.B.C", "B", "A"), ("Asha Devi Rao", "Asha Devi", "Rao"),
])
def test_name_split(rows, full, first, last):
    df = rows("x string", (full,))
    assert tuple(df.select(text.first_name(F.col("x")), text.last_name(F.col("x"))).first()) == (first, last)


def test_trims(rows):
    inputs = [" A\tb ", "\t x \n", " y", None]
    assert each(rows, text.normalised, inputs) == ["a\tb", "\t x \n", " y", None]
    assert each(rows, text.stripped, inputs) == ["A\tb", "x", "y", None]


def test_blank_words(rows):
    inputs = ["", " ", "NaN", " NaN ", None, "2025-01-01"]
    assert each(rows, text.is_filled, inputs) == [False, False, False, False, None, True]
    assert each(rows, text.is_blank, inputs) == [True, True, False, False, True, False]
    assert each(rows, text.null_if_token, inputs) == [None, " ", None, " NaN ", None, "2025-01-01"]


def test_split_list_of_empty_text(rows):
    assert each(rows, text.split_list, ["", "a", "a,b", None, "a,,b"]) == [[], ["a"], ["a", "b"], None, ["a", "", "b"]]


def test_timestamps_from_text(rows):
    inputs = ["", " ", "NaN", None, "2025-01-01T10:00:00.123Z", " 2025-01-01 ", "2025-13-01", "soon"]
    ts = dt.datetime(2025, 1, 1, 10, 0, 0, 123000)
    assert each(rows, dates.timestamp_from_text, inputs) == [
        None, None, None, None, ts, dt.datetime(2025, 1, 1), None, None,
    ]
    assert each(rows, dates.has_fraction, [ts, dt.datetime(2025, 1, 1)], "timestamp_ntz") == [True, False]


def test_day_first_dates(rows):
    inputs = ["25/12/2024", "25-12-2024", "25-12-24", "5.1.2024", "1-1-75", "31/02/2024", "xx", None]
    assert each(rows, dates.date_day_first, inputs) == [
        D(2024, 12, 25), D(2024, 12, 25), D(2024, 12, 25), D(2024, 1, 5), D(1975, 1, 1), None, None, None,
    ]


def test_month_name_dates(rows):
    inputs = ["5-jan-24", "05-JAN-75", "1-Feb-69", "1-Feb-68", "29-Feb-23", "xx", None]
    assert each(rows, dates.date_month_name, inputs) == [
        D(2024, 1, 5), D(1975, 1, 5), D(1969, 2, 1), D(2068, 2, 1), None, None, None,
    ]


def test_academic_year_pivot(rows):
    df = rows("y string, d int", ("2nd Year", 4), ("Year", 3), (None, 3), ("9th", 3), ("3", None), ("99999999999", 2))

    def years(as_of):
        year = numbers.year_of_study(F.col("y"), F.col("d"))
        picked = df.select(dates.start_year(year, as_of), dates.end_year(year, F.col("d"), as_of))
        return [tuple(r) for r in picked.collect()]

    assert years(D(2025, 7, 1)) == [(2024, 2028), (2025, 2028), (2025, 2028), (2023, 2026), (2023, None), (2024, 2026)]
    assert years(D(2025, 6, 30))[0] == (2023, 2027)


def test_active_and_attended(rows):
    df = rows("e date, w timestamp_ntz, c date", (D(2024, 1, 2), None, D(2024, 5, 1)), (None, dt.datetime(2024, 1, 3, 9), None))
    got = df.select(dates.is_active(F.col("e"), D(2024, 1, 2)), dates.attended_on(F.col("w"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [(True, D(2024, 5, 1)), (False, D(2024, 1, 3))]
    assert each(rows, dates.weekday_name, [D(2024, 1, 1)], "date") == ["Monday"]


def test_local_now_does_not_depend_on_session_zone(spark):
    def offset():
        utc = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
        seconds = F.timestamp_diff("SECOND", utc, dates.local_now())
        return spark.range(1).select(seconds).first()[0]

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert offset() == 19800
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_status_marks(rows):
    statuses = ["under review", "reviewed", "rejected", "other", None]
    assert [int(m) for m in each(rows, numbers.marks_for_status, statuses)] == [30, 100, 80, 0, 0]


def test_integers(rows):
    texts = ["12", " 12 ", "12.5", "13.5", "-0.5", "1e3", "x", "", "NaN", None, "99999999999", "2147483647", "."]
    assert each(rows, numbers.int_from_text, texts) == [
        12, 12, 12, 14, 0, 1000, None, None, None, None, None, 2147483647, None,
    ]
    assert each(rows, numbers.int_from_double, [12.5, 13.5, float("nan"), 1e20, None], "double") == [12, 14, None, None, None]
    assert each(rows, numbers.int_from_decimal, [Decimal("12.5"), Decimal("-12.5")], "decimal(5,1)") == [13, -13]


def test_rates(rows):
    df = rows("a long, n long", (0, 0), (1, 0), (0, 1), (2, 3), (1, 8))
    got = df.select(numbers.share_pct(F.col("a"), F.col("n")), numbers.repeat_pct(F.col("n")), numbers.repeat_count(F.col("n")))
    assert [tuple(r) for r in got.collect()] == [
        (None, Decimal("0.00"), 0), (None, Decimal("0.00"), 0), (Decimal("0.00"), Decimal("0.00"), 0),
        (Decimal("66.67"), Decimal("66.67"), 2), (Decimal("12.50"), Decimal("87.50"), 7),
    ]


def test_leader_flag_and_cut(rows):
    assert each(rows, text.leader_flag, ["Student Leader", "x STUDENT LEADERS", "member", None]) == [True, True, False, False]
    assert each(rows, lambda c: text.cut(c, 3), ["abcdef", "ab"]) == ["abc", "ab"]


def test_json_rename(rows):
    docs = ['{"A":1,"c":[1,2]}', '{"A":null}', '{"b":"x"}', '{"A":"y","new":0}', None, "not json", '{"A":{"k":true}}']
    got = each(rows, lambda c: jsondoc.rename_keys(c, {"A": "new", "b": "B"}), docs)
    assert got == ['{"c":[1,2],"new":1}', '{"new":null}', '{"B":"x"}', '{"new":"y"}', None, "not json", '{"new":{"k":true}}']


def test_json_values(rows):
    docs = ['{"y":" Persued ","n":2}', '{"y":null}', '{"n":1}', '{"y":3}', None]
    trimmed = each(rows, lambda c: jsondoc.trim_value(c, "y"), docs)
    assert trimmed == ['{"n":2,"y":"Persued"}', '{"y":null}', '{"n":1}', '{"y":"3"}', None]
    fixed = each(rows, lambda c: jsondoc.replace_value(c, "y", "persued", "Pursued"), trimmed)
    assert fixed == ['{"n":2,"y":"Pursued"}', '{"y":null}', '{"n":1}', '{"y":"3"}', None]
    assert each(rows, lambda c: jsondoc.text_value(c, "y"), docs) == [" Persued ", None, None, "3", None]
    assert each(rows, lambda c: jsondoc.has_key(c, "y"), docs) == [True, True, False, True, False]


def test_json_build_keeps_null(rows):
    df = rows("y string", ("2",), (None,))
    assert [r[0] for r in df.select(jsondoc.build_object(y=F.col("y"))).collect()] == ['{"y":"2"}', '{"y":null}']
