"""Landing to reporting on a small hand-made set, with hand-worked results."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F
from test_sources import write

from tierflow.operators.merge import Audit
from tierflow.plans import conform, enrich, landing, repair, report
from tierflow.sources.schemas import conformed_schema
from tierflow.sources.tables import LayerStore

D, TS = dt.date, dt.datetime


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    return make_world(spark, tmp_path_factory.mktemp("world"))


def make_world(spark, tmp_path):
    """Three CSV feeds and the conformed dimensions."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    write(inbox, "Assignment Monitoring Data.csv", "\n".join([
        "assignment_id,submitted_at,Email,assignment_name,student_name,submission_status,feedback_comments,assignment_file",
        "1,2025-01-01T10:00:00,a@x,Task 1,A,under review,,f1",
        "1,2025-01-02T10:00:00,a@x,Task 1,A,under review,,f2",
        "1,2025-01-03T10:00:00,a@x,Task 1,A,reviewed,well done,f3",
        "1,2025-01-03T10:00:00,a@x,Task 1,A,rejected,\"on second\nthought\",f3",
        "2,NaN,b@x,Task 1,B,under review,,f4",
        "3,2025-01-05T10:00:00,nobody@x,Task 1,N,under review,,f5",
        "4,2025-01-05T10:00:00,b@x,Task 9,B,under review,,f6",
        "5,2025-01-06T10:00:00,b@x,Task 1,B,lost,,f7",
        "6,2025-01-07 10:00:00.5,b@x,Task 1,B,reviewed,,f8",
    ]) + "\n", 1)
    write(inbox, "quiz.csv", "user_id,data_fields,value\na@x,Quiz 1,80\na@x,Quiz 1,85.5\nb@x,Quiz 1,absent\nb@x,Quiz 2,7\n", 2)
    write(inbox, "sessions.csv", "\n".join([
        "Email,Session_Code,Duration_in_hrs,Duration_in_secs,watched_on",
        "a@x,WS01,1,3600,2025-01-10", "a@x,VID01,,90.5,2025-01-11 12:30:00", "b@x,WS01,1,nan,", "b@x,XX01,1,5,2025-01-01",
        "b@x,MC02,1,30,soon",
    ]) + "\n", 3)

    def table(name, *data):
        schema = conformed_schema(name)
        return spark.createDataFrame([tuple(d.get(f, None) for f in schema.names) for d in data], schema)

    tables = {
        "student_details": table("student_details", dict(id=1, email="a@x", caste="General", location_id=1, phone="11"), dict(id=2, email="b@x", location_id=9)),
        "student_cohort": table("student_cohort", dict(student_id=1, cohort_code="INC007"), dict(student_id=2, cohort_code="INC008")),
        "cohort": table("cohort", dict(cohort_code="INC007", cohort_name="Seven", start_date=D(2025, 1, 1), end_date=D(2025, 1, 10)), dict(cohort_code="INC008", cohort_name="Eight", start_date=D(2025, 1, 10), end_date=D(2025, 2, 1))),
        "resource": table("resource", dict(id=10, category="Assignment", title="Task 1"), dict(id=11, category="Quiz", title="Quiz 1"), dict(id=12, category="Pre-recorded Video", title="VID01"), dict(id=13, category="Quiz", title="Task 9")),
        "live_session": table("live_session", dict(id=20, cohort_code="INC007", code="WS01", session_name="Work", conducted_on=TS(2025, 1, 10, 9)), dict(id=21, cohort_code="INC008", code="WS01", session_name="Work 8", conducted_on=TS(2025, 3, 1))),
        "student_registration_details": table("student_registration_details", dict(student_id=1, registration_date=D(2024, 12, 1), form_details='{"y":1}')),
        "student_education": table("student_education", dict(student_id=1, education_course_id=1, subject_id=[1, 2], college_id=1), dict(student_id=1, education_course_id=2, subject_id=[3], college_id=7), dict(student_id=2, education_course_id=1, subject_id=[]), dict(student_id=2, education_course_id=1)),
        "subject_mapping": table("subject_mapping", dict(id=1, education_category="STEM", subject_area="Physics", sub_field="Optics"), dict(id=2, education_category="STEM", subject_area="Maths", sub_field="Optics"), dict(id=3, education_category="Arts")),
        "course_mapping": table("course_mapping", dict(course_id=1, course_name="BSc"), dict(course_id=2, course_name="BA")),
        "college_mapping": table("college_mapping", dict(college_id=1, standard_college_names="City College")),
        "university_mapping": table("university_mapping"),
        "location_mapping": table("location_mapping", dict(location_id=1, state_union_territory="Delhi", district="New Delhi", country="India", city_category="Tier 1")),
        "sheet": spark.createDataFrame([("1", "a@x", "Incubator 7.0", "Seven"), ("2", "b@x", "Incubator 8.0", "Eight")], "Student_id string, Email string, Incubator_Batch string, Incubator_Course_Name string"),
    }
    store = LayerStore(spark, str(tmp_path / "store"))
    run = landing.run_landing(spark, str(inbox), store)
    return dict(tables, store=store, run=run, table=table, inbox=inbox)


def feed(world, name):
    return world["store"].read("landing", name)


def assignments(world):
    return conform.conform_assignments(feed(world, "assignment_monitoring_data"), world["student_details"], world["student_cohort"], world["resource"])


def profile(world):
    subjects = enrich.subject_profile(world["student_education"], world["subject_mapping"], world["course_mapping"], world["college_mapping"], world["university_mapping"])
    return enrich.student_profile(world["student_details"], world["sheet"], world["location_mapping"], world["student_registration_details"], subjects)


def test_landing(world, spark):
    assert {n: p.rows for n, p in world["run"].published.items()} == {
        "assignment_monitoring_data": 8, "incubator_quiz_monitoring": 3, "student_session_information": 5,
    }
    rows = feed(world, "assignment_monitoring_data")
    assert values(rows.filter("assignment_id = '1'"), "submitted_at", "submission_status", "feedback_comments") == [
        ("2025-01-01T10:00:00", "under review", None), ("2025-01-02T10:00:00", "under review", None),
        ("2025-01-03T10:00:00", "rejected", "on second\nthought"),
    ]


def test_later_exports(spark, tmp_path):
    world = make_world(spark, tmp_path)
    # A later export: a changed mark, a new column, and rows with a NULL in the key again.
    write(world["inbox"], "quiz.csv", "user_id,data_fields,value\nb@x,Quiz 1,60\n", 9)
    write(world["inbox"], "more.csv", "assignment_id,submitted_at,Email,grade\n1,2025-01-01T10:00:00,a@x,good\n", 10)
    again = landing.run_landing(spark, str(world["inbox"]), world["store"])
    assert ("b@x", "Quiz 1", "60") in values(feed(world, "incubator_quiz_monitoring"))
    graded = feed(world, "assignment_monitoring_data")
    assert values(graded.filter("grade is not null"), "assignment_id", "submission_status", "grade") == [("1", "under review", "good")]
    done = again.published["assignment_monitoring_data"]
    assert (done.inserted, done.updated) == (0, 8)  # the row without a timestamp meets itself


def test_conform(world):
    assert values(assignments(world), "student_id", "submitted_at", "submission_status", "marks_pct", "cohort_code") == [
        (1, TS(2025, 1, 1, 10), "under review", Decimal(30), "INC007"),
        (1, TS(2025, 1, 2, 10), "under review", Decimal(30), "INC007"),
        (1, TS(2025, 1, 3, 10), "rejected", Decimal(80), "INC007"),
        (2, TS(2025, 1, 7, 10, 0, 0, 500000), "reviewed", Decimal(100), "INC008"),
    ]
    quizzes = conform.conform_quizzes(feed(world, "incubator_quiz_monitoring"), world["student_details"], world["student_cohort"], world["resource"])
    assert values(quizzes, "student_id", "resource_id", "marks", "max_marks") == [(1, 11, 86, 100)]
    sessions = feed(world, "student_session_information")
    live = conform.conform_sessions(sessions, world["student_details"], world["student_cohort"], world["live_session"])
    assert values(live) == [(1, 20, 3600, D(2025, 1, 10)), (2, 21, None, None)]
    watched = conform.conform_pre_recorded(sessions, world["student_details"], world["student_cohort"], world["resource"])
    assert values(watched) == [(1, 12, "INC007", 90, TS(2025, 1, 11))]


def test_rejects_name_every_reason(world):
    bad = conform.rejected_assignments(feed(world, "assignment_monitoring_data"), world["student_details"], world["student_cohort"], world["resource"])
    assert {r["assignment_id"]: r["reasons"] for r in bad.collect()} == {
        "2": ["blank timestamp"], "3": ["unknown e-mail or no cohort"], "4": ["unknown title"], "5": ["unknown status"],
    }
    kept = assignments(world).count()
    assert kept + bad.count() == feed(world, "assignment_monitoring_data").count()


def test_two_cohorts_fan_out_and_merge(world, spark):
    both = world["student_cohort"].unionByName(world["table"]("student_cohort", dict(student_id=1, cohort_code="INC009")))
    rows = conform.conform_quizzes(feed(world, "incubator_quiz_monitoring"), world["student_details"], both, world["resource"])
    target = world["table"]("student_quiz", dict(id=5, student_id=1, resource_id=11, marks=1))
    assert rows.count() == 2
    with pytest.raises(Exception, match="merge key occurs twice"):
        conform.merged("student_quiz", target, rows, on_dup="raise").collect()
    assert values(conform.merged("student_quiz", target, rows), "id", "student_id", "cohort_code", "marks") == [(5, 1, "INC009", 86)]
    videos = world["table"]("student_pre_recorded", dict(id=1, student_id=1, resource_id=12, cohort_code="FIRST"))
    watched = conform.conform_pre_recorded(feed(world, "student_session_information"), world["student_details"], both, world["resource"])
    assert values(conform.merged("student_pre_recorded", videos, watched), "cohort_code", "watchtime_in_sec") == [("FIRST", 90)]


def test_profile_and_demography(world):
    rows = values(enrich.student_demography(profile(world)), "student_id", "Incubator_Batch", "district", "education_category", "subject_areas", "sub_fields_list", "course_name", "college_name", "form_details")
    assert rows == [
        (1, "Incubator 7.0", "New Delhi", "Arts", None, None, "BA", None, '{"y":1}'),
        (1, "Incubator 7.0", "New Delhi", "STEM", "Maths, Physics", "Optics", "BSc", "City College", '{"y":1}'),
        (2, "Incubator 8.0", None, None, None, None, None, None, None),
    ]
    empty = world["sheet"].filter("Student_id = '1'")
    by_id = enrich.student_profile(world["student_details"], empty, world["location_mapping"], world["student_registration_details"], profile(world).select("student_id", F.lit(0).alias("education_course_id"), "education_category", "subject_areas", "sub_fields_list", "course_name", "college_name", "university_name"), sheet_join="id_left")
    assert values(by_id.filter("student_id = 2"), "Incubator_Batch") == [(None,)]


def test_attendance_ranges(world):
    held = enrich.sessions_in_cohorts(world["live_session"], world["cohort"])
    assert values(held, "session_id") == [(20,), (20,)]  # on the last day of one cohort and the first of the other
    assert enrich.sessions_in_cohorts(world["live_session"], world["cohort"], distinct_sessions=True).count() == 1
    one = enrich.sessions_in_cohorts(world["live_session"], world["cohort"], ["INC007"])
    facts = conform.conform_sessions(feed(world, "student_session_information"), world["student_details"], world["student_cohort"], world["live_session"])
    got = enrich.daily_weekly_attendance(facts, one, profile(world))
    assert values(got, "weekday_name", "student_id", "session_id", "attended_on", "course_name") == [
        ("Friday", 1, 20, D(2025, 1, 10), "BA"), ("Friday", 1, 20, D(2025, 1, 10), "BSc"),
    ]
    merged = enrich.merged("daily_weekly_attendance", got.limit(0), got)
    assert values(merged, "student_id", "session_id", "course_name") == [(1, 20, "BSc")]


def test_subjects_are_grouped_once(rows):
    study = [(1, 1, [1, 2, 1, None], 1, None), (1, 1, [1, 2, 1, None], 1, None), (1, 1, [2, 9], 2, 1), (1, 2, [9], 1, 1), (2, 3, [1], 1, 1), (2, 1, [1], 7, 7)]
    got = enrich.subject_profile(
        rows("student_id int, education_course_id int, subject_id array<int>, college_id int, university_id int", *study),
        rows("id int, education_category string, subject_area string, sub_field string", (1, "c", "x", None), (2, "b", "x", "f")),
        rows("course_id int, course_name string", (1, "BSc"), (2, "BA")),
        rows("college_id int, standard_college_names string", (1, "k"), (2, "k")),
        rows("university_id int, standard_university_names string", (1, "u")),
    )
    assert values(got, "student_id", "education_category", "subject_areas", "sub_fields_list", "course_name", "college_name", "university_name") == [
        (1, "b, c", "x", "f", "BSc", "k", "u"), (1, "b, c", "x", "f", "BSc", "k", None), (2, "c", "x", None, "BSc", None, None),
    ]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1


def test_reports(world):
    facts = enrich.final_assignment(assignments(world), world["resource"], profile(world))
    merged = enrich.merged("final_assignment", facts.limit(0), facts)
    overview = report.resubmission_overview(merged, world["student_details"])
    assert values(overview, "student_id", "email_id", "total_submissions", "resubmissions_count", "resubmission_rate", "acceptance_rate", "rejected_count", "rejection_rate", "last_submission_date") == [
        (1, "a@x", 2, 1, Decimal("50.00"), Decimal("0.00"), 1, Decimal("50.00"), TS(2025, 1, 2, 10)),
        (2, "b@x", 0, 0, Decimal("0.00"), None, 0, None, None),
    ]
    by_course = report.resubmission_overview(facts, world["student_details"], by_course=True)
    assert values(by_course, "student_id", "college_name", "total_submissions") == [(1, "City College", 2), (1, None, 2), (2, None, 0)]
    table = report.registration_overview(enrich.student_demography(profile(world)), world["student_details"], world["student_registration_details"])
    assert values(table, "student_id", "phone", "registration_date") == [(1, "11", TS(2024, 12, 1))] * 2
    kept = report.merged("student_registration_overview", table.limit(0), table)
    assert values(kept, "student_id", "course_name") == [(1, "BSc")]


def test_backfill_by_course_name(world):
    sheet, cohorts = world["sheet"].withColumn("Student_Role", F.lit("Student leader")), world["cohort"]
    quizzes = conform.backfill_quizzes(feed(world, "incubator_quiz_monitoring"), sheet, cohorts, world["resource"], "Incubator 7.0")
    assert values(quizzes, "student_id", "cohort_code", "marks") == [(1, "INC007", 86)]
    other = conform.backfill_quizzes(feed(world, "incubator_quiz_monitoring"), sheet, cohorts, world["resource"], "Incubator 8.0")
    assert other.count() == 0
    sessions = conform.backfill_sessions(feed(world, "student_session_information"), sheet, cohorts, world["live_session"])
    assert values(sessions, "student_id", "watched_on") == [(1, None), (2, None)]
    members = conform.backfill_memberships(sheet, world["student_details"], cohorts)
    assert values(members, "student_code", "is_leader") == [("25INC0070000001", True), ("25INC0080000002", True)]


def test_backfill_meets_only_cohorts_that_hold_the_code(rows, monkeypatch):
    sheet = rows("Student_id string, Email string, Incubator_Batch string, Incubator_Course_Name string", ("1", "a@x", "b", "n"), ("2", "b@x", "b", "m"))
    cohorts = rows("cohort_name string, cohort_code string", *[("n", f"INC{i:03}") for i in range(30)], ("m", "INC004"))
    live = rows("id int, code string, cohort_code string", (7, "WS1", "INC003"), (8, "WS1", "INC003"), (9, "WS1", "INC004"), (10, "WS2", "INC005"), (11, "WS1", "INC099"))
    watched = rows("Email string, Session_Code string, Duration_in_secs string, watched_on string", ("a@x", "WS1", "5", "x"), ("a@x", "WS1", "5", "x"), ("b@x", "WS1", "6", None))
    met, by_email = [], conform._by_email
    monkeypatch.setattr(conform, "_by_email", lambda feed, email, people: met.append(people.count()) or by_email(feed, email, people))
    got = conform.backfill_sessions(watched, sheet, cohorts, live)
    assert values(got, "student_id", "session_id", "duration_in_sec") == sorted([(1, 7, 5), (1, 8, 5), (1, 9, 5)] * 2 + [(2, 9, 6)], key=str)
    assert met == [2]  # a student once, not once for each of 30 cohorts


def test_live_sessions(spark, rows):
    new = rows("Batch string, Topic string, `Session Type` string, `Session Code` string, Date string, _seq int",
               ("Incubator 7.0", "T1", "Workshop", "WS1", "5-Jan-24", 1), ("Incubator 7.0", "T2", "Workshop", "WS1", "05-JAN-24", 2), ("Incubator 7.0", "T3", "Workshop", "WS2", "soon", 3))
    old = rows("id int, cohort_code string, session_name string, type string, code string, duration_in_sec int, conducted_on timestamp_ntz",
               (1, "INC007", "x", "Workshop", "WS1", 60, TS(2024, 1, 5)), (2, "INC007", "y", "Workshop", "WS1", 60, TS(2024, 1, 5)))
    got = landing.merge_live_sessions(old, new, ["id"], ["_seq"])
    assert values(got, "id", "session_name", "code", "duration_in_sec", "conducted_on") == [
        (2, "T2", "WS1", 3600, TS(2024, 1, 5)), (None, "T3", "WS2", 3600, None),
    ]


def test_onboarding(spark, rows, world):
    now = Audit(now=TS(2025, 7, 1, 12))
    people = conform.onboard_students(rows("full_name string, caste string, annual_family_income string", ("Asha Rao", "OBC", "x"), (None, "y", "z")), now)
    numbered = repair.fill_missing_ids(world["student_details"].unionByName(people), ["first_name"], "id")
    done = conform.fill_emails(numbered, "example.org")
    assert values(done.filter("id = 3"), "email", "first_name", "last_name", "gender", "inserted_at") == [
        ("3@example.org", "Asha", "Rao", "F", TS(2025, 7, 1, 12)),
    ]
    upload = rows("student_id string, currently_pursuing_degree string, currently_pursuing_year string, subject_area string, college_name string, district string, state_union_territory string, city_category string, university_name string, assigned_through string, registration_date string",
                  ("1", " BSC", "2nd Year", "Optics, unknown", "city college", "new delhi ", "DELHI", "tier 1", None, "web", "2025-06-01"),
                  ("2", "BA", None, "", "x", None, None, None, None, None, None))
    courses = rows("course_id int, display_name string, course_duration int", (1, "BSc", 3), (2, "BA", 4))
    education = conform.onboard_education(upload, done, courses, world["subject_mapping"], world["college_mapping"], world["location_mapping"], world["university_mapping"], D(2025, 7, 1), now)
    assert values(education, "student_id", "education_course_id", "subject_id", "college_id", "college_location_id", "start_year", "end_year") == [
        (1, 1, [1, 2, None], 1, 1, 2024, 2027),
    ]
    registered = conform.onboard_registrations(upload, done, now)
    assert values(registered, "student_id", "registration_date", "form_details") == [
        (1, D(2025, 6, 1), '{"currently_pursuing_year":"2nd Year"}'), (2, None, '{"currently_pursuing_year":null}'),
    ]


def test_cohorts(spark, rows):
    details = rows("`Cohort number` string, `Cohort Name` string, Type string, `Start Date` string, `End Date` string, `Program Name` string",
                   ("7", "Seven", "open", "01/02/2024", "30-06-2024", "INCUBATOR"), ("8", "Eight", "open", None, None, "Incubator"), ("9", "x", "open", None, None, "Other"))
    got = conform.conform_cohorts(details, conform.programs(spark), D(2024, 6, 30))
    assert values(got, "cohort_code", "start_date", "is_active") == [("INC007", D(2024, 2, 1), True), ("INC008", None, False)]
    with pytest.raises(ValueError):
        landing.append_cohorts(got, [("INC007", "again")], "cohort_code string, cohort_name string")


def test_repairs(rows):
    students = rows("caste string, annual_family_income_inr string", (" OTHERS ", "below 3 lacs"), ("SC", " Below 12 Lacs"), (None, "other"), ("x", "Above 3 lacs per year (INR)"))
    assert values(repair.standardise_students(students)) == [
        ("Other", "Below or Equal to 3 lacs per year (INR)"), ("SC", "Above 5 lacs per year (INR)"),
        ("x", "Between 3-5 lacs (INR) per year"), (None, "other"),
    ]
    sheet = rows("Incubator_Batch string, State_Union_Territory string, District string",
                 ("Incubator 7.0", " x ", " Bengaluru Urban "), ("Other", " x ", " Pune "), ("Other", "New Delhi", "Y"), ("Incubator 4.0", None, "Mysuru"))
    assert values(repair.repair_geography(sheet)) == [
        ("Incubator 4.0", None, "Mysore"), ("Incubator 7.0", "Karnataka", "Bangalore Urban"), ("Other", " x ", " Pune "), ("Other", "Delhi", "Y"),
    ]
    colleges = repair.standardise_colleges(rows("standard_college_names string", ("ACS Medical College & Hospital",), ("Other",)))
    assert values(colleges)[0][0].startswith("Narsee")


def test_purges(rows):
    feed_rows = rows("Email string, submitted_at string", ("a", "2025-01-01T10:00:00.123Z"), ("b", "2025-01-01T10:00:00.123Z"), ("a", "2025-01-01"), ("a", None))
    sheet = rows("Email string, Incubator_Batch string", ("a", "Incubator 7.0"), ("a", "Incubator 7.0"), ("b", "x"))
    split = repair.purge_malformed_feed(feed_rows, sheet, ["Incubator 7.0"])
    assert values(split.removed) == [("a", "2025-01-01T10:00:00.123Z")] and split.kept.count() == 3
    students = rows("id int, email string", (1, "a"), (2, "a"), (3, "a"), (4, None))
    done = repair.purge_duplicate_students(students, rows("student_id int", (1,)))
    assert (values(done.kept, "id"), values(done.deleted, "id"), values(done.skipped, "id")) == ([(1,), (3,), (4,)], [(2,)], [(1,)])


def test_remove_students(rows):
    sheet = rows("Student_id string, Email string", ("1", "a"), ("2", "b"), (None, "c"))
    parts = repair.remove_students(rows("id int", (2,)), {"student_quiz": rows("student_id int", (1,), (2,))}, rows("id int, email string", (1, "a"), (2, "b")), sheet, {1: "new@x"})
    assert list(parts) == ["student_quiz", "student_details", "general_information_sheet"]
    assert values(parts["student_details"].kept) == [(1, "new@x")] and values(parts["student_quiz"].removed) == [(2,)]
    assert values(parts["general_information_sheet"].kept) == [("1", "new@x"), (None, "c")]


def test_guard_and_patch(rows):
    df = rows("k int, v string, seq int", (1, "a", 1), (1, "b", 2), (None, "c", 3), (None, "d", 4))
    done = repair.guard_table(df, ["k"], ["seq"])
    assert values(done.rows, "v") == [("a",), ("c",)] and done.duplicates.count() == 2
    sheet = rows("Student_id string, Incubator_Batch string, District string, Incubator_Course_Name string", ("1", "Incubator 6.0", "x", "c1"), ("2", "Incubator 6.0", "y", "c2"))
    cleaned = rows("Student_id string, Incubator_Batch string, District string, Incubator_Course_Name string, seq int", ("1", "Incubator 6.0", None, "n1", 1), ("2", "Incubator 7.0", "z", "n2", 2))
    assert values(repair.patch_sheet(sheet, cleaned, ["Incubator 7.0"], ["seq"]), "Student_id", "District", "Incubator_Batch") == [("1", "x", "Incubator 6.0"), ("2", "z", "Incubator 7.0")]
    assert values(repair.patch_course_names(sheet, cleaned, "Incubator 6.0", ["seq"]), "Incubator_Course_Name") == [("c2",), ("n1",)]


def test_layer_runs(spark, tmp_path):
    from tierflow import __main__ as cli
    from tierflow.plans import run

    world = make_world(spark, tmp_path)
    store = world["store"]
    for name in conformed_names(world):
        store.publish("conformed", name, world[name])
    store.publish("landing", "general_information_sheet", world["sheet"])

    def tables(outcomes):
        assert all(o.error is None for o in outcomes), outcomes
        return {o.table: o.published.rows for o in outcomes}

    facts = {"student_assignment": 4, "student_session": 2, "student_pre_recorded": 1, "student_quiz": 1}
    assert tables(run.run_conform(store, "c1")) == facts
    for feed_name, table, reject in (("incubator_quiz_monitoring", "student_quiz", conform.rejected_quizzes),):
        bad = reject(store.read("landing", feed_name), world["student_details"], world["student_cohort"], world["resource"])
        kept = spark.read.parquet(f"{store.root}/audit/rejected_{table}/run_id=c1")
        # Every feed row is accepted or listed with its reasons.
        assert bad.count() == kept.count() == store.read("landing", feed_name).count() - facts[table]
    enriched = {"final_quiz": 1, "student_demography": 2, "final_assignment": 4, "daily_weekly_attendance": 1}
    assert tables(run.run_enrich(store, "r1", ["INC007"])) == enriched
    assert tables(run.run_report(store)) == {"resubmission_count_overview": 2, "student_registration_overview": 1}
    # A second run changes nothing, and a broken input stops its own table only.
    store.publish("conformed", "live_session", world["live_session"].drop("code"))
    again = {o.table: o.published and o.published.rows for o in run.run_conform(store)}
    assert again == {**facts, "student_session": None}
    assert values(store.read("conformed", "student_assignment"), "id") == [(1,), (2,), (3,), (4,)]
    store.rollback("conformed", "live_session")
    assert tables(run.run_enrich(store, "r2", ["INC007"])) == enriched
    rebuilt = tables(run.run_enrich(store, "r3", rebuild=True))
    assert rebuilt == {"final_quiz": 2, "student_demography": 3, "final_assignment": 7, "daily_weekly_attendance": 4}
    assert cli.main(["report", "--store", store.root, "--rebuild"]) == 0
    assert store.read("reporting", "resubmission_count_overview").count() == 3


def conformed_names(world):
    from tierflow.sources.schemas import CONFORMED

    return [n for n in world if n in CONFORMED]
