"""Facts with the student's profile.

Everything known about a student is joined at student size first (``student_profile``), so each fact
table meets it in a single join on the student id, which AQE can split where one student is hot. The
profile serves all four fact tables: persist it or write it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.aggregate import joined_distinct
from ..operators.dedupe import dedupe_keep_last
from ..operators.joins import range_join, unnest
from ..operators.merge import upsert
from ..operators.sizing import broadcast_if_small
from ..sources.schemas import MERGE_KEYS

# Profile columns every enriched table ends with.
PROFILE_COLUMNS = [
    "form_details", "state_union_territory", "district", "country", "city_category",
    "education_category", "subject_areas", "sub_fields_list", "course_name", "college_name", "university_name",
]


def subject_profile(
    education: DataFrame, subjects: DataFrame, courses: DataFrame, colleges: DataFrame, universities: DataFrame
) -> DataFrame:
    """One row per student, course and place of study, with subject lists per student and course.

    Lists and places come from one grouping: places are collected as a set of structs (a student has
    few per course) and listed again, in place of a second distinct and a join.
    """
    # The sets of the one grouping below drop equal combinations, so these travel once, to their subject if it does not fit a broadcast.
    ids = unnest(education.select("student_id", "education_course_id", "subject_id", "college_id", "university_id"), "subject_id", "_subject_id")
    ids = ids.drop("subject_id")
    mapped = (
        ids.join(broadcast_if_small(subjects), F.col("_subject_id") == subjects["id"])
        .join(broadcast_if_small(courses.select("course_id", "course_name")), F.col("education_course_id") == F.col("course_id"))
        .join(
            broadcast_if_small(colleges.select("college_id", F.col("standard_college_names").alias("college_name"))), "college_id", "left"
        )
        .join(
            broadcast_if_small(universities.select("university_id", F.col("standard_university_names").alias("university_name"))),
            "university_id", "left",
        )
    )
    grouped = mapped.groupBy("student_id", "education_course_id").agg(
        joined_distinct(F.col("education_category")).alias("education_category"),
        joined_distinct(F.col("subject_area")).alias("subject_areas"),
        joined_distinct(F.col("sub_field")).alias("sub_fields_list"),
        F.collect_set(F.struct("course_name", "college_name", "university_name")).alias("_places"),
    )
    return grouped.select(
        "student_id", "education_course_id", "education_category", "subject_areas", "sub_fields_list",
        F.inline("_places"),
    )


def _sheet_batches(sheet: DataFrame, key: str) -> DataFrame:
    return sheet.select(F.col(key).alias("_sheet_key"), F.col("Incubator_Batch"))


def student_profile(
    students: DataFrame,
    sheet: DataFrame,
    locations: DataFrame,
    registrations: DataFrame,
    subject_rows: DataFrame,
    sheet_join: str = "email",
) -> DataFrame:
    """Student, batch, place, form and subjects; one row per combination.

    ``sheet_join="email"`` keeps students found in the info sheet by e-mail; ``"id_left"``, the older
    form, keeps all students and matches by id.
    """
    if sheet_join == "email":
        base = students.join(_sheet_batches(sheet, "Email"), F.col("email") == F.col("_sheet_key"))
    elif sheet_join == "id_left":
        by_id = _sheet_batches(sheet.withColumn("_id", F.col("Student_id").cast("int")), "_id")
        base = students.join(by_id, F.col("id") == F.col("_sheet_key"), "left")
    else:
        raise ValueError(f"sheet_join must be 'email' or 'id_left', not {sheet_join!r}")
    base = base.select(
        F.col("id").alias("student_id"), "email", "caste", "annual_family_income_inr", "location_id", "Incubator_Batch"
    )
    places = locations.select("location_id", "state_union_territory", "district", "country", "city_category")
    return (
        base.join(places, "location_id", "left")
        .join(registrations.select("student_id", "form_details"), "student_id", "left")
        .join(subject_rows.drop("education_course_id"), "student_id", "left")
        .drop("location_id")
    )


def student_demography(profile: DataFrame) -> DataFrame:
    return profile.select(
        "student_id", "email", "caste", "annual_family_income_inr", "Incubator_Batch", *PROFILE_COLUMNS
    )


def _with_resource(facts: DataFrame, resources: DataFrame) -> DataFrame:
    r = resources.select(F.col("id").alias("resource_id"), "category", "title")
    return facts.join(broadcast_if_small(r), "resource_id")


def final_quiz(quizzes: DataFrame, resources: DataFrame, profile: DataFrame) -> DataFrame:
    facts = _with_resource(
        quizzes.select("id", "resource_id", "student_id", "cohort_code", "marks", "max_marks"), resources
    )
    return facts.join(profile, "student_id").select(
        "id", "resource_id", "student_id", "Incubator_Batch", "category", "title", "cohort_code", "marks",
        "max_marks", *PROFILE_COLUMNS,
    )


def final_assignment(assignments: DataFrame, resources: DataFrame, profile: DataFrame) -> DataFrame:
    facts = _with_resource(
        assignments.select("student_id", "resource_id", "cohort_code", "submission_status", "submitted_at"), resources
    )
    return facts.join(profile, "student_id").select(
        "student_id", "Incubator_Batch", "resource_id", "category", "title", "cohort_code", "submission_status",
        "submitted_at", *PROFILE_COLUMNS,
    )


def sessions_in_cohorts(
    live_sessions: DataFrame,
    cohorts: DataFrame,
    cohort_codes: list[str] | None = None,
    distinct_sessions: bool = False,
) -> DataFrame:
    """Live sessions held within a cohort's dates; one inside two ranges appears twice unless distinct.

    The ranges apply to all sessions, whatever their own cohort is.
    """
    chosen = cohorts if cohort_codes is None else cohorts.filter(F.col("cohort_code").isin(*cohort_codes))
    sessions = live_sessions.select(
        F.col("id").alias("session_id"),
        F.col("session_name").alias("title"),
        "code",
        F.col("conducted_on").cast("date").alias("conducted_on"),
    )
    ranges = chosen.select("start_date", "end_date")
    held = range_join(sessions, ranges, F.col("conducted_on"), F.col("start_date"), F.col("end_date"), bucket_days=92)
    held = held.select(*sessions.columns)
    return held.distinct() if distinct_sessions else held


def daily_weekly_attendance(attendance: DataFrame, sessions: DataFrame, profile: DataFrame) -> DataFrame:
    day: Column = dates.attended_on(F.col("watched_on"), F.col("conducted_on"))
    facts = attendance.select("student_id", "session_id", "duration_in_sec", "watched_on").join(
        broadcast_if_small(sessions), "session_id"
    )
    return facts.withColumn("attended_on", day).join(profile, "student_id").select(
        dates.weekday_name(F.col("attended_on")).alias("weekday_name"),
        "student_id", "session_id", F.col("Incubator_Batch").alias("incubator_batch"), "title", "code",
        "conducted_on", "attended_on", "duration_in_sec", *PROFILE_COLUMNS,
    )


# Columns an enriched merge leaves alone on a match.
_KEPT_ON_MATCH = {"final_quiz": ["id"]}


def clean_sheet(sheet: DataFrame, order_by: list[str]) -> DataFrame:
    """The info sheet with the last row of each e-mail; rows without one all stay."""
    return dedupe_keep_last(sheet, ["Email"], order_by)


def merged(table: str, target: DataFrame, rows: DataFrame, target_order: list[str] | None = None, on_dup: str = "last") -> DataFrame:
    """Remove duplicates from the target if an order is given, then upsert by the table's key.

    A student with two courses yields two rows per key; by default the last in column order wins.
    """
    keys = MERGE_KEYS[table]
    base = target if target_order is None else dedupe_keep_last(target, keys, target_order)
    return upsert(base, rows, keys, updated_columns(table, rows), on_dup=on_dup)


def updated_columns(table: str, rows: DataFrame) -> list[str]:
    kept = [*MERGE_KEYS[table], *_KEPT_ON_MATCH.get(table, [])]
    return [c for c in rows.columns if c not in kept]
