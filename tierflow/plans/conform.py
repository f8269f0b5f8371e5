"""Landing feeds into typed tables with resolved keys.

Each builder returns rows in table form. Rows drop out where a key does not resolve, as inner joins
do; ``rejected`` lists them with the reason. ``merged`` upserts rows into the table as it was.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, jsondoc, numbers, text
from ..operators.aggregate import distinct_array
from ..operators.joins import normalised_join, unnest_text
from ..operators.merge import Audit, upsert
from ..operators.sizing import broadcast_if_small
from ..sources.schemas import (
    LIVE_SESSION_PREFIXES,
    MERGE_KEYS,
    PROGRAMS,
    RECORDED_PREFIXES,
    SUBMISSION_STATUSES,
    aligned,
)

# Fixed value: quizzes are marked out of a hundred.
QUIZ_MAX_MARKS = 100


def _people(students: DataFrame, memberships: DataFrame) -> DataFrame:
    """E-mail to student and cohort: one row per membership, joined before any fact is touched."""
    ids = students.select(F.col("id").alias("student_id"), F.col("email").alias("_email"))
    return ids.join(memberships.select("student_id", "cohort_code"), "student_id")


def _people_by_sheet(sheet: DataFrame, batch: str | None) -> DataFrame:
    """The same through the info sheet: its course name stands for the cohorts, if wanted for one batch only."""
    rows = sheet if batch is None else sheet.filter(F.col("Incubator_Batch") == batch)
    return rows.select(
        F.col("Student_id").cast("int").alias("student_id"),
        F.col("Email").alias("_email"),
        F.col("Incubator_Course_Name").alias("cohort_name"),
    )


def _in_cohorts(rows: DataFrame, cohorts: DataFrame | None) -> DataFrame:
    """One row per cohort of a course name, after all that leaves rows out; nothing to do for people with their cohort."""
    if cohorts is None:
        return rows
    return rows.join(broadcast_if_small(cohorts.select("cohort_name", "cohort_code")), "cohort_name").drop("cohort_name")


def _by_email(feed: DataFrame, email: str, people: DataFrame) -> DataFrame:
    """The feed with student and cohort: not shuffled while the people fit a broadcast."""
    return feed.join(broadcast_if_small(people), F.col(email) == F.col("_email"))


def _titled(resources: DataFrame, category: str | None = None) -> DataFrame:
    rows = resources if category is None else resources.filter(F.col("category") == category)
    return rows.select(F.col("id").alias("resource_id"), F.col("title").alias("_title"))


def _assignments(
    feed: DataFrame, people: DataFrame, resources: DataFrame, submitted: Column, cohorts: DataFrame | None = None
) -> DataFrame:
    named = _by_email(feed, "Email", people).join(
        _titled(resources, "Assignment"), F.col("assignment_name") == F.col("_title")
    )
    rows = _in_cohorts(named, cohorts).select(
        "student_id",
        "resource_id",
        "cohort_code",
        "submission_status",
        numbers.marks_for_status(F.col("submission_status")).alias("marks_pct"),
        "feedback_comments",
        submitted.alias("submitted_at"),
        "assignment_file",
    )
    return aligned(rows, "student_assignment").drop("id")


def _valid_submission(feed: DataFrame) -> DataFrame:
    """Filled and readable timestamp, known or missing status."""
    status = F.col("submission_status")
    readable = dates.timestamp_from_text(F.col("submitted_at")).isNotNull()
    return feed.filter(
        text.is_filled(F.col("submitted_at")) & readable & (status.isNull() | status.isin(*SUBMISSION_STATUSES))
    )


def conform_assignments(
    feed: DataFrame, students: DataFrame, memberships: DataFrame, resources: DataFrame
) -> DataFrame:
    submitted = dates.timestamp_from_text(F.col("submitted_at"))
    return _assignments(_valid_submission(feed), _people(students, memberships), resources, submitted)


def _whole_or_null(c: Column) -> Column:
    return c.isNull() | numbers.is_short_integer(c) | numbers.int_from_text(c).isNotNull()


def _date_or_null(c: Column) -> Column:
    return c.isNull() | dates.date_from_text(c).isNotNull()


def _watched(feed: DataFrame, prefixes: list[str]) -> DataFrame:
    readable = _whole_or_null(F.col("Duration_in_secs")) & _date_or_null(F.col("watched_on"))
    return feed.filter(text.has_prefix(F.col("Session_Code"), prefixes) & readable).select(
        "Email",
        "Session_Code",
        numbers.int_from_text(F.col("Duration_in_secs")).alias("_seconds"),
        dates.date_from_text(F.col("watched_on")).alias("_watched"),
    )


def _sessions(feed: DataFrame, people: DataFrame, live_sessions: DataFrame, cohorts: DataFrame | None = None) -> DataFrame:
    live = live_sessions.select(
        F.col("id").alias("session_id"), F.col("code").alias("_code"), F.col("cohort_code").alias("_cohort")
    )
    theirs = _by_email(feed, "Email", people)
    if cohorts is not None:
        # A feed row goes on only in the cohorts that hold its code, not in all cohorts of its course name.
        held = live.select("_code", F.col("_cohort").alias("cohort_code")).distinct().join(cohorts.select("cohort_name", "cohort_code"), "cohort_code")
        named = broadcast_if_small(held.withColumnsRenamed({"_code": "_held", "cohort_name": "_name"}))
        theirs = theirs.join(named, (F.col("Session_Code") == F.col("_held")) & (F.col("cohort_name") == F.col("_name")))
    # One code and cohort may have very many rows on both sides. Only what the result holds travels, and a merge join runs along
    # a code's sessions in order, in tasks that AQE can split; texts are parsed in the stage before it.
    slim = theirs.select("student_id", "_seconds", "_watched", "Session_Code", "cohort_code")
    matched = slim.join(live.hint("merge"), (F.col("Session_Code") == F.col("_code")) & (F.col("cohort_code") == F.col("_cohort")))
    rows = matched.select(
        "student_id", "session_id", F.col("_seconds").alias("duration_in_sec"), F.col("_watched").alias("watched_on")
    )
    return aligned(rows, "student_session").drop("id")


def conform_sessions(
    feed: DataFrame, students: DataFrame, memberships: DataFrame, live_sessions: DataFrame
) -> DataFrame:
    return _sessions(_watched(feed, LIVE_SESSION_PREFIXES), _people(students, memberships), live_sessions)


def _quizzes(feed: DataFrame, people: DataFrame, resources: DataFrame, cohorts: DataFrame | None = None) -> DataFrame:
    readable = feed.filter(_whole_or_null(F.col("value")))
    named = _by_email(readable, "user_id", people).join(
        _titled(resources, "Quiz"), F.col("data_fields") == F.col("_title")
    )
    rows = _in_cohorts(named, cohorts).select(
        "student_id",
        "resource_id",
        "cohort_code",
        numbers.int_from_text(F.col("value")).alias("marks"),
        F.lit(QUIZ_MAX_MARKS).alias("max_marks"),
    )
    return aligned(rows, "student_quiz").drop("id")


def conform_quizzes(feed: DataFrame, students: DataFrame, memberships: DataFrame, resources: DataFrame) -> DataFrame:
    return _quizzes(feed, _people(students, memberships), resources)


def _pre_recorded(feed: DataFrame, people: DataFrame, resources: DataFrame, cohorts: DataFrame | None = None) -> DataFrame:
    named = _by_email(feed, "Email", people).join(_titled(resources), F.col("Session_Code") == F.col("_title"))
    rows = _in_cohorts(named, cohorts).select(
        "student_id",
        "resource_id",
        "cohort_code",
        F.col("_seconds").alias("watchtime_in_sec"),
        F.col("_watched").cast("timestamp_ntz").alias("watched_at"),
    )
    return aligned(rows, "student_pre_recorded").drop("id")


def conform_pre_recorded(
    feed: DataFrame, students: DataFrame, memberships: DataFrame, resources: DataFrame
) -> DataFrame:
    return _pre_recorded(_watched(feed, RECORDED_PREFIXES), _people(students, memberships), resources)


def conform_memberships(upload: DataFrame, students: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Cohort membership from an upload keyed by student id and cohort code."""
    ids = students.select(F.col("id").alias("student_id"))
    starts = cohorts.select("cohort_code", "start_date")
    joined = upload.select(
        F.col("student_id").cast("int"), "cohort_code", "student_role"
    ).join(ids, "student_id").join(starts, "cohort_code")
    return _membership(joined)


def _membership(joined: DataFrame) -> DataFrame:
    code = text.student_code(F.col("start_date"), F.col("cohort_code"), F.col("student_id"))
    rows = joined.select(
        code.alias("student_code"),
        "student_id",
        text.cut(F.col("cohort_code"), 6).alias("cohort_code"),
        text.leader_flag(F.col("student_role")).alias("is_leader"),
    )
    return aligned(rows, "student_cohort")


# Columns a merge leaves alone although the rows have them: a watched video keeps its first cohort.
_KEPT_ON_MATCH = {"student_pre_recorded": ["cohort_code"]}


def merged(
    table: str,
    target: DataFrame,
    rows: DataFrame,
    on_dup: str = "last",
    order_by: list[str] | None = None,
    audit: Audit | None = None,
) -> DataFrame:
    """Upsert rows into a conformed table by its fixed key.

    A student in two cohorts yields two rows per key; by default the last in column order wins.
    """
    updates = updated_columns(table, rows, order_by)
    return upsert(target, rows, MERGE_KEYS[table], updates, on_dup=on_dup, order_by=order_by, audit=audit)


def updated_columns(table: str, rows: DataFrame, order_by: list[str] | None = None) -> list[str]:
    kept = [*MERGE_KEYS[table], *_KEPT_ON_MATCH.get(table, []), *(order_by or [])]
    return [c for c in rows.columns if c not in kept]


def _expression(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rejected(
    feed: DataFrame, lookups: list[tuple[str, Column | str, DataFrame, Column | str]], checks: dict[str, Column]
) -> DataFrame:
    """Feed rows that would drop out, with all reasons.

    ``lookups`` holds (reason, feed column, table, table column); ``checks`` maps a reason to a
    condition that is true for bad rows.
    """
    tagged, reasons = feed, []
    for i, (reason, column, table, table_column) in enumerate(lookups):
        known = broadcast_if_small(table.select(_expression(table_column).alias(f"_k{i}")).distinct())
        tagged = tagged.join(known, _expression(column) == F.col(f"_k{i}"), "left")
        reasons.append(F.when(F.col(f"_k{i}").isNull(), F.lit(reason)))
    reasons += [F.when(bad, F.lit(reason)) for reason, bad in checks.items()]
    found = F.filter(F.array(*reasons), lambda x: x.isNotNull())
    return tagged.select(*feed.columns, found.alias("reasons")).filter(F.size("reasons") > 0)


def rejected_assignments(
    feed: DataFrame, students: DataFrame, memberships: DataFrame, resources: DataFrame
) -> DataFrame:
    status, submitted = F.col("submission_status"), F.col("submitted_at")
    blank = ~F.coalesce(text.is_filled(submitted), F.lit(False))
    return rejected(
        feed,
        [
            ("unknown e-mail or no cohort", "Email", _people(students, memberships), "_email"),
            ("unknown title", "assignment_name", _titled(resources, "Assignment"), "_title"),
        ],
        {
            "blank timestamp": blank,
            "unreadable timestamp": ~blank & dates.timestamp_from_text(submitted).isNull(),
            "unknown status": F.coalesce(~status.isin(*SUBMISSION_STATUSES), F.lit(False)),
        },
    )


def _unreadable_watch() -> dict[str, Column]:
    return {
        "unreadable duration": ~_whole_or_null(F.col("Duration_in_secs")),
        "unreadable date": ~_date_or_null(F.col("watched_on")),
    }


def rejected_sessions(feed: DataFrame, students: DataFrame, memberships: DataFrame, live_sessions: DataFrame) -> DataFrame:
    """Rows of the session feed that are no recorded video and become no attendance."""
    # The few cohorts of a student and of a session code travel as sets, so no feed row meets more than one row of either side.
    theirs = _people(students, memberships).groupBy(F.col("_email").alias("_student")).agg(F.collect_set("cohort_code").alias("_cohorts"))
    held = live_sessions.groupBy(F.col("code").alias("_code")).agg(F.collect_set("cohort_code").alias("_held_in"))
    prefix = F.coalesce(text.has_prefix(F.col("Session_Code"), LIVE_SESSION_PREFIXES), F.lit(False))
    recorded = F.coalesce(text.has_prefix(F.col("Session_Code"), RECORDED_PREFIXES), F.lit(False))
    tagged = feed.filter(~recorded).join(theirs, F.col("Email") == F.col("_student"), "left").join(held, F.col("Session_Code") == F.col("_code"), "left")
    found = rejected(tagged, [], {
        "unknown e-mail or no cohort": F.col("_student").isNull(),
        "unknown session": F.col("_code").isNull(),
        "session of no cohort of the student": ~F.coalesce(F.arrays_overlap("_cohorts", "_held_in"), F.lit(False)),
        "unknown kind of session": ~prefix,
        **_unreadable_watch(),
    })
    return found.select(*feed.columns, "reasons")


def rejected_pre_recorded(feed: DataFrame, students: DataFrame, memberships: DataFrame, resources: DataFrame) -> DataFrame:
    """Rows of recorded videos that become no watch time."""
    return rejected(
        feed.filter(text.has_prefix(F.col("Session_Code"), RECORDED_PREFIXES)),
        [
            ("unknown e-mail or no cohort", "Email", _people(students, memberships), "_email"),
            ("unknown title", "Session_Code", _titled(resources), "_title"),
        ],
        _unreadable_watch(),
    )


def rejected_quizzes(feed: DataFrame, students: DataFrame, memberships: DataFrame, resources: DataFrame) -> DataFrame:
    return rejected(
        feed,
        [
            ("unknown e-mail or no cohort", "user_id", _people(students, memberships), "_email"),
            ("unknown title", "data_fields", _titled(resources, "Quiz"), "_title"),
        ],
        {"unreadable mark": ~_whole_or_null(F.col("value"))},
    )


def rejected_memberships(upload: DataFrame, students: DataFrame, cohorts: DataFrame) -> DataFrame:
    typed = F.col("student_id").cast("string").try_cast("int")
    return rejected(
        upload,
        [("unknown student", typed, students, "id"), ("unknown cohort", "cohort_code", cohorts, "cohort_code")],
        {},
    )


# --- Backfill: the same tables keyed through the info sheet -------------------------------------


def backfill_assignments(
    feed: DataFrame, sheet: DataFrame, cohorts: DataFrame, resources: DataFrame, batch: str | None = None
) -> DataFrame:
    submitted = dates.timestamp_from_text(F.col("submitted_at"))
    status = F.col("submission_status")
    usable = feed.filter(
        (F.col("submitted_at").isNull() | submitted.isNotNull())
        & (status.isNull() | status.isin(*SUBMISSION_STATUSES))
    )
    return _assignments(usable, _people_by_sheet(sheet, batch), resources, submitted, cohorts)


def backfill_sessions(
    feed: DataFrame, sheet: DataFrame, cohorts: DataFrame, live_sessions: DataFrame, batch: str | None = None
) -> DataFrame:
    """The backfill form does not take over the date watched."""
    undated = _watched(feed.withColumn("watched_on", F.lit(None).cast("string")), LIVE_SESSION_PREFIXES)
    return _sessions(undated, _people_by_sheet(sheet, batch), live_sessions, cohorts)


def backfill_quizzes(
    feed: DataFrame, sheet: DataFrame, cohorts: DataFrame, resources: DataFrame, batch: str | None = None
) -> DataFrame:
    return _quizzes(feed, _people_by_sheet(sheet, batch), resources, cohorts)


def backfill_pre_recorded(
    feed: DataFrame, sheet: DataFrame, cohorts: DataFrame, resources: DataFrame, batch: str | None = None
) -> DataFrame:
    undated = _watched(feed.withColumn("watched_on", F.lit(None).cast("string")), RECORDED_PREFIXES)
    return _pre_recorded(undated, _people_by_sheet(sheet, batch), resources, cohorts)


def backfill_memberships(sheet: DataFrame, students: DataFrame, cohorts: DataFrame) -> DataFrame:
    ids = students.select(F.col("id").alias("student_id"), F.col("email").alias("_email"))
    named = sheet.select(
        "Email", F.col("Incubator_Course_Name").alias("cohort_name"), F.col("Student_Role").alias("student_role")
    )
    starts = cohorts.select("cohort_name", "cohort_code", "start_date")
    return _membership(named.join(ids, F.col("Email") == F.col("_email")).join(starts, "cohort_name"))


def programs(spark) -> DataFrame:
    return spark.createDataFrame(PROGRAMS, "program_code string, full_form string, start_date date")


def conform_cohorts(details: DataFrame, program_rows: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Cohorts from the sheet; the programme matches without regard to case."""
    p = program_rows.select("program_code", F.lower("full_form").alias("_program"))
    number = F.col("`Cohort number`")
    end = dates.date_day_first(F.col("`End Date`"))
    rows = details.join(p, F.lower(F.col("`Program Name`")) == F.col("_program")).select(
        text.cut(text.cohort_code(F.col("program_code"), number), 6).alias("cohort_code"),
        "program_code",
        numbers.int_from_text(number.cast("string")).alias("cohort_number"),
        text.cut(F.col("`Cohort Name`"), 300).alias("cohort_name"),
        F.col("Type").alias("type"),
        dates.date_day_first(F.col("`Start Date`")).alias("start_date"),
        end.alias("end_date"),
        dates.is_active(end, as_of).alias("is_active"),
    )
    return aligned(rows, "cohort")


def conform_live_sessions(details: DataFrame, cohorts: DataFrame) -> DataFrame:
    named = normalised_join(
        details, cohorts.select("cohort_code", "cohort_name"), [("Cohort_Name", "cohort_name")]
    )
    rows = named.select(
        "cohort_code",
        F.col("Session_Name").alias("session_name"),
        F.col("Type").alias("type"),
        F.col("`Session Code`").alias("code"),
        numbers.int_from_text(F.col("Duration")).alias("duration_in_sec"),
        dates.date_day_first(F.col("Conducted_On")).cast("timestamp_ntz").alias("conducted_on"),
    )
    return aligned(rows, "live_session").drop("id")


def conform_resources(details: DataFrame) -> DataFrame:
    rows = details.select(
        F.col("Category").alias("category"),
        text.cut(F.col("Title"), 300).alias("title"),
        F.col("`Content Name`").alias("description"),
        F.col("Is_Video").try_cast("boolean").alias("is_video_resource"),
        numbers.int_from_text(F.col("Time")).alias("total_duration"),
    )
    return aligned(rows, "resource").drop("id")


# --- One institution's sheet --------------------------------------------------------------------


def onboard_students(upload: DataFrame, audit: Audit = Audit()) -> DataFrame:
    """Students without an e-mail yet, which follows from ``fill_emails``.

    An upload with ``student_id`` gives them their ids; without it these follow from ``assign_sequential_ids``.
    """
    full, dealt = F.col("full_name"), [F.col("student_id").cast("int").alias("id")] if "student_id" in upload.columns else []
    rows = upload.filter(full.isNotNull()).select(
        *dealt,
        text.first_name(full).alias("first_name"),
        text.last_name(full).alias("last_name"),
        F.lit("F").alias("gender"),
        "caste",
        F.col("annual_family_income").alias("annual_family_income_inr"),
        audit.stamp().alias("inserted_at"),
        audit.stamp().alias("updated_at"),
    )
    return aligned(rows, "student_details")


def fill_emails(students: DataFrame, domain: str) -> DataFrame:
    """Students without an e-mail get one made of their id."""
    return students.withColumn("email", F.coalesce("email", text.synthetic_email(F.col("id"), domain)))


def onboard_registrations(upload: DataFrame, students: DataFrame, audit: Audit = Audit()) -> DataFrame:
    ids = students.select(F.col("id").alias("student_id"))
    rows = upload.withColumn("student_id", F.col("student_id").cast("int")).join(ids, "student_id").select(
        "student_id",
        "assigned_through",
        F.col("registration_date").try_cast("date").alias("registration_date"),
        jsondoc.build_object(currently_pursuing_year=F.col("currently_pursuing_year")).alias("form_details"),
        audit.stamp().alias("inserted_at"),
        audit.stamp().alias("updated_at"),
    )
    return aligned(rows, "student_registration_details").drop("id")


def onboard_education(
    upload: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    subjects: DataFrame,
    colleges: DataFrame,
    locations: DataFrame,
    universities: DataFrame,
    as_of: dt.date | None = None,
    audit: Audit = Audit(),
) -> DataFrame:
    """One education row per student, course and place, with the array of its subjects."""
    ids = students.select(F.col("id").alias("student_id"))
    rows = upload.withColumn("student_id", F.col("student_id").cast("int")).join(ids, "student_id")
    places = locations.select(
        "location_id",
        F.col("district").alias("_district"),
        F.col("state_union_territory").alias("_state"),
        F.col("city_category").alias("_city"),
    )
    # Look-ups that hold per student come before the rows multiply by subject.
    for lookup, pairs in (
        (courses.select("course_id", "display_name", "course_duration"), [("currently_pursuing_degree", "display_name")]),
        (colleges, [("college_name", "standard_college_names")]),
        (places, [("district", "_district"), ("state_union_territory", "_state"), ("city_category", "_city")]),
        (universities, [("university_name", "standard_university_names")]),
    ):
        rows = normalised_join(rows, broadcast_if_small(lookup), pairs, "left")
    # Equal rows make one education row, so they are one before they multiply.
    wanted = ["student_id", "course_id", "college_id", "university_id", "location_id", "currently_pursuing_year", "course_duration"]
    rows = unnest_text(rows.select(*wanted, "subject_area").distinct(), "subject_area", "_subject")
    rows = normalised_join(
        rows, broadcast_if_small(subjects.select(F.col("id").alias("_subject_id"), "sub_field")), [("_subject", "sub_field")], "left"
    )
    grouped = rows.groupBy(*wanted).agg(distinct_array(F.col("_subject_id")).alias("subject_id"))
    year = numbers.year_of_study(F.col("currently_pursuing_year"), F.col("course_duration"))
    out = grouped.select(
        "student_id",
        F.col("course_id").alias("education_course_id"),
        "subject_id",
        "college_id",
        "university_id",
        F.col("location_id").alias("college_location_id"),
        dates.start_year(year, as_of).alias("start_year"),
        dates.end_year(year, F.col("course_duration"), as_of).alias("end_year"),
        audit.stamp().alias("inserted_at"),
        audit.stamp().alias("updated_at"),
    )
    return aligned(out, "student_education").drop("id")
