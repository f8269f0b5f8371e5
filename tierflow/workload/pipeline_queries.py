"""One query per pipeline, on driver tables in learning-programme shape."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.merge import Audit
from ..plans import conform, enrich, landing, repair, report
from ..session import stored
from ..sources.csv_files import SEQ
from . import shapes as s
from .registry import Tables, query
from .shapes import with_shapes

_NOW = Audit(now=dt.datetime(2024, 3, 1, 9, 30))
_PROFILE = ", ".join(f"p.{c}" for c in enrich.PROFILE_COLUMNS)
_AS_OF = dt.date(2025, 7, 1)


# --- Reporting ----------------------------------------------------------------------------------

_RATES_SQL = """
       total AS total_submissions, greatest(total - 1, 0) AS resubmissions_count,
       CASE WHEN total > 1 THEN CAST(round(CAST((total - 1) * 100 AS DECIMAL(18,6)) / total, 2) AS DOUBLE) ELSE 0 END AS resubmission_rate,
       accepted AS accepted_count, CAST(round(CAST(accepted * 100 AS DECIMAL(18,6)) / nullif(total, 0), 2) AS DOUBLE) AS acceptance_rate,
       rejected AS rejected_count, CAST(round(CAST(rejected * 100 AS DECIMAL(18,6)) / nullif(total, 0), 2) AS DOUBLE) AS rejection_rate,
       last_at AS last_submission_date"""


def _doubles(df):
    return df.withColumns(
        {c: F.col(c).cast("double") for c in ("resubmission_rate", "acceptance_rate", "rejection_rate")}
    )


def submissions(t: Tables):
    """Line items as submissions of suppliers for parts."""
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_suppkey").cast("int").alias("student_id"), F.col("l_partkey").cast("int").alias("resource_id"),
        F.concat(F.lit("Item "), F.col("l_partkey")).alias("title"),
        F.concat(F.lit("INC00"), F.col("l_linenumber")).alias("cohort_code"), F.col("l_linestatus").alias("college_name"),
        F.when(flag == "N", "under review").when(flag == "R", "reviewed").otherwise("rejected").alias("submission_status"),
        F.col("l_shipdate").alias("submitted_at"), F.col("l_discount").cast("string").alias("course_name"),
    )


_COUNTS_SQL = """
SELECT CAST(l_suppkey AS INTEGER) AS student_id, CAST(l_partkey AS INTEGER) AS resource_id, 'Item ' || l_partkey AS title,
       'INC00' || l_linenumber AS cohort_code, l_linestatus AS college_name, {extra}
       count(*) FILTER (WHERE l_returnflag = 'N') AS total, count(*) FILTER (WHERE l_returnflag = 'R') AS accepted,
       count(*) FILTER (WHERE l_returnflag = 'A') AS rejected, max(l_shipdate) FILTER (WHERE l_returnflag = 'N') AS last_at
FROM lineitem GROUP BY ALL"""


@query("resubmission_overview", with_shapes(["students"], f"""
SELECT c.student_id, c.resource_id, c.title, c.cohort_code, c.college_name, s.email AS email_id, {_RATES_SQL}
FROM ({_COUNTS_SQL.format(extra='')}) c LEFT JOIN students s ON s.id = c.student_id"""))
def resubmission_overview(t: Tables):
    return _doubles(report.resubmission_overview(submissions(t), s.students(t)))


@query("resubmission_rebuild", with_shapes(["students"], f"""
SELECT c.student_id, c.resource_id, c.title, c.cohort_code, c.college_name,
       (SELECT min(email) FROM students s WHERE s.id = c.student_id) AS email_id, {_RATES_SQL}
FROM ({_COUNTS_SQL.format(extra='l_discount,')}) c"""))
def resubmission_rebuild(t: Tables):
    return _doubles(report.resubmission_overview(submissions(t), s.students(t), by_course=True))


# --- Enriched -----------------------------------------------------------------------------------


def subject_rows(t: Tables):
    return enrich.subject_profile(s.education(t), s.subjects(t), s.courses(t), s.colleges(t), s.universities(t))


def profile(t: Tables, sheet_join: str = "email"):
    return enrich.student_profile(
        s.people(t), s.sheet(t), s.locations(t), s.registrations(t), subject_rows(t), sheet_join
    )


@query("enriched_profile", with_shapes(["subject_lists", "study_places"], """
SELECT CAST(a.student_id AS INTEGER) AS student_id, a.course_id AS education_course_id, a.education_category, a.subject_areas,
       a.sub_fields_list, n.course_name, n.college_name, n.university_name
FROM subject_lists a JOIN study_places n ON n.student_id = a.student_id AND n.course_id = a.course_id"""))
def enriched_profile(t: Tables):
    return subject_rows(t)


@query("demography", with_shapes(["profile"], f"""
SELECT p.student_id, p.email, p.caste, p.annual_family_income_inr, p."Incubator_Batch", {_PROFILE} FROM profile p"""))
def demography(t: Tables):
    return enrich.student_demography(profile(t))


@query("demography_by_id", with_shapes(["people", "sheet", "locations", "registrations", "subject_lists", "study_places"], """
SELECT p.id AS student_id, p.email, p.caste, p.annual_family_income_inr, g."Incubator_Batch", r.form_details,
       l.state_union_territory, l.district, l.country, l.city_category, a.education_category, a.subject_areas,
       a.sub_fields_list, n.course_name, n.college_name, n.university_name
FROM people p
LEFT JOIN sheet g ON CAST(g."Student_id" AS INTEGER) = p.id
LEFT JOIN locations l ON l.location_id = p.location_id
LEFT JOIN registrations r ON r.student_id = p.id
LEFT JOIN subject_lists a ON a.student_id = p.id
LEFT JOIN study_places n ON n.student_id = p.id AND n.course_id = a.course_id"""))
def demography_by_id(t: Tables):
    return enrich.student_demography(profile(t, "id_left"))


@query("quiz_enriched", with_shapes(["profile", "quizzes", "resources"], f"""
SELECT q.id, q.resource_id, q.student_id, p."Incubator_Batch", r.category, r.title, q.cohort_code, q.marks, q.max_marks, {_PROFILE}
FROM quizzes q JOIN resources r ON r.id = q.resource_id JOIN profile p ON p.student_id = q.student_id"""))
def quiz_enriched(t: Tables):
    return enrich.final_quiz(s.quizzes(t), s.resources(t), profile(t))


@query("assignment_enriched", with_shapes(["profile", "assignments", "resources"], f"""
SELECT a.student_id, p."Incubator_Batch", a.resource_id, r.category, r.title, a.cohort_code, a.submission_status, a.submitted_at, {_PROFILE}
FROM assignments a JOIN resources r ON r.id = a.resource_id JOIN profile p ON p.student_id = a.student_id"""))
def assignment_enriched(t: Tables):
    return enrich.final_assignment(s.assignments(t), s.resources(t), profile(t))


@query("attendance", with_shapes(["profile", "attendance", "live_sessions", "cohorts"], f"""
SELECT dayname(f.attended_on) AS weekday_name, f.student_id, f.session_id, p."Incubator_Batch" AS incubator_batch, f.title, f.code,
       f.conducted_on, f.attended_on, f.duration_in_sec, {_PROFILE}
FROM (SELECT a.student_id, a.session_id, l.session_name AS title, l.code, CAST(l.conducted_on AS DATE) AS conducted_on,
             a.duration_in_sec, coalesce(a.watched_on, CAST(l.conducted_on AS DATE)) AS attended_on
      FROM attendance a
      JOIN (SELECT l.* FROM live_sessions l JOIN cohorts c ON CAST(l.conducted_on AS DATE) BETWEEN c.start_date AND c.end_date) l
      ON l.id = a.session_id) f
JOIN profile p ON p.student_id = f.student_id"""))
def attendance(t: Tables):
    held = enrich.sessions_in_cohorts(s.live_sessions(t), s.cohorts(t))
    return enrich.daily_weekly_attendance(s.attendance(t), held, profile(t))


@query("sessions_one_cohort", with_shapes(["live_sessions", "cohorts"], """
SELECT DISTINCT l.id AS session_id, l.session_name AS title, l.code, CAST(l.conducted_on AS DATE) AS conducted_on
FROM live_sessions l JOIN cohorts c ON CAST(l.conducted_on AS DATE) BETWEEN c.start_date AND c.end_date
WHERE c.cohort_code IN ('INC007', 'INC008')"""))
def sessions_one_cohort(t: Tables):
    return enrich.sessions_in_cohorts(s.live_sessions(t), s.cohorts(t), ["INC007", "INC008"], distinct_sessions=True)


@query("registration_overview", with_shapes(["profile", "people", "registrations"], f"""
SELECT p.student_id, p.email, p.caste, p.annual_family_income_inr, p."Incubator_Batch", {_PROFILE}, s.phone,
       CAST(r.registration_date AS TIMESTAMP) AS registration_date
FROM profile p JOIN people s ON s.id = p.student_id JOIN registrations r ON r.student_id = s.id"""))
def registration_overview(t: Tables):
    return report.registration_overview(enrich.student_demography(profile(t)), s.people(t), s.registrations(t))


# The last row in column order of each key: what a merge keeps of a student with two courses.
@query("demography_merged", with_shapes(["profile"], f"""
SELECT student_id, email, "Incubator_Batch", course_name, subject_areas
FROM (SELECT p.*, row_number() OVER (PARTITION BY email ORDER BY student_id DESC, email DESC, caste DESC, annual_family_income_inr DESC,
             "Incubator_Batch" DESC, {', '.join(c + ' DESC NULLS LAST' for c in enrich.PROFILE_COLUMNS)}) AS rn FROM profile p) WHERE rn = 1"""))
def demography_merged(t: Tables):
    rows = stored(enrich.student_demography(profile(t)), "demography")  # as a run does: the profile is made once
    target = rows.filter("course_name = 'Course F'").withColumn("subject_areas", F.lit("old"))
    known = enrich.merged("student_demography", target, rows, target_order=rows.columns)
    return known.select("student_id", "email", "Incubator_Batch", "course_name", "subject_areas")


# --- Conformed ----------------------------------------------------------------------------------


@query("conform_assignments", with_shapes(["assignment_feed", "students", "memberships", "resources"], """
SELECT s.id AS student_id, r.id AS resource_id, CAST(NULL AS INTEGER) AS mentor_id, m.cohort_code, a.submission_status,
       CAST(CASE a.submission_status WHEN 'under review' THEN 30 WHEN 'reviewed' THEN 100 ELSE 80 END AS DOUBLE) AS marks_pct,
       a.feedback_comments, CAST(replace(trim(a.submitted_at), 'Z', '') AS TIMESTAMP) AS submitted_at, a.assignment_file
FROM assignment_feed a JOIN students s ON s.email = a.email JOIN memberships m ON m.student_id = s.id
JOIN resources r ON r.title = a.assignment_name AND r.category = 'Assignment'
WHERE trim(a.submitted_at) NOT IN ('', 'NaN')"""))
def conform_assignments(t: Tables):
    rows = conform.conform_assignments(s.assignment_feed(t), s.students(t), s.memberships(t), s.resources(t))
    return rows.withColumn("marks_pct", F.col("marks_pct").cast("double"))


@query("assignments_rejected", with_shapes(["assignment_feed"], """
SELECT email AS "Email", feedback_comments, submitted_at, concat_ws(',', CASE WHEN r.title IS NULL THEN 'unknown title' END,
         CASE WHEN trim(submitted_at) IN ('', 'NaN') THEN 'blank timestamp' END) AS reasons
FROM assignment_feed a
LEFT JOIN (SELECT 'Item ' || p_partkey AS title FROM part WHERE p_size <= 20) r ON r.title = a.assignment_name
WHERE r.title IS NULL OR trim(submitted_at) IN ('', 'NaN')"""))
def assignments_rejected(t: Tables):
    bad = conform.rejected_assignments(s.assignment_feed(t), s.students(t), s.memberships(t), s.resources(t))
    return bad.select("Email", "feedback_comments", "submitted_at", F.array_join("reasons", ",").alias("reasons"))


@query("conform_sessions", with_shapes(["session_feed", "people", "person_cohorts", "live_sessions"], """
SELECT s.id AS student_id, l.id AS session_id, CAST(round_even(CAST(f.duration_in_secs AS DOUBLE), 0) AS INTEGER) AS duration_in_sec,
       CAST(f.watched_on AS DATE) AS watched_on
FROM session_feed f JOIN people s ON s.email = f.email JOIN person_cohorts m ON m.student_id = s.id
JOIN live_sessions l ON l.code = f.session_code AND l.cohort_code = m.cohort_code
WHERE f.session_code LIKE 'SUK%' OR f.session_code LIKE 'WS%' OR f.session_code LIKE 'MC%'"""))
def conform_sessions(t: Tables):
    feed = s.session_feed(t)
    return conform.conform_sessions(feed, s.people(t), s.person_cohorts(t), s.live_sessions(t))


@query("conform_quizzes", with_shapes(["quiz_feed", "students", "memberships", "resources"], """
SELECT s.id AS student_id, r.id AS resource_id, m.cohort_code, CAST(round_even(CAST(q.value AS DOUBLE), 0) AS INTEGER) AS marks,
       100 AS max_marks, CAST(NULL AS INTEGER) AS reattempts, CAST(NULL AS TIMESTAMP) AS attempted_at
FROM (SELECT * FROM quiz_feed WHERE value <> 'absent') q JOIN students s ON s.email = q.user_id JOIN memberships m ON m.student_id = s.id
JOIN resources r ON r.title = q.data_fields AND r.category = 'Quiz'"""))
def conform_quizzes(t: Tables):
    return conform.conform_quizzes(s.quiz_feed(t), s.students(t), s.memberships(t), s.resources(t))


@query("conform_pre_recorded", with_shapes(["session_feed", "people", "person_cohorts", "resources"], """
SELECT s.id AS student_id, r.id AS resource_id, m.cohort_code,
       CAST(round_even(CAST(f.duration_in_secs AS DOUBLE), 0) AS INTEGER) AS watchtime_in_sec,
       CAST(CAST(f.watched_on AS DATE) AS TIMESTAMP) AS watched_at
FROM session_feed f JOIN people s ON s.email = f.email JOIN person_cohorts m ON m.student_id = s.id
JOIN resources r ON r.title = f.session_code WHERE f.session_code LIKE 'VID%'"""))
def conform_pre_recorded(t: Tables):
    return conform.conform_pre_recorded(s.session_feed(t), s.people(t), s.person_cohorts(t), s.resources(t))


_NO_COHORT = "CASE WHEN NOT EXISTS (SELECT 1 FROM {people} s JOIN {cohorts} m ON m.student_id = s.id WHERE s.email = {email}) THEN 'unknown e-mail or no cohort' END"


@query("sessions_rejected", with_shapes(["session_feed", "people", "person_cohorts", "live_sessions"], f"""
SELECT * FROM (
    SELECT f.email AS "Email", f.session_code AS "Session_Code", array_to_string(list_filter([
        {_NO_COHORT.format(people="people", cohorts="person_cohorts", email="f.email")},
        CASE WHEN NOT EXISTS (SELECT 1 FROM live_sessions l WHERE l.code = f.session_code) THEN 'unknown session' END,
        CASE WHEN NOT EXISTS (SELECT 1 FROM people s JOIN person_cohorts m ON m.student_id = s.id JOIN live_sessions l ON l.cohort_code = m.cohort_code
            WHERE s.email = f.email AND l.code = f.session_code) THEN 'session of no cohort of the student' END,
        CASE WHEN NOT regexp_matches(f.session_code, '^(SUK|WS|MC)') THEN 'unknown kind of session' END,
        CASE WHEN f.duration_in_secs IS NOT NULL AND TRY_CAST(f.duration_in_secs AS DOUBLE) IS NULL THEN 'unreadable duration' END],
        lambda x: x IS NOT NULL), ',') AS reasons
    FROM session_feed f WHERE f.session_code NOT LIKE 'VID%'
) WHERE reasons <> ''"""))
def sessions_rejected(t: Tables):
    bad = conform.rejected_sessions(s.session_feed(t), s.people(t), s.person_cohorts(t), s.live_sessions(t))
    return bad.select("Email", "Session_Code", F.array_join("reasons", ",").alias("reasons"))


@query("quizzes_rejected", with_shapes(["quiz_feed", "students", "memberships", "resources"], f"""
SELECT * FROM (
    SELECT q.user_id, q.data_fields, q.value, array_to_string(list_filter([
        {_NO_COHORT.format(people="students", cohorts="memberships", email="q.user_id")},
        CASE WHEN NOT EXISTS (SELECT 1 FROM resources r WHERE r.title = q.data_fields AND r.category = 'Quiz') THEN 'unknown title' END,
        CASE WHEN q.value = 'absent' THEN 'unreadable mark' END], lambda x: x IS NOT NULL), ',') AS reasons
    FROM quiz_feed q
) WHERE reasons <> ''"""))
def quizzes_rejected(t: Tables):
    bad = conform.rejected_quizzes(s.quiz_feed(t), s.students(t), s.memberships(t), s.resources(t))
    return bad.select("user_id", "data_fields", "value", F.array_join("reasons", ",").alias("reasons"))


@query("memberships_rejected", with_shapes(["people", "cohorts"], """
SELECT * FROM (
    SELECT o_custkey AS student_id, 'INC00' || left(o_orderpriority, 1) AS cohort_code, array_to_string(list_filter([
        CASE WHEN o_custkey NOT IN (SELECT id FROM people WHERE id % 3 <> 0) THEN 'unknown student' END,
        CASE WHEN 'INC00' || left(o_orderpriority, 1) NOT IN (SELECT cohort_code FROM cohorts WHERE cohort_code <> 'INC002') THEN 'unknown cohort' END],
        lambda x: x IS NOT NULL), ',') AS reasons
    FROM orders
) WHERE reasons <> ''"""))
def memberships_rejected(t: Tables):
    bad = conform.rejected_memberships(_upload(t), s.people(t).filter("id % 3 <> 0"), s.cohorts(t).filter("cohort_code <> 'INC002'"))
    return bad.select("student_id", "cohort_code", F.array_join("reasons", ",").alias("reasons"))


def _upload(t: Tables):
    return t.orders.selectExpr(
        "o_custkey as student_id", "concat('INC00', left(o_orderpriority, 1)) as cohort_code",
        "case when o_totalprice > 400000 then 'Regional STUDENT LEADER' else o_orderstatus end as student_role",
    )


@query("conform_memberships", with_shapes(["people", "cohorts"], """
SELECT right(CAST(extract(year FROM c.start_date) AS VARCHAR), 2) || c.cohort_code || lpad(CAST(p.id AS VARCHAR), 7, '0') AS student_code,
       p.id AS student_id, c.cohort_code, o.o_totalprice > 400000 AS is_leader, CAST(NULL AS DATE) AS cohort_enroll_date
FROM orders o JOIN people p ON p.id = o.o_custkey JOIN cohorts c ON c.cohort_code = 'INC00' || left(o.o_orderpriority, 1)"""))
def conform_memberships(t: Tables):
    return conform.conform_memberships(_upload(t), s.people(t), s.cohorts(t))


@query("memberships_merged", """
SELECT '24' || cohort_code || lpad(CAST(student_id AS VARCHAR), 7, '0') AS student_code, student_id, cohort_code, bool_or(leader) AS is_leader
FROM (SELECT CAST(o_custkey AS INTEGER) AS student_id, 'INC00' || left(o_orderpriority, 1) AS cohort_code, o_totalprice > 400000 AS leader FROM orders)
GROUP BY ALL""")
def memberships_merged(t: Tables):
    rows = conform.conform_memberships(_upload(t), s.people(t), s.cohorts(t))
    target = rows.filter("is_leader").withColumn("is_leader", F.lit(False)).distinct()
    # Leaders sort after others, so one leading role makes a leader.
    return conform.merged("student_cohort", target, rows).drop("cohort_enroll_date")


_COURSE_COHORTS_SQL = """(SELECT 'BUILDING' AS cohort_name, 'INC001' AS cohort_code UNION ALL SELECT 'HOUSEHOLD', 'INC002')"""


def _course_cohorts(t: Tables):
    """The first two market segments by name as cohorts called after a course."""
    names = t.customer.select(F.col("c_mktsegment").alias("cohort_name")).distinct()
    code = F.when(F.col("cohort_name") == "BUILDING", "INC001").when(F.col("cohort_name") == "HOUSEHOLD", "INC002")
    start = F.lit(dt.date(2023, 5, 1)).alias("start_date")
    return names.select("cohort_name", code.alias("cohort_code"), start).filter("cohort_code is not null")


@query("backfill_quizzes", with_shapes(["quiz_feed", "resources", "sheet"], f"""
SELECT CAST(g."Student_id" AS INTEGER) AS student_id, r.id AS resource_id, c.cohort_code,
       CAST(round_even(CAST(q.value AS DOUBLE), 0) AS INTEGER) AS marks, 100 AS max_marks, CAST(NULL AS INTEGER) AS reattempts,
       CAST(NULL AS TIMESTAMP) AS attempted_at
FROM (SELECT * FROM quiz_feed WHERE value <> 'absent') q JOIN sheet g ON replace(g."Email", 'customer', 'supplier') = q.user_id
JOIN {_COURSE_COHORTS_SQL} c ON c.cohort_name = g."Incubator_Course_Name"
JOIN resources r ON r.title = q.data_fields AND r.category = 'Quiz' WHERE g."Incubator_Batch" = 'Incubator 7.0'"""))
def backfill_quizzes(t: Tables):
    sheet = s.sheet(t).withColumn("Email", F.replace("Email", F.lit("customer"), F.lit("supplier")))
    return conform.backfill_quizzes(s.quiz_feed(t), sheet, _course_cohorts(t), s.resources(t), "Incubator 7.0")


@query("backfill_assignments", with_shapes(["assignment_feed", "resources", "sheet"], f"""
SELECT CAST(g."Student_id" AS INTEGER) AS student_id, r.id AS resource_id, CAST(NULL AS INTEGER) AS mentor_id, c.cohort_code, a.submission_status,
       CAST(CASE a.submission_status WHEN 'under review' THEN 30 WHEN 'reviewed' THEN 100 ELSE 80 END AS DOUBLE) AS marks_pct,
       a.feedback_comments, CAST(replace(a.submitted_at, 'Z', '') AS TIMESTAMP) AS submitted_at, a.assignment_file
FROM (SELECT * FROM assignment_feed WHERE trim(submitted_at) NOT IN ('', 'NaN')) a
JOIN sheet g ON replace(g."Email", 'customer', 'supplier') = a.email
JOIN {_COURSE_COHORTS_SQL} c ON c.cohort_name = g."Incubator_Course_Name"
JOIN resources r ON r.title = a.assignment_name AND r.category = 'Assignment'"""))
def backfill_assignments(t: Tables):
    sheet = s.sheet(t).withColumn("Email", F.replace("Email", F.lit("customer"), F.lit("supplier")))
    rows = conform.backfill_assignments(s.assignment_feed(t), sheet, _course_cohorts(t), s.resources(t))
    return rows.withColumn("marks_pct", F.col("marks_pct").cast("double"))


@query("backfill_sessions", with_shapes(["session_feed", "sheet", "live_sessions", "person_cohorts"], """
SELECT CAST(g."Student_id" AS INTEGER) AS student_id, l.id AS session_id,
       CAST(round_even(CAST(f.duration_in_secs AS DOUBLE), 0) AS INTEGER) AS duration_in_sec, CAST(NULL AS DATE) AS watched_on
FROM session_feed f JOIN sheet g ON g."Email" = f.email
JOIN (SELECT DISTINCT c_mktsegment AS cohort_name, 'INC' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS cohort_code FROM customer) c
  ON c.cohort_name = g."Incubator_Course_Name"
JOIN live_sessions l ON l.code = f.session_code AND l.cohort_code = c.cohort_code
WHERE f.session_code LIKE 'SUK%' OR f.session_code LIKE 'WS%' OR f.session_code LIKE 'MC%'"""))
def backfill_sessions(t: Tables):
    named = t.customer.selectExpr(
        "c_mktsegment as cohort_name", "concat('INC', lpad(cast(c_nationkey as string), 3, '0')) as cohort_code"
    ).distinct()
    return conform.backfill_sessions(s.session_feed(t), s.sheet(t), named, s.live_sessions(t))


@query("backfill_pre_recorded", with_shapes(["session_feed", "sheet", "resources"], f"""
SELECT CAST(g."Student_id" AS INTEGER) AS student_id, r.id AS resource_id, c.cohort_code,
       CAST(round_even(CAST(f.duration_in_secs AS DOUBLE), 0) AS INTEGER) AS watchtime_in_sec, CAST(NULL AS TIMESTAMP) AS watched_at
FROM session_feed f JOIN sheet g ON g."Email" = f.email JOIN {_COURSE_COHORTS_SQL} c ON c.cohort_name = g."Incubator_Course_Name"
JOIN resources r ON r.title = f.session_code WHERE f.session_code LIKE 'VID%'"""))
def backfill_pre_recorded(t: Tables):
    return conform.backfill_pre_recorded(s.session_feed(t), s.sheet(t), _course_cohorts(t), s.resources(t))


@query("backfill_memberships", with_shapes(["people", "sheet"], f"""
SELECT '23' || c.cohort_code || lpad(CAST(p.id AS VARCHAR), 7, '0') AS student_code, p.id AS student_id, c.cohort_code,
       g."Student_Role" ILIKE '%student leader%' AS is_leader, CAST(NULL AS DATE) AS cohort_enroll_date
FROM sheet g JOIN people p ON p.email = g."Email" JOIN {_COURSE_COHORTS_SQL} c ON c.cohort_name = g."Incubator_Course_Name" """))
def backfill_memberships(t: Tables):
    return conform.backfill_memberships(s.sheet(t), s.people(t), _course_cohorts(t))


@query("conform_cohorts", """
SELECT p.code || right('000' || n_nationkey, 3) AS cohort_code, p.code AS program_code, n_nationkey AS cohort_number, n_name AS cohort_name,
       r_name AS type, DATE '2024-01-20' + n_nationkey AS start_date, DATE '2025-06-20' + n_nationkey AS end_date,
       DATE '2025-06-20' + n_nationkey >= DATE '2025-07-01' AS is_active
FROM nation JOIN region ON r_regionkey = n_regionkey
JOIN (VALUES (0, 'INC'), (1, 'ACC'), (2, 'STC')) p(k, code) ON p.k = n_regionkey""")
def conform_cohorts(t: Tables):
    def written(day: dt.date, pattern: str):
        return F.date_format(F.date_add(F.lit(day), F.col("n_nationkey")), pattern)

    details = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("Cohort number"), F.col("n_name").alias("Cohort Name"),
        F.col("r_name").alias("Type"), written(dt.date(2024, 1, 20), "dd/MM/yyyy").alias("Start Date"),
        written(dt.date(2025, 6, 20), "dd-MM-yyyy").alias("End Date"),
        F.when(F.col("n_regionkey") == 0, "INCUBATOR").when(F.col("n_regionkey") == 1, "accelerator")
        .when(F.col("n_regionkey") == 2, "Stem champion").otherwise("Other").alias("Program Name"),
    )
    return conform.conform_cohorts(details, conform.programs(t.spark), _AS_OF)


@query("conform_live_sessions", with_shapes(["cohorts"], """
SELECT c.cohort_code, p_name AS session_name, p_type AS type, 'WS' || p_partkey AS code, p_size * 60 AS duration_in_sec,
       CAST(DATE '2024-02-01' + p_size AS TIMESTAMP) AS conducted_on
FROM part JOIN cohorts c ON lower(c.cohort_name) = 'nation_' || (p_partkey % 40)"""))
def conform_live_sessions(t: Tables):
    details = t.part.select(
        F.col("p_name").alias("Session_Name"), F.col("p_type").alias("Type"),
        F.concat(F.lit("WS"), F.col("p_partkey")).alias("Session Code"),
        F.concat(F.lit(" nation_"), F.col("p_partkey") % 40).alias("Cohort_Name"),
        (F.col("p_size") * 60).cast("string").alias("Duration"),
        F.date_format(F.date_add(F.lit(dt.date(2024, 2, 1)), F.col("p_size")), "dd/MM/yy").alias("Conducted_On"),
    )
    return conform.conform_live_sessions(details, s.cohorts(t))


@query("conform_resources", """
SELECT p_type AS category, p_name AS title, p_brand AS description, CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS resource_link, p_size > 25 AS is_video_resource, p_size AS total_duration FROM part""")
def conform_resources(t: Tables):
    return conform.conform_resources(t.part.select(
        F.col("p_type").alias("Category"), F.col("p_name").alias("Title"), F.col("p_brand").alias("Content Name"),
        F.when(F.col("p_size") > 25, "Yes").otherwise("no").alias("Is_Video"), F.col("p_size").cast("string").alias("Time"),
    ))


@query("onboard_students", """
SELECT CAST(NULL AS INTEGER) AS id, CAST(NULL AS VARCHAR) AS email, trim(split_part(c_name, '#', 1)) AS first_name,
       split_part(c_name, '#', 2) AS last_name, 'F' AS gender, c_mktsegment AS caste,
       CAST(c_nationkey AS VARCHAR) AS annual_family_income_inr, TIMESTAMP '2024-03-01 09:30:00' AS inserted_at
FROM customer""")
def onboard_students(t: Tables):
    upload = t.customer.select(
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("full_name"), F.col("c_mktsegment").alias("caste"),
        F.col("c_nationkey").cast("string").alias("annual_family_income"),
    )
    rows = conform.onboard_students(upload, _NOW)
    return rows.select("id", "email", "first_name", "last_name", "gender", "caste", "annual_family_income_inr", "inserted_at")


@query("onboard_registrations", """
SELECT CAST(o_custkey AS INTEGER) AS student_id, o_orderpriority AS assigned_through, CAST(o_orderdate AS DATE) AS registration_date,
       CASE WHEN o_orderstatus = 'P' THEN '{"currently_pursuing_year":null}' ELSE '{"currently_pursuing_year":"' || o_orderstatus || '"}' END AS form_details
FROM orders JOIN customer ON c_custkey = o_custkey""")
def onboard_registrations(t: Tables):
    upload = t.orders.select(
        F.col("o_custkey").cast("string").alias("student_id"), F.col("o_orderpriority").alias("assigned_through"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("registration_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("currently_pursuing_year"),
    )
    rows = conform.onboard_registrations(upload, s.people(t), _NOW)
    return rows.select("student_id", "assigned_through", "registration_date", "form_details")


@query("onboard_education", """
WITH upload AS (SELECT CAST(o_custkey AS INTEGER) AS student_id, o_orderstatus AS degree, p_name, p_brand,
                       CASE WHEN p_size < 10 THEN 'Final' ELSE (p_size % 7) || 'th Year' END AS year_label, p_size % 30 AS place
                FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
parts AS (SELECT *, unnest(string_split(p_name, ' ')) AS word FROM upload),
rows AS (SELECT u.student_id, c.course_id, c.duration, u.year_label, n.n_nationkey AS location_id, r.r_regionkey AS university_id,
                CAST(s.s_suppkey AS INTEGER) AS college_id, w.id AS subject_id
         FROM parts u
         LEFT JOIN (VALUES (70, 'F', 3), (79, 'O', 4)) c(course_id, name, duration) ON c.name = u.degree
         LEFT JOIN (SELECT DISTINCT ascii(p_name) AS id, split_part(p_name, ' ', 1) AS word FROM part) w ON w.word = u.word
         LEFT JOIN supplier s ON 'Brand#' || s.s_suppkey = u.p_brand
         LEFT JOIN nation n ON n.n_nationkey = u.place
         LEFT JOIN region r ON r.r_regionkey = u.place)
SELECT student_id, course_id AS education_course_id,
       list_concat(coalesce(list(DISTINCT subject_id ORDER BY subject_id) FILTER (WHERE subject_id IS NOT NULL), []),
                   CASE WHEN bool_or(subject_id IS NULL) THEN [CAST(NULL AS INTEGER)] ELSE [] END) AS subject_id,
       college_id, university_id, location_id AS college_location_id,
       CAST(2025 - (least(coalesce(CAST(nullif(regexp_replace(year_label, '[^0-9]', '', 'g'), '') AS INTEGER), 1), duration) - 1) AS INTEGER) AS start_year,
       CAST(2025 - (least(coalesce(CAST(nullif(regexp_replace(year_label, '[^0-9]', '', 'g'), '') AS INTEGER), 1), duration) - 1) + duration AS INTEGER) AS end_year
FROM rows GROUP BY student_id, course_id, college_id, university_id, location_id, year_label, duration""")
def onboard_education(t: Tables):
    items = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(
        t.part, F.col("p_partkey") == F.col("l_partkey")
    )
    place = F.col("p_size") % 30
    upload = items.select(
        F.col("o_custkey").cast("string").alias("student_id"),
        F.concat(F.lit(" course "), F.lower("o_orderstatus")).alias("currently_pursuing_degree"),
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("subject_area"),
        F.concat(F.upper("p_brand"), F.lit(" ")).alias("college_name"),
        F.when(F.col("p_size") < 10, "Final").otherwise(F.concat(F.col("p_size") % 7, F.lit("th Year"))).alias("currently_pursuing_year"),
        F.concat(F.lit("D"), place).alias("district"), F.concat(F.lit("S"), place).alias("state_union_territory"),
        F.lit("TIER").alias("city_category"), F.concat(F.lit("u"), place).alias("university_name"),
    )
    courses = t.orders.select("o_orderstatus").distinct().filter("o_orderstatus <> 'P'").selectExpr(
        "ascii(o_orderstatus) as course_id", "concat('Course ', o_orderstatus) as display_name",
        "case o_orderstatus when 'F' then 3 else 4 end as course_duration",
    )
    subjects = t.part.selectExpr("ascii(p_name) as id", "upper(split_part(p_name, ' ', 1)) as sub_field").distinct()
    colleges = t.supplier.selectExpr(
        "cast(s_suppkey as int) as college_id", "concat('Brand#', s_suppkey) as standard_college_names"
    )
    places = t.nation.selectExpr(
        "n_nationkey as location_id", "concat('d', n_nationkey) as district",
        "concat('s', n_nationkey) as state_union_territory", "'tier ' as city_category",
    )
    universities = t.region.selectExpr("r_regionkey as university_id", "concat('U', r_regionkey) as standard_university_names")
    rows = conform.onboard_education(
        upload, s.people(t), courses, subjects, colleges, places, universities, _AS_OF, _NOW
    )
    return rows.drop("interest_subject_id", "inserted_at", "updated_at")


# --- Landing ------------------------------------------------------------------------------------


@query("live_sessions_merged", """
WITH rows AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'INC' ELSE 'ACC' END || lpad(CAST(p_size AS VARCHAR), 3, '0') AS cohort_code,
                     p_brand AS session_name, p_type AS type, 'WS' || (p_partkey % 50) AS code, p_partkey,
                     CAST(DATE '2024-01-01' + p_size AS TIMESTAMP) AS conducted_on FROM part)
SELECT cohort_code, arg_max(session_name, p_partkey) AS session_name, arg_max(type, p_partkey) AS type, code, 3600 AS duration_in_sec, conducted_on
FROM rows GROUP BY cohort_code, code, conducted_on""")
def live_sessions_merged(t: Tables):
    size = F.col("p_size")
    rows = t.part.select(
        F.concat(F.when(size % 2 == 0, "Incubator ").otherwise("Accelerator "), size, F.lit(".0")).alias("Batch"),
        F.col("p_brand").alias("Topic"), F.col("p_type").alias("Session Type"),
        F.concat(F.lit("WS"), F.col("p_partkey") % 50).alias("Session Code"),
        F.date_format(F.date_add(F.lit(dt.date(2024, 1, 1)), size), "d-MMM-yy").alias("Date"),
        F.col("p_partkey").alias(SEQ),
    )
    old = landing.live_sessions_from_csv(rows.filter("`Session Type` = 'ECONOMY'")).withColumn("session_name", F.lit("old"))
    columns = ["cohort_code", "session_name", "type", "code", "duration_in_sec", "conducted_on"]
    return landing.merge_live_sessions(old, rows, [SEQ], [SEQ]).select(*columns)


@query("feed_merged", """
SELECT l_suppkey || '@example.org' AS user_id, 'Item ' || l_partkey AS data_fields,
       arg_max(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), (l_orderkey, l_linenumber, l_shipdate)) AS value
FROM lineitem GROUP BY l_suppkey, l_partkey""")
def feed_merged(t: Tables):
    from ..sources.csv_files import Feed

    rows = t.lineitem.select(
        F.concat(F.col("l_suppkey"), F.lit("@example.org")).alias("user_id"),
        F.concat(F.lit("Item "), F.col("l_partkey")).alias("data_fields"),
        F.col("l_quantity").cast("int").cast("string").alias("value"),
        F.struct("l_orderkey", "l_linenumber", "l_shipdate").alias(SEQ),
    )
    first = landing.merge_feed(None, Feed("quiz", rows.filter(f"{SEQ}.l_linenumber < 4").withColumn("value", F.lit("0")), ()))
    return landing.merge_feed(first, Feed("quiz", rows, ()))


@query("stream_upsert", """
SELECT user_id, event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id, event_type""")
def stream_upsert(t: Tables):
    from ..session import scratch_path
    from ..streaming.landing import current_rows, ingest

    columns = ["user_id", "event_type", "ts", "event_id", "value"]
    stream = (
        t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    ).select(*columns)
    log, keys, order = scratch_path(t.spark, "log"), ["user_id", "event_type"], ["ts", "event_id"]
    ingest(stream, log, scratch_path(t.spark, "stream"), keys, order)
    return current_rows(t.spark.read.parquet(log), keys, order, arrival_wins=False).select(*columns)


@query("published_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def published_table(t: Tables):
    from ..session import scratch_path
    from ..sources.tables import LayerStore

    store = LayerStore(t.spark, scratch_path(t.spark, "store"))
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    store.publish("conformed", "orders", rows.filter("o_orderstatus = 'F'"))
    store.append("conformed", "orders", rows.filter("o_orderstatus <> 'F'"))
    current = store.read("conformed", "orders")
    store.publish("conformed", "orders", current.filter("o_orderstatus <> 'P'"), cluster_by=["o_orderkey"])
    return store.read("conformed", "orders", ["o_orderkey", "o_totalprice"])


# --- Repair -------------------------------------------------------------------------------------


@query("standardise_students", with_shapes(["people"], """
SELECT id, lower(trim('  ' || upper(email))) AS email, caste,
       CASE trim(annual_family_income_inr) WHEN 'Below 3 Lacs' THEN 'Below or Equal to 3 lacs per year (INR)'
            WHEN 'below 5 lacs' THEN 'Between 3-5 lacs (INR) per year' ELSE 'Above 5 lacs per year (INR)' END AS annual_family_income_inr
FROM (SELECT id, email, annual_family_income_inr, CASE WHEN caste = 'BUILDING' THEN 'Other' ELSE caste END AS caste FROM people)"""))
def standardise_students(t: Tables):
    dirty = s.people(t).select(
        "id", F.concat(F.lit("  "), F.upper("email")).alias("email"),
        F.when(F.col("caste") == "BUILDING", " OTHERS").otherwise(F.col("caste")).alias("caste"), "annual_family_income_inr",
    )
    return repair.standardise_students(repair.standardise_emails(dirty, "email"))


@query("standardise_forms", with_shapes(["registrations"], """
SELECT student_id, trim(json_extract_string(form_details, '$.currently_pursuing_year')) AS pursuing_year FROM registrations"""))
def standardise_forms(t: Tables):
    old = F.replace("form_details", F.lit("currently"), F.lit("Currently"))
    old = F.replace(F.replace(old, F.lit("pursuing"), F.lit("Pursuing")), F.lit("year"), F.lit("Year"))
    rows = repair.standardise_forms(repair.rename_form_keys(s.registrations(t).withColumn("form_details", old)))
    return rows.select("student_id", F.get_json_object("form_details", "$.currently_pursuing_year").alias("pursuing_year"))


@query("standardise_education", """
SELECT CAST(o_custkey AS INTEGER) AS student_id, CASE WHEN o_orderkey % 500 = 233 THEN 243 ELSE CAST(o_orderkey % 500 AS INTEGER) END AS college_id
FROM orders""")
def standardise_education(t: Tables):
    return repair.standardise_education(t.orders.selectExpr(
        "cast(o_custkey as int) as student_id", "cast(o_orderkey % 500 as int) as college_id"
    ))


@query("geography_repaired", with_shapes(["sheet"], """
SELECT * FROM (WITH trimmed AS (
  SELECT "Student_id", "Incubator_Batch",
         CASE WHEN "Incubator_Batch" IN ('Incubator 4.0', 'TS/TT 1.0', 'Incubator 6.0', 'Incubator 7.0') THEN trim("State_Union_Territory") ELSE "State_Union_Territory" END AS st,
         CASE WHEN "Incubator_Batch" IN ('Incubator 4.0', 'TS/TT 1.0', 'Incubator 6.0', 'Incubator 7.0') THEN trim("District") ELSE "District" END AS di
  FROM sheet),
named AS (
  SELECT *, CASE WHEN trim(st) = 'New Delhi' THEN 'Delhi' ELSE st END AS st2,
         CASE trim(di) WHEN 'Bengaluru Urban' THEN 'Bangalore Urban' WHEN 'Shimoga' THEN 'Shivamogga' ELSE di END AS di2 FROM trimmed)
SELECT "Student_id", "Incubator_Batch",
       CASE trim(di2) WHEN 'Agra' THEN 'Uttar Pradesh' WHEN 'Bangalore Urban' THEN 'Karnataka' WHEN 'New Delhi' THEN 'Delhi' ELSE st2 END AS "State_Union_Territory",
       di2 AS "District"
FROM named)"""))
def geography_repaired(t: Tables):
    columns = ["Student_id", "Incubator_Batch", "State_Union_Territory", "District"]
    return repair.repair_geography(s.sheet(t).select(*columns))


@query("timestamps_purged", """
SELECT event_id, ts, 'INC00' || (user_id % 10) AS cohort_code FROM events
WHERE NOT (regexp_matches(CAST(ts AS VARCHAR), '\\.[0-9]+') AND user_id % 10 IN (7, 8, 9)) AND event_type <> 'view'""")
def timestamps_purged(t: Tables):
    rows = t.events.select(
        "event_id", F.when(F.col("event_type") != "view", F.col("ts")).alias("submitted_at"), "event_type",
        F.concat(F.lit("INC00"), F.col("user_id") % 10).alias("cohort_code"),
    )
    codes = [f"INC00{i}" for i in range(10)]
    kept = repair.purge_blank_timestamps(rows, codes).kept
    kept = repair.purge_fractional_timestamps(kept, ["INC007", "INC008", "INC009"]).kept
    return kept.select("event_id", F.col("submitted_at").alias("ts"), "cohort_code")


@query("malformed_feed_removed", with_shapes(["assignment_feed"], """
SELECT email AS "Email", submitted_at, feedback_comments FROM assignment_feed
WHERE regexp_matches(submitted_at, 'T[0-9]{2}:[0-9]{2}:[0-9]{2}\\.[0-9]{3}Z')
  AND email IN (SELECT lower(s_name) || '@example.org' FROM supplier WHERE s_nationkey IN (7, 8, 9))"""))
def malformed_feed_removed(t: Tables):
    sheet = t.supplier.selectExpr(
        "concat(lower(s_name), '@example.org') as Email", "concat('Incubator ', s_nationkey, '.0') as Incubator_Batch"
    )
    batches = ["Incubator 7.0", "Incubator 8.0", "Incubator 9.0"]
    return repair.purge_malformed_feed(s.assignment_feed(t), sheet, batches).removed.select(
        "Email", "submitted_at", "feedback_comments"
    )


@query("duplicate_students", """
WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey || '@example.org' END AS email FROM orders)
SELECT id, email, email IS NOT NULL AND id NOT IN (SELECT max(id) FROM o WHERE email IS NOT NULL GROUP BY email)
       AND id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS deleted
FROM o""")
def duplicate_students(t: Tables):
    email = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.col("o_custkey"), F.lit("@example.org")))
    students = t.orders.select(F.col("o_orderkey").alias("id"), email.alias("email"))
    registrations = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("student_id"))
    done = repair.purge_duplicate_students(students, registrations)
    return done.kept.withColumn("deleted", F.lit(False)).unionByName(done.deleted.withColumn("deleted", F.lit(True)))


@query("students_removed", """
WITH ids AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 8000)
SELECT 'student_session' AS tbl, user_id AS id, user_id IN (SELECT id FROM ids) AS removed FROM events
UNION ALL SELECT 'student_assignment', o_custkey, o_custkey IN (SELECT id FROM ids) FROM orders
UNION ALL SELECT 'student_details', c_custkey, c_custkey IN (SELECT id FROM ids) FROM customer
UNION ALL SELECT 'general_information_sheet', c_custkey, c_custkey IN (SELECT id FROM ids) FROM customer""")
def students_removed(t: Tables):
    ids = t.customer.filter("c_acctbal > 8000").select(F.col("c_custkey").alias("id"))
    children = {
        "student_session": t.events.select(F.col("user_id").alias("student_id")),
        "student_assignment": t.orders.select(F.col("o_custkey").alias("student_id")),
    }
    parts = repair.remove_students(ids, children, s.people(t), s.sheet(t), {1: "new@example.org"})
    column = {"student_details": "id", "general_information_sheet": "Student_id"}
    out = None
    for name, split in parts.items():
        for removed, df in ((False, split.kept), (True, split.removed)):
            part = df.select(
                F.lit(name).alias("tbl"), F.col(column.get(name, "student_id")).cast("long").alias("id"),
                F.lit(removed).alias("removed"),
            )
            out = part if out is None else out.unionByName(part)
    return out


@query("batch_assigned", with_shapes(["sheet"], """
SELECT "Student_id", CASE WHEN hit THEN 'Incubator 9.0' ELSE "Incubator_Batch" END AS "Incubator_Batch",
       CASE WHEN hit THEN 'Nine' ELSE "Incubator_Course_Name" END AS "Incubator_Course_Name"
FROM (SELECT *, "Email" IN (SELECT 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.org' FROM events WHERE event_type = 'error') AS hit FROM sheet)"""))
def batch_assigned(t: Tables):
    emails = t.events.filter("event_type = 'error'").selectExpr(
        "concat('\\tcustomer#', lpad(cast(user_id as string), 9, '0'), '@example.org ') as Email"
    )
    done = repair.assign_batch(s.sheet(t), emails, "Incubator 9.0", "Nine")
    return done.updated.select("Student_id", "Incubator_Batch", "Incubator_Course_Name")


@query("load_rolled_back", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE NOT (o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00')""")
def load_rolled_back(t: Tables):
    start, end = [F.lit(dt.datetime(y, 1, 1)).cast("timestamp_ntz") for y in (1997, 1998)]
    return repair.roll_back_load(t.orders.select("o_orderkey", "o_orderdate"), start, end, "o_orderdate").kept


@query("table_guarded", """
SELECT l_suppkey, l_partkey, max(cnt) AS cnt, count(*) AS kept FROM
  (SELECT l_suppkey, l_partkey, count(*) AS cnt FROM lineitem GROUP BY 1, 2) GROUP BY 1, 2 HAVING max(cnt) > 1""")
def table_guarded(t: Tables):
    keys = ["l_suppkey", "l_partkey"]
    order = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
    done = repair.guard_table(t.lineitem, keys, order)
    kept = done.rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("kept"))
    return done.duplicates.join(kept, keys).select(*keys, "cnt", "kept")


@query("sheet_patched", with_shapes(["sheet"], """
SELECT g."Student_id", g."Incubator_Course_Name", coalesce(p.district, g."District") AS "District",
       coalesce(p.role, g."Student_Role") AS "Student_Role"
FROM sheet g LEFT JOIN (
  SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_totalprice > 250000) AS district, arg_max(o_orderstatus, o_orderkey) AS role
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) p ON p.o_custkey = CAST(g."Student_id" AS BIGINT)"""))
def sheet_patched(t: Tables):
    cleaned = t.orders.select(
        F.col("o_custkey").cast("string").alias("Student_id"), F.concat(F.lit("Batch "), F.col("o_orderstatus")).alias("Incubator_Batch"),
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("District"),
        F.col("o_orderstatus").alias("Student_Role"), "o_orderkey",
    )
    sheet = s.sheet(t).drop("Incubator_Batch")
    done = repair.patch_sheet(sheet, cleaned, ["Batch O", "Batch F"], ["o_orderkey"])
    return done.select("Student_id", "Incubator_Course_Name", "District", "Student_Role")


@query("course_names_patched", with_shapes(["sheet"], """
SELECT g."Student_id", coalesce(p.course, g."Incubator_Course_Name") AS "Incubator_Course_Name"
FROM sheet g LEFT JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS course FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) p
ON p.o_custkey = CAST(g."Student_id" AS BIGINT)"""))
def course_names_patched(t: Tables):
    cleaned = t.orders.select(
        F.col("o_custkey").cast("string").alias("Student_id"), F.col("o_orderstatus").alias("Incubator_Batch"),
        F.col("o_orderpriority").alias("Incubator_Course_Name"), "o_orderkey",
    )
    return repair.patch_course_names(s.sheet(t), cleaned, "F", ["o_orderkey"]).select("Student_id", "Incubator_Course_Name")


@query("locations_filled", """
SELECT CAST(c_custkey AS INTEGER) AS id, CASE WHEN c_acctbal > 3000 THEN c_nationkey ELSE m.n END AS location_id
FROM customer LEFT JOIN (SELECT n_nationkey AS n FROM nation) m ON m.n = c_nationkey""")
def locations_filled(t: Tables):
    students = t.customer.select(
        F.col("c_custkey").cast("int").alias("id"), F.when(F.col("c_acctbal") > 3000, F.col("c_nationkey")).alias("location_id")
    )
    sheet = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("Student_id"), F.concat(F.lit(" R"), F.col("n_regionkey")).alias("State_Union_Territory"),
        F.concat(F.upper("n_name"), F.lit(" ")).alias("District"),
    )
    places = t.nation.select(
        F.col("n_nationkey").alias("location_id"), F.concat(F.lit("r"), F.col("n_regionkey")).alias("state_union_territory"),
        F.col("n_name").alias("district"),
    )
    return repair.fill_locations(students, sheet, places)


@query("missing_ids_filled", """
WITH e AS (SELECT event_id, ts, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE user_id END AS id FROM events)
SELECT event_id, id FROM e WHERE id IS NOT NULL
UNION ALL SELECT event_id, (SELECT max(id) FROM e) + row_number() OVER (ORDER BY ts, event_id) FROM e WHERE id IS NULL""")
def missing_ids_filled(t: Tables):
    rows = t.events.select(
        "event_id", "ts", F.when(~F.col("event_type").isin("view", "click"), F.col("user_id")).alias("Student_id")
    )
    done = repair.fill_missing_ids(rows, ["ts", "event_id"])
    return done.select("event_id", F.col("Student_id").alias("id"))


@query("addresses_purged", with_shapes(["sheet"], """
SELECT "Student_id", "Email" FROM sheet WHERE "Email" NOT IN (SELECT replace(lower(s_name), 'supplier', 'customer') || '@example.org' FROM supplier)"""))
def addresses_purged(t: Tables):
    listed = t.supplier.selectExpr("concat(replace(lower(s_name), 'supplier', 'customer'), '@example.org') as address")
    rows = s.sheet(t).select("Student_id", F.concat(F.lit(" "), F.col("Email"), F.lit(" ")).alias("Email"))
    return repair.purge_addresses(rows, listed).kept.withColumn("Email", F.trim("Email"))


@query("column_set", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def column_set(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return repair.set_column(rows, "o_orderpriority", "pending", "o_orderstatus", "P").drop("o_orderstatus")


@query("cohorts_appended", with_shapes(["cohorts"], """
SELECT cohort_code, cohort_name FROM cohorts UNION ALL SELECT 'INC101', 'Next' UNION ALL SELECT 'INC102', 'After next'"""))
def cohorts_appended(t: Tables):
    added = landing.append_cohorts(
        s.cohorts(t), [("INC101", "Next"), ("INC102", "After next")], "cohort_code string, cohort_name string"
    )
    return added.select("cohort_code", "cohort_name")
