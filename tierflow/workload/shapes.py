"""Driver tables in the shape of the learning-programme tables: Spark views and the same in SQL.

Suppliers and customers stand for students, parts for resources and subjects, nations for places and
cohorts, orders and line items for submissions, events for sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables


def students(t: Tables) -> DataFrame:
    """Suppliers as students."""
    return t.supplier.selectExpr(
        "cast(s_suppkey as int) as id", "concat(lower(s_name), '@example.org') as email",
        "s_nationkey as location_id",
    )


def memberships(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "cast(s_suppkey as int) as student_id", "concat('INC', lpad(cast(s_nationkey as string), 3, '0')) as cohort_code"
    )


def resources(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "cast(p_partkey as int) as id",
        "case when p_size <= 20 then 'Assignment' when p_size <= 40 then 'Quiz' else 'Pre-recorded Video' end as category",
        "case when p_size <= 40 then concat('Item ', p_partkey) else concat('VID', p_partkey) end as title",
    )


def assignment_feed(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "concat('supplier#', lpad(cast(l_suppkey as string), 9, '0'), '@example.org') as Email",
        "concat('Item ', l_partkey) as assignment_name",
        "case l_returnflag when 'N' then 'under review' when 'R' then 'reviewed' else 'rejected' end as submission_status",
        "case l_linenumber when 7 then ' ' when 6 then 'NaN' "
        "else concat(date_format(l_shipdate, 'yyyy-MM-dd'), 'T10:00:00.123Z') end as submitted_at",
        "concat('order ', l_orderkey) as feedback_comments",
        "l_linestatus as assignment_file",
    )


def quiz_feed(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "concat('supplier#', lpad(cast(l_suppkey as string), 9, '0'), '@example.org') as user_id",
        "concat('Item ', l_partkey) as data_fields",
        "case when l_linenumber = 7 then 'absent' else cast(cast(l_quantity as decimal(10,1)) as string) end as value",
    )


def people(t: Tables) -> DataFrame:
    """Customers as students."""
    return t.customer.selectExpr(
        "cast(c_custkey as int) as id", "concat(lower(c_name), '@example.org') as email",
        "lpad(cast(c_custkey as string), 10, '9') as phone", "c_mktsegment as caste",
        "case when c_acctbal < 3000 then 'Below 3 Lacs' when c_acctbal < 6000 then ' below 5 lacs ' "
        "else 'Above 12 lacs' end as annual_family_income_inr",
        "c_nationkey as location_id",
    )


def sheet(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "cast(c_custkey as string) as Student_id", "concat(lower(c_name), '@example.org') as Email",
        "concat('Incubator ', c_nationkey % 10, '.0') as Incubator_Batch", "c_mktsegment as Incubator_Course_Name",
        "case when c_nationkey = 3 then 'Student Leader of the region' else 'Member' end as Student_Role",
        "case when c_nationkey % 4 = 0 then ' New Delhi ' else 'Kerala' end as State_Union_Territory",
        "case c_nationkey % 5 when 0 then 'Bengaluru Urban' when 1 then ' Agra' when 2 then 'Shimoga ' "
        "when 3 then 'New Delhi' else 'Pune' end as District",
    )


def person_cohorts(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "cast(c_custkey as int) as student_id", "concat('INC', lpad(cast(c_nationkey as string), 3, '0')) as cohort_code"
    )


def session_feed(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "concat('customer#', lpad(cast(user_id as string), 9, '0'), '@example.org') as Email",
        "concat(case event_type when 'view' then 'SUK' when 'click' then 'WS' when 'error' then 'MC' "
        "when 'signup' then 'VID' else 'OTHER' end, get_json_object(props, '$.k')) as Session_Code",
        "cast(cast(value as decimal(12,2)) as string) as Duration_in_secs",
        "case when event_type = 'click' then null else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end as watched_on",
    )


def live_sessions(t: Tables) -> DataFrame:
    """Parts as sessions: the size gives kind and day, the key gives number and cohort."""
    return t.part.selectExpr(
        "cast(p_partkey as int) as id", "concat('INC', lpad(cast(p_partkey % 25 as string), 3, '0')) as cohort_code",
        "concat(case p_size % 3 when 0 then 'SUK' when 1 then 'WS' else 'MC' end, p_partkey % 100) as code",
        "p_name as session_name", "cast(date_add(date'2024-01-01', p_size * 2) as timestamp_ntz) as conducted_on",
    )


def cohorts(t: Tables) -> DataFrame:
    return t.nation.selectExpr(
        "concat('INC', lpad(cast(n_nationkey as string), 3, '0')) as cohort_code", "n_name as cohort_name",
        "date_add(date'2024-01-01', n_nationkey * 3) as start_date",
        "date_add(date'2024-01-01', n_nationkey * 3 + 5) as end_date",
    )


def locations(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey as location_id", "r_name as state_union_territory", "n_name as district",
        "'Somewhere' as country", "concat('Tier ', n_nationkey % 3) as city_category",
    )


def registrations(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "cast(c_custkey as int) as student_id", "date_add(date'2024-01-01', c_nationkey) as registration_date",
        "concat('{\"currently_pursuing_year\":\"', c_nationkey % 4 + 1, ' \"}') as form_details",
    )


def education(t: Tables) -> DataFrame:
    """One row per line item: student and course from its order, two subjects."""
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "cast(o_custkey as int) as student_id", "ascii(o_orderstatus) as education_course_id",
        "array(cast(l_partkey as int), cast(l_suppkey as int)) as subject_id",
        "cast(o_custkey % 100 as int) as college_id", "cast(o_custkey % 40 as int) as university_id",
    )


def subjects(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "cast(p_partkey as int) as id", "p_brand as education_category", "p_type as subject_area",
        "case when p_size < 10 then null else p_name end as sub_field",
    )


def courses(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus").distinct().selectExpr(
        "ascii(o_orderstatus) as course_id", "concat('Course ', o_orderstatus) as course_name"
    )


def colleges(t: Tables) -> DataFrame:
    return t.supplier.selectExpr("cast(s_suppkey as int) as college_id", "s_name as standard_college_names")


def universities(t: Tables) -> DataFrame:
    return t.nation.selectExpr("n_nationkey as university_id", "n_name as standard_university_names")


def first_items(t: Tables) -> DataFrame:
    """Each order with the smallest part it holds."""
    first = t.lineitem.groupBy("l_orderkey").agg({"l_partkey": "min"}).toDF("o_orderkey", "resource_id")
    return t.orders.join(first, "o_orderkey")


def assignments(t: Tables) -> DataFrame:
    return first_items(t).selectExpr(
        "cast(o_custkey as int) as student_id", "cast(resource_id as int) as resource_id",
        "'INC001' as cohort_code",
        "case o_orderstatus when 'P' then 'under review' when 'F' then 'reviewed' else 'rejected' end as submission_status",
        "o_orderdate as submitted_at",
    )


def quizzes(t: Tables) -> DataFrame:
    return first_items(t).selectExpr(
        "cast(o_orderkey as int) as id", "cast(o_custkey as int) as student_id",
        "cast(resource_id as int) as resource_id", "'INC001' as cohort_code",
        "cast(o_orderkey % 101 as int) as marks", "100 as max_marks",
    )


def attendance(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "cast(user_id as int) as student_id",
        "cast(get_json_object(props, '$.k') as int) * 20 + cast(event_id % 20 as int) as session_id",
        "cast(value as int) as duration_in_sec",
        "case when event_type = 'click' then null else cast(ts as date) end as watched_on",
    )


# The same shapes for DuckDB. Each text may use the ones before it.
SQL = {
    "students": """
        SELECT CAST(s_suppkey AS INTEGER) AS id, lower(s_name) || '@example.org' AS email, s_nationkey AS location_id
        FROM supplier""",
    "memberships": """
        SELECT CAST(s_suppkey AS INTEGER) AS student_id, 'INC' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS cohort_code
        FROM supplier""",
    "resources": """
        SELECT CAST(p_partkey AS INTEGER) AS id,
               CASE WHEN p_size <= 20 THEN 'Assignment' WHEN p_size <= 40 THEN 'Quiz' ELSE 'Pre-recorded Video' END AS category,
               CASE WHEN p_size <= 40 THEN 'Item ' || p_partkey ELSE 'VID' || p_partkey END AS title
        FROM part""",
    "assignment_feed": """
        SELECT 'supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '@example.org' AS email,
               'Item ' || l_partkey AS assignment_name,
               CASE l_returnflag WHEN 'N' THEN 'under review' WHEN 'R' THEN 'reviewed' ELSE 'rejected' END AS submission_status,
               CASE l_linenumber WHEN 7 THEN ' ' WHEN 6 THEN 'NaN'
                    ELSE strftime(l_shipdate, '%Y-%m-%d') || 'T10:00:00.123Z' END AS submitted_at,
               'order ' || l_orderkey AS feedback_comments, l_linestatus AS assignment_file
        FROM lineitem""",
    "quiz_feed": """
        SELECT 'supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || '@example.org' AS user_id,
               'Item ' || l_partkey AS data_fields,
               CASE WHEN l_linenumber = 7 THEN 'absent' ELSE CAST(CAST(l_quantity AS DECIMAL(10,1)) AS VARCHAR) END AS value
        FROM lineitem""",
    "people": """
        SELECT CAST(c_custkey AS INTEGER) AS id, lower(c_name) || '@example.org' AS email,
               lpad(CAST(c_custkey AS VARCHAR), 10, '9') AS phone, c_mktsegment AS caste,
               CASE WHEN c_acctbal < 3000 THEN 'Below 3 Lacs' WHEN c_acctbal < 6000 THEN ' below 5 lacs '
                    ELSE 'Above 12 lacs' END AS annual_family_income_inr,
               c_nationkey AS location_id
        FROM customer""",
    "sheet": """
        SELECT CAST(c_custkey AS VARCHAR) AS "Student_id", lower(c_name) || '@example.org' AS "Email",
               'Incubator ' || (c_nationkey % 10) || '.0' AS "Incubator_Batch", c_mktsegment AS "Incubator_Course_Name",
               CASE WHEN c_nationkey = 3 THEN 'Student Leader of the region' ELSE 'Member' END AS "Student_Role",
               CASE WHEN c_nationkey % 4 = 0 THEN ' New Delhi ' ELSE 'Kerala' END AS "State_Union_Territory",
               CASE c_nationkey % 5 WHEN 0 THEN 'Bengaluru Urban' WHEN 1 THEN ' Agra' WHEN 2 THEN 'Shimoga '
                    WHEN 3 THEN 'New Delhi' ELSE 'Pune' END AS "District"
        FROM customer""",
    "person_cohorts": """
        SELECT CAST(c_custkey AS INTEGER) AS student_id, 'INC' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS cohort_code
        FROM customer""",
    "session_feed": """
        SELECT 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || '@example.org' AS email,
               CASE event_type WHEN 'view' THEN 'SUK' WHEN 'click' THEN 'WS' WHEN 'error' THEN 'MC'
                    WHEN 'signup' THEN 'VID' ELSE 'OTHER' END || json_extract_string(props, '$.k') AS session_code,
               CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS duration_in_secs,
               CASE WHEN event_type = 'click' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS watched_on
        FROM events""",
    "live_sessions": """
        SELECT CAST(p_partkey AS INTEGER) AS id, 'INC' || lpad(CAST(p_partkey % 25 AS VARCHAR), 3, '0') AS cohort_code,
               CASE p_size % 3 WHEN 0 THEN 'SUK' WHEN 1 THEN 'WS' ELSE 'MC' END || (p_partkey % 100) AS code,
               p_name AS session_name, CAST(DATE '2024-01-01' + p_size * 2 AS TIMESTAMP) AS conducted_on
        FROM part""",
    "cohorts": """
        SELECT 'INC' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS cohort_code, n_name AS cohort_name,
               DATE '2024-01-01' + n_nationkey * 3 AS start_date, DATE '2024-01-01' + (n_nationkey * 3 + 5) AS end_date
        FROM nation""",
    "locations": """
        SELECT n_nationkey AS location_id, r_name AS state_union_territory, n_name AS district,
               'Somewhere' AS country, 'Tier ' || (n_nationkey % 3) AS city_category
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "registrations": """
        SELECT CAST(c_custkey AS INTEGER) AS student_id, DATE '2024-01-01' + c_nationkey AS registration_date,
               '{"currently_pursuing_year":"' || (c_nationkey % 4 + 1) || ' "}' AS form_details
        FROM customer""",
    "subjects": """
        SELECT p_partkey AS id, p_brand AS education_category, p_type AS subject_area,
               CASE WHEN p_size < 10 THEN NULL ELSE p_name END AS sub_field
        FROM part""",
    "courses": """
        SELECT DISTINCT ascii(o_orderstatus) AS course_id, 'Course ' || o_orderstatus AS course_name FROM orders""",
    "mapped": """
        SELECT e.student_id, e.course_id, c.course_name, s_name AS college_name, n_name AS university_name,
               s.education_category, s.subject_area, s.sub_field
        FROM (SELECT o_custkey AS student_id, ascii(o_orderstatus) AS course_id, o_custkey % 100 AS college_id,
                     o_custkey % 40 AS university_id, unnest([l_partkey, l_suppkey]) AS subject_id
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) e
        JOIN subjects s ON s.id = e.subject_id
        JOIN courses c ON c.course_id = e.course_id
        LEFT JOIN supplier ON s_suppkey = e.college_id
        LEFT JOIN nation ON n_nationkey = e.university_id""",
    "subject_lists": """
        SELECT student_id, course_id,
               string_agg(DISTINCT education_category, ', ' ORDER BY education_category) AS education_category,
               string_agg(DISTINCT subject_area, ', ' ORDER BY subject_area) AS subject_areas,
               string_agg(DISTINCT sub_field, ', ' ORDER BY sub_field) AS sub_fields_list
        FROM mapped GROUP BY ALL""",
    "study_places": """
        SELECT DISTINCT student_id, course_id, course_name, college_name, university_name FROM mapped""",
    "profile": """
        SELECT p.id AS student_id, p.email, p.caste, p.annual_family_income_inr, g."Incubator_Batch",
               r.form_details, l.state_union_territory, l.district, l.country, l.city_category,
               a.education_category, a.subject_areas, a.sub_fields_list, n.course_name, n.college_name, n.university_name
        FROM people p
        JOIN sheet g ON g."Email" = p.email
        LEFT JOIN locations l ON l.location_id = p.location_id
        LEFT JOIN registrations r ON r.student_id = p.id
        LEFT JOIN subject_lists a ON a.student_id = p.id
        LEFT JOIN study_places n ON n.student_id = p.id AND n.course_id = a.course_id""",
    "first_items": """
        SELECT o.*, f.resource_id
        FROM orders o JOIN (SELECT l_orderkey, min(l_partkey) AS resource_id FROM lineitem GROUP BY 1) f
        ON l_orderkey = o_orderkey""",
    "assignments": """
        SELECT CAST(o_custkey AS INTEGER) AS student_id, CAST(resource_id AS INTEGER) AS resource_id,
               'INC001' AS cohort_code,
               CASE o_orderstatus WHEN 'P' THEN 'under review' WHEN 'F' THEN 'reviewed' ELSE 'rejected' END AS submission_status,
               o_orderdate AS submitted_at
        FROM first_items""",
    "quizzes": """
        SELECT CAST(o_orderkey AS INTEGER) AS id, CAST(o_custkey AS INTEGER) AS student_id,
               CAST(resource_id AS INTEGER) AS resource_id, 'INC001' AS cohort_code,
               CAST(o_orderkey % 101 AS INTEGER) AS marks, 100 AS max_marks
        FROM first_items""",
    "attendance": """
        SELECT CAST(user_id AS INTEGER) AS student_id,
               CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 20 + event_id % 20 AS INTEGER) AS session_id,
               CAST(trunc(value) AS INTEGER) AS duration_in_sec,
               CASE WHEN event_type = 'click' THEN NULL ELSE CAST(ts AS DATE) END AS watched_on
        FROM events""",
}

# Shapes a shape is built on.
_NEEDS = {
    "mapped": ["subjects", "courses"],
    "subject_lists": ["mapped"],
    "study_places": ["mapped"],
    "profile": ["people", "sheet", "locations", "registrations", "subject_lists", "study_places"],
    "assignments": ["first_items"],
    "quizzes": ["first_items"],
}


def with_shapes(names: list[str], body: str) -> str:
    """``body`` behind a WITH clause that defines the named shapes."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        wanted.add(name)

    for name in names:
        add(name)
    ctes = [f"{name} AS ({text})" for name, text in SQL.items() if name in wanted]
    return f"WITH {', '.join(ctes)}\n{body}"
