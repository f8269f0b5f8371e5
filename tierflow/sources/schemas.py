"""Table layouts of the conformed layer, keys of the merges and fixed value domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_AUDIT = ", inserted_at timestamp_ntz, updated_at timestamp_ntz"

# Columns and types of the conformed tables.
CONFORMED = {
    "student_details": (
        "id int, email string, first_name string, last_name string, gender string, phone string, "
        "date_of_birth date, caste string, annual_family_income_inr string, location_id int" + _AUDIT
    ),
    "student_registration_details": (
        "id int, student_id int, assigned_through string, registration_date date, form_details string" + _AUDIT
    ),
    "student_education": (
        "id int, student_id int, education_course_id int, subject_id array<int>, interest_subject_id int, "
        "college_id int, university_id int, college_location_id int, start_year int, end_year int" + _AUDIT
    ),
    "referral_college_professor": (
        "id int, student_id int, college_id int, name string, phone string" + _AUDIT
    ),
    "program": "program_code string, full_form string, start_date date",
    "cohort": (
        "cohort_code string, program_code string, cohort_number int, cohort_name string, type string, "
        "start_date date, end_date date, is_active boolean"
    ),
    "student_cohort": (
        "student_code string, student_id int, cohort_code string, is_leader boolean, cohort_enroll_date date"
    ),
    "resource": (
        "id int, category string, title string, description string, location string, resource_link string, "
        "is_video_resource boolean, total_duration int"
    ),
    "live_session": (
        "id int, cohort_code string, session_name string, type string, code string, duration_in_sec int, "
        "conducted_on timestamp_ntz"
    ),
    "student_session": "id int, student_id int, session_id int, duration_in_sec int, watched_on date",
    "student_quiz": (
        "id int, student_id int, resource_id int, cohort_code string, marks int, max_marks int, "
        "reattempts int, attempted_at timestamp_ntz"
    ),
    "student_pre_recorded": (
        "id int, student_id int, resource_id int, cohort_code string, watchtime_in_sec int, "
        "watched_at timestamp_ntz"
    ),
    "student_assignment": (
        "id int, student_id int, resource_id int, mentor_id int, cohort_code string, submission_status string, "
        "marks_pct decimal(10,0), feedback_comments string, submitted_at timestamp_ntz, assignment_file string"
    ),
    "mentor_details": (
        "id int, name string, email_id string, linkedIn_url string, current_position string, "
        "phone_number string, mentor_role string, location_id int, joined_on date, is_active boolean"
    ),
    "subject_mapping": "id int, education_category string, subject_area string, sub_field string",
    "course_mapping": "course_id int, course_name string, display_name string, course_duration int",
    "college_mapping": "college_id int, standard_college_names string",
    "university_mapping": "university_id int, standard_university_names string",
    "location_mapping": (
        "location_id int, state_union_territory string, district string, country string, city_category string"
    ),
}

# Conflict keys of the merges.
MERGE_KEYS = {
    "incubator_quiz_monitoring": ["user_id", "data_fields"],
    "student_session_information": ["Email", "Session_Code"],
    "assignment_monitoring_data": ["assignment_id", "submitted_at", "Email"],
    "student_assignment": ["student_id", "resource_id", "submitted_at"],
    "student_session": ["student_id", "session_id"],
    "student_quiz": ["student_id", "resource_id"],
    "student_pre_recorded": ["student_id", "resource_id"],
    "student_cohort": ["student_code", "student_id"],
    "live_session": ["cohort_code", "code", "conducted_on"],
    "student_demography": ["email"],
    "final_quiz": ["student_id", "resource_id"],
    "final_assignment": ["student_id", "resource_id", "submitted_at"],
    "daily_weekly_attendance": ["student_id", "session_id"],
    "resubmission_count_overview": ["student_id", "resource_id"],
    "student_registration_overview": ["student_id", "email"],
}

# Domains of enumerated columns. Session types differ between programmes and are an argument.
GENDERS = ["F", "M", "O"]
PROGRAM_CODES = ["INC", "ACC", "STC"]
COHORT_TYPES = ["open", "curriculum"]
RESOURCE_CATEGORIES = ["Pre-recorded Video", "Quiz", "Assignment"]
SUBMISSION_STATUSES = ["under review", "reviewed", "rejected", "submitted"]

# The programmes every installation starts with.
PROGRAMS = [("INC", "Incubator", None), ("ACC", "Accelerator", None), ("STC", "Stem Champion", None)]

# Code prefixes of live sessions and of recorded videos.
LIVE_SESSION_PREFIXES = ["SUK", "WS", "MC"]
RECORDED_PREFIXES = ["VID"]


def conformed_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(CONFORMED[table])


def aligned(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the columns and types of a conformed table; missing columns are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in conformed_schema(table)
        ]
    )


# Rules declared for the conformed tables.
REQUIRED = {
    "student_details": ["id"],
    "student_registration_details": ["id"],
    "student_education": ["id"],
    "referral_college_professor": ["id"],
    "program": ["program_code"],
    "cohort": ["cohort_code"],
    "student_cohort": ["student_code"],
    "resource": ["id"],
    "live_session": ["id"],
    "student_session": ["id"],
    "student_quiz": ["id"],
    "student_pre_recorded": ["id"],
    "student_assignment": ["id"],
    "mentor_details": ["id"],
}
LENGTHS = {
    "student_details": {"email": 254, "first_name": 100, "last_name": 100, "phone": 15},
    "referral_college_professor": {"name": 50, "phone": 15},
    "program": {"full_form": 20},
    "cohort": {"cohort_code": 6, "cohort_name": 300},
    "student_cohort": {"student_code": 15, "cohort_code": 6},
    "resource": {"title": 300},
    "live_session": {"cohort_code": 6},
    "student_quiz": {"cohort_code": 6},
    "student_pre_recorded": {"cohort_code": 6},
    "student_assignment": {"cohort_code": 6},
    "mentor_details": {
        "name": 50, "email_id": 254, "linkedIn_url": 200, "current_position": 100, "phone_number": 15,
    },
}
DOMAINS = {
    "student_details": {"gender": GENDERS},
    "program": {"program_code": PROGRAM_CODES},
    "cohort": {"program_code": PROGRAM_CODES},
    "resource": {"category": RESOURCE_CATEGORIES},
    "student_assignment": {"submission_status": SUBMISSION_STATUSES},
}
UNIQUE = {
    "student_details": [["id"], ["email"]],
    "student_registration_details": [["id"]],
    "student_education": [["id"]],
    "referral_college_professor": [["id"]],
    "program": [["program_code"]],
    "cohort": [["cohort_code"]],
    "student_cohort": [["student_code"]],
    "resource": [["id"]],
    "live_session": [["id"], ["cohort_code", "code", "conducted_on"]],
    "student_session": [["id"], ["student_id", "session_id"]],
    "student_quiz": [["id"], ["student_id", "resource_id"]],
    "student_pre_recorded": [["id"], ["student_id", "resource_id"]],
    "student_assignment": [["id"], ["student_id", "resource_id", "submitted_at"]],
    "mentor_details": [["id"]],
}
# Column, table it names, column there.
REFERENCES = {
    "student_details": [("location_id", "location_mapping", "location_id")],
    "student_registration_details": [("student_id", "student_details", "id")],
    "student_education": [
        ("student_id", "student_details", "id"),
        ("education_course_id", "course_mapping", "course_id"),
        ("interest_subject_id", "subject_mapping", "id"),
        ("college_id", "college_mapping", "college_id"),
        ("college_location_id", "location_mapping", "location_id"),
    ],
    "referral_college_professor": [("student_id", "student_details", "id"), ("college_id", "college_mapping", "college_id")],
    "cohort": [("program_code", "program", "program_code")],
    "student_cohort": [("student_id", "student_details", "id"), ("cohort_code", "cohort", "cohort_code")],
    "live_session": [("cohort_code", "cohort", "cohort_code")],
    "student_session": [("student_id", "student_details", "id"), ("session_id", "live_session", "id")],
    "student_quiz": [
        ("student_id", "student_details", "id"), ("resource_id", "resource", "id"), ("cohort_code", "cohort", "cohort_code"),
    ],
    "student_pre_recorded": [
        ("student_id", "student_details", "id"), ("resource_id", "resource", "id"), ("cohort_code", "cohort", "cohort_code"),
    ],
    "student_assignment": [
        ("student_id", "student_details", "id"), ("resource_id", "resource", "id"),
        ("mentor_id", "mentor_details", "id"), ("cohort_code", "cohort", "cohort_code"),
    ],
    "mentor_details": [("location_id", "location_mapping", "location_id")],
}
