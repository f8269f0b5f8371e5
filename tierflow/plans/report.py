"""Reporting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import repeat_count, repeat_pct, share_pct
from ..operators.aggregate import count_where, max_where
from ..operators.joins import look_up_one
from ..operators.merge import upsert
from ..sources.schemas import MERGE_KEYS

# Statuses that count as submitted, accepted and rejected.
SUBMITTED, ACCEPTED, REJECTED = "under review", "reviewed", "rejected"

#: What the overview counts by.
GROUP = ["student_id", "resource_id", "title", "cohort_code", "college_name"]


def submission_counts(assignments: DataFrame, group: list[str], with_rows: bool = False) -> DataFrame:
    """Filtered counts per group; partial counts leave the map tasks, so a hot group stays small."""
    status, rows = F.col("submission_status"), [F.count(F.lit(1)).alias("rows")] if with_rows else []
    return assignments.groupBy(*group).agg(
        count_where(status == SUBMITTED).alias("total_submissions"),
        count_where(status == ACCEPTED).alias("accepted_count"),
        count_where(status == REJECTED).alias("rejected_count"),
        max_where(status == SUBMITTED, F.col("submitted_at")).alias("last_submission_date"),
        *rows,
    )


def _with_rates(counts: DataFrame, group: list[str]) -> DataFrame:
    total = F.col("total_submissions")
    return counts.select(
        *group,
        "email_id",
        "total_submissions",
        repeat_count(total).alias("resubmissions_count"),
        repeat_pct(total).alias("resubmission_rate"),
        "accepted_count",
        share_pct(F.col("accepted_count"), total).alias("acceptance_rate"),
        "rejected_count",
        share_pct(F.col("rejected_count"), total).alias("rejection_rate"),
        "last_submission_date",
    )


def resubmission_overview(assignments: DataFrame, students: DataFrame, by_course: bool = False) -> DataFrame:
    """Submissions, repeats and outcomes per student and resource.

    ``by_course=True`` is the rebuild form: it also splits by course and takes one e-mail per student.
    """
    if by_course:
        counts = submission_counts(assignments, [*GROUP, "course_name"])
        named = look_up_one(counts, students, ("student_id", "id"), "email", "email_id")
        return _with_rates(named, GROUP)
    return overview_of(submission_counts(assignments, GROUP), students)


def overview_of(counts: DataFrame, students: DataFrame) -> DataFrame:
    """The overview from the counts of its groups."""
    emails = students.select(F.col("id").alias("student_id"), F.col("email").alias("email_id"))
    return _with_rates(counts.join(emails, "student_id", "left"), GROUP)


def registration_overview(demography: DataFrame, students: DataFrame, registrations: DataFrame) -> DataFrame:
    phones = students.select(F.col("id").alias("student_id"), "phone")
    registered = registrations.select(
        "student_id", F.col("registration_date").cast("timestamp_ntz").alias("registration_date")
    )
    return demography.join(phones, "student_id").join(registered, "student_id").select(
        *demography.columns, "phone", "registration_date"
    )


def merged(table: str, target: DataFrame, rows: DataFrame, on_dup: str = "last") -> DataFrame:
    keys = MERGE_KEYS[table]
    return upsert(target, rows, keys, [c for c in rows.columns if c not in keys], on_dup=on_dup)
