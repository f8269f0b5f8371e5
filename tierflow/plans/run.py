"""Layer-to-layer runs over a store: each table is published by itself, so one failure stops no other."""

from __future__ import annotations

import traceback
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import dedupe_keep_last, duplicate_report
from ..operators.keys import assign_sequential_ids
from ..operators.repair import Split, delete_listed
from ..session import stored
from ..sources.csv_files import SEQ
from ..sources.schemas import MERGE_KEYS, conformed_schema
from ..sources.tables import LayerStore, Published, audited, write_audit
from . import conform, enrich, report
from .delta import COUNTS, publish_counts
from .guard import guarded
from .landing import live_sessions_from_csv
from .repair import roll_back_load
from .restart import RunLog


@dataclass(frozen=True)
class Outcome:
    table: str
    published: Published | None = None
    error: str | None = None


def _attempt(table: str, publish: Callable[[], Published]) -> Outcome:
    try:
        return Outcome(table, publish())
    except Exception:
        return Outcome(table, error=traceback.format_exc(limit=3))


def _numbered(keys: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Ids for new rows, as a serial column would give them.

    The merge is written once to the shared folder, since numbering reads it more than once.
    """

    def finish(merged: DataFrame, table: DataFrame) -> DataFrame:
        rows = stored(merged, "merged")
        order = [*keys, *[c for c in rows.columns if c not in (*keys, "id")]]
        return assign_sequential_ids(rows, "id", order, taken=table)

    return finish


def run_conform(store: LayerStore, run_id: str = "conform") -> list[Outcome]:
    """Landing feeds into the conformed fact tables.

    Rows that drop out go below ``<root>/audit/rejected_<table>`` with their reasons, under the run's id, and rows that break a
    declared rule of their table below ``rule_breaks_<table>``.
    """
    def dim(name: str) -> DataFrame:
        return store.read("conformed", name)

    def feed(name: str) -> DataFrame:
        return store.read("landing", name)

    sessions = "student_session_information"
    builders = {
        "student_assignment": lambda: conform.conform_assignments(
            feed("assignment_monitoring_data"), dim("student_details"), dim("student_cohort"), dim("resource")
        ),
        "student_session": lambda: conform.conform_sessions(
            feed(sessions), dim("student_details"), dim("student_cohort"), dim("live_session")
        ),
        "student_pre_recorded": lambda: conform.conform_pre_recorded(
            feed(sessions), dim("student_details"), dim("student_cohort"), dim("resource")
        ),
        "student_quiz": lambda: conform.conform_quizzes(
            feed("incubator_quiz_monitoring"), dim("student_details"), dim("student_cohort"), dim("resource")
        ),
    }

    rejects = {
        "student_assignment": lambda: conform.rejected_assignments(
            feed("assignment_monitoring_data"), dim("student_details"), dim("student_cohort"), dim("resource")
        ),
        "student_session": lambda: conform.rejected_sessions(
            feed(sessions), dim("student_details"), dim("student_cohort"), dim("live_session")
        ),
        "student_pre_recorded": lambda: conform.rejected_pre_recorded(
            feed(sessions), dim("student_details"), dim("student_cohort"), dim("resource")
        ),
        "student_quiz": lambda: conform.rejected_quizzes(
            feed("incubator_quiz_monitoring"), dim("student_details"), dim("student_cohort"), dim("resource")
        ),
    }

    def publish(name: str) -> Published:
        keys = MERGE_KEYS[name]
        rows = guarded(store, name, builders[name](), run_id, keys)
        write_audit(rejects[name](), f"{store.root}/audit", run_id, f"rejected_{name}")
        if not store.exists("conformed", name):
            store.publish("conformed", name, store.spark.createDataFrame([], conformed_schema(name)))
        return store.merge(
            "conformed", name, rows, keys, _numbered(keys),
            update_cols=conform.updated_columns(name, rows), on_dup="last",
        )

    return [_attempt(name, lambda n=name: publish(n)) for name in builders]


def run_live_sessions(store: LayerStore, rows: DataFrame, run_id: str = "live_sessions") -> Published:
    """Rows of a live-session export into the conformed table: repeated sessions go first, new ones get ids."""
    keys, new = MERGE_KEYS["live_session"], live_sessions_from_csv(rows)
    if not store.exists("conformed", "live_session"):
        store.publish("conformed", "live_session", store.spark.createDataFrame([], conformed_schema("live_session")))
    order_by = [SEQ] if SEQ in new.columns else None
    new = guarded(store, "live_session", new, run_id, keys, order_by)
    return store.merge(
        "conformed", "live_session", new, keys, _numbered(keys), prepare=lambda df: dedupe_keep_last(df, keys, ["id"]),
        update_cols=["session_name", "type", "duration_in_sec"], on_dup="last", order_by=order_by,
    )


def run_memberships(store: LayerStore, upload: DataFrame, run_id: str = "memberships") -> Published:
    """An upload of cohort memberships into the conformed table; rows that drop out are listed with reasons."""
    students, cohorts = store.read("conformed", "student_details"), store.read("conformed", "cohort")
    write_audit(conform.rejected_memberships(upload, students, cohorts), f"{store.root}/audit", run_id, "rejected_student_cohort")
    keys = MERGE_KEYS["student_cohort"]
    rows = guarded(store, "student_cohort", conform.conform_memberships(upload, students, cohorts), run_id, keys)
    if not store.exists("conformed", "student_cohort"):
        store.publish("conformed", "student_cohort", store.spark.createDataFrame([], conformed_schema("student_cohort")))
    return store.merge(
        "conformed", "student_cohort", rows, keys, update_cols=conform.updated_columns("student_cohort", rows), on_dup="last"
    )


def run_enrich(
    store: LayerStore, run_id: str, cohort_codes: list[str] | None = None, rebuild: bool = False
) -> list[Outcome]:
    """Conformed facts with the student profile, which is written once and read by all four tables.

    Duplicates found in a target are reported below ``<root>/audit`` and removed before the merge.
    With ``rebuild`` the tables are made anew instead of merged, students are matched to the info
    sheet by id, and every cohort counts.
    """
    def dim(name: str) -> DataFrame:
        return store.read("conformed", name)

    sheet = store.read("landing", "general_information_sheet")
    sheet = enrich.clean_sheet(sheet, sheet.columns)
    subject_rows = enrich.subject_profile(
        dim("student_education"), dim("subject_mapping"), dim("course_mapping"), dim("college_mapping"),
        dim("university_mapping"),
    )

    def profile_by(sheet_join: str, name: str) -> DataFrame:
        rows = enrich.student_profile(
            dim("student_details"), sheet, dim("location_mapping"), dim("student_registration_details"),
            subject_rows, sheet_join,
        )
        store.publish("enriched", name, rows)
        return store.read("enriched", name)

    profile = profile_by("email", "student_profile")
    sessions = enrich.sessions_in_cohorts(dim("live_session"), dim("cohort"), None if rebuild else cohort_codes)
    builders = {
        "final_quiz": lambda: enrich.final_quiz(dim("student_quiz"), dim("resource"), profile),
        "student_demography": lambda: enrich.student_demography(
            profile_by("id_left", "student_profile_by_id") if rebuild else profile
        ),
        "final_assignment": lambda: enrich.final_assignment(dim("student_assignment"), dim("resource"), profile),
        "daily_weekly_attendance": lambda: enrich.daily_weekly_attendance(dim("student_session"), sessions, profile),
    }

    def publish(name: str) -> Published:
        rows, keys = builders[name](), MERGE_KEYS[name]
        if rebuild:
            return store.publish("enriched", name, rows)
        if not store.exists("enriched", name):
            return store.publish("enriched", name, enrich.merged(name, rows.limit(0), rows), bucket_keys=keys)

        def cleaned(affected: DataFrame) -> DataFrame:
            # Only the touched buckets are read, so the report and the clean-up cost what the export does.
            write_audit(duplicate_report(affected, keys), f"{store.root}/audit", run_id, f"duplicate_{name}")
            return dedupe_keep_last(affected, keys, affected.columns)

        return store.merge(
            "enriched", name, rows, keys, prepare=cleaned, update_cols=enrich.updated_columns(name, rows), on_dup="last"
        )

    return [_attempt(name, lambda n=name: publish(n)) for name in builders]


def run_report(store: LayerStore, rebuild: bool = False) -> list[Outcome]:
    """Reporting tables from the enriched ones; a rebuild clusters the overview by student and resource."""
    students = store.read("conformed", "student_details")

    def overview() -> DataFrame:
        if rebuild:
            return report.resubmission_overview(store.read("enriched", "final_assignment"), students, by_course=True)
        publish_counts(store)  # changes adjust these later
        return report.overview_of(store.read("reporting", COUNTS).drop("rows"), students)

    builders = {
        "resubmission_count_overview": overview,
        "student_registration_overview": lambda: report.registration_overview(
            store.read("enriched", "student_demography"), students, store.read("conformed", "student_registration_details")
        ),
    }

    def publish(name: str) -> Published:
        rows = builders[name]()
        if rebuild:
            cluster = MERGE_KEYS[name] if name == "resubmission_count_overview" else None
            return store.publish("reporting", name, rows, cluster_by=cluster)
        keys = MERGE_KEYS[name]
        if not store.exists("reporting", name):
            return store.publish("reporting", name, report.merged(name, rows.limit(0), rows), bucket_keys=keys)
        return store.merge("reporting", name, rows, keys, update_cols=[c for c in rows.columns if c not in keys], on_dup="last")

    return [_attempt(name, lambda n=name: publish(n)) for name in builders]


@dataclass(frozen=True)
class Repair:
    """One table of a repair: how its rows split into kept and removed ones."""

    layer: str
    table: str
    split: Callable[[DataFrame], Split]


def run_repair(store: LayerStore, repairs: list[Repair], run_id: str, label: str, dry_run: bool = False) -> dict[str, int]:
    """Back up and delete over several tables, in the given order (children before their parents), as one restartable run.

    First every table is prepared from the state before the run: its removed rows are written below ``<root>/audit``, the kept
    rows to a folder that is not current yet, and the run's log names both. Only then the tables are switched one after the other.
    A run that broke anywhere goes on where it stopped when it is repeated with its id, and ends as if it had not broken. The
    number of removed rows per table is returned; a dry run only counts.
    """
    if dry_run:
        return {r.table: r.split(store.read(r.layer, r.table)).removed.count() for r in repairs}
    log = RunLog(store, f"{label}-{run_id}")

    def prepared(step: Repair) -> dict:
        parts = step.split(store.read(step.layer, step.table))
        backup = write_audit(parts.removed, f"{store.root}/audit", run_id, f"{label}_{step.table}")
        lost = audited(store.spark, backup, run_id)
        n = lost.count()
        return {"removed": n, "backup": backup, "staged": store.stage_delete(step.layer, step.table, parts.kept, lost, parts.in_place) if n else None}

    plan = [(step, log.once(f"prepare {step.layer}.{step.table}", lambda step=step: prepared(step))) for step in repairs]
    for step, made in plan:
        if made["staged"]:
            store.switch(step.layer, step.table, made["staged"])
    return {step.table: made["removed"] for step, made in plan}


#: Conformed tables that name a student; the student and the info sheet go after them.
STUDENT_TABLES = [
    "referral_college_professor", "student_registration_details", "student_education", "student_cohort", "student_session",
    "student_quiz", "student_pre_recorded", "student_assignment",
]


def run_removal(store: LayerStore, ids: DataFrame, run_id: str, dry_run: bool = False) -> dict[str, int]:
    """Remove students by id (first column of ``ids``) from all tables that exist, with backups; restartable as ``run_repair``."""
    listed = ids.select(F.col(ids.columns[0]).alias("_id"))
    places = [*[("conformed", t, "student_id") for t in STUDENT_TABLES], ("conformed", "student_details", "id"), ("landing", "general_information_sheet", "Student_id")]

    def job(layer: str, table: str, column: str) -> Repair:
        return Repair(layer, table, lambda df: delete_listed(df, column, listed, "_id"))

    return run_repair(store, [job(*p) for p in places if store.exists(*p[:2])], run_id, "removed_students", dry_run)


def run_rollback(
    store: LayerStore, loads: list[tuple[str, str, object, object]], run_id: str, column: str = "inserted_at", dry_run: bool = False
) -> dict[str, int]:
    """Take back loads (layer, table, start, end): rows inserted from start up to, but not at, end, in the given order.

    Restartable as ``run_repair``.
    """
    def job(layer: str, table: str, start, end) -> Repair:
        return Repair(layer, table, lambda df: roll_back_load(df, start, end, column))

    return run_repair(store, [job(*load) for load in loads], run_id, "rollback", dry_run)
