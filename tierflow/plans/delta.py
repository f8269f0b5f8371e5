"""Enriched and reporting tables kept up to date from what changed, in place of being made anew.

``LayerStore.changes`` gives the signed rows between two versions of a table and reads only folders and buckets that differ.
Changed facts lead to the keys of the enriched rows they make, changed enriched rows to the report groups they count in; counts are
adjusted by old and new rows, and a maximum is looked up again only where the row that held it went. Rows of other keys and groups are
neither read nor written. Only when a dimension changed (the student profile, titles, sessions) are the facts scanned for what names it.

The result is that of a rebuild, deletes included.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.merge import upsert_or_delete
from ..session import stored
from ..sources.schemas import MERGE_KEYS
from ..sources.tables import SIGN, LayerStore, Published
from . import enrich, report

#: What each layer's run reads; ``versions`` of these before a load are what ``since`` takes after it.
ENRICH_INPUTS = [
    ("conformed", t)
    for t in (
        "student_details", "student_registration_details", "student_education", "subject_mapping", "course_mapping", "college_mapping",
        "university_mapping", "location_mapping", "resource", "cohort", "live_session", "student_quiz", "student_assignment", "student_session",
    )
] + [("landing", "general_information_sheet")]
REPORT_INPUTS = [
    ("enriched", "final_assignment"), ("enriched", "student_demography"), ("conformed", "student_details"),
    ("conformed", "student_registration_details"),
]
_PROFILE_INPUTS = {
    "student_details", "student_registration_details", "student_education", "subject_mapping", "course_mapping", "college_mapping",
    "university_mapping", "location_mapping", "general_information_sheet",
}
#: Counts of submissions per group, from which the overview is told; changes adjust it.
COUNTS = "submission_counts"


def versions(store: LayerStore, tables: list[tuple[str, str]]) -> dict[str, int]:
    """Current versions, by ``layer.table``."""
    return {f"{layer}.{name}": store.version(layer, name) for layer, name in tables}


class _Inputs:
    """Current tables and their signed changes since the given versions."""

    def __init__(self, store: LayerStore, since: dict[str, int]):
        self.store, self.since = store, since

    def now(self, name: str, layer: str = "conformed") -> DataFrame:
        return self.store.read(layer, name)

    def changed(self, name: str, layer: str = "conformed") -> bool:
        return self.store.version(layer, name) != self.since[f"{layer}.{name}"]

    def changes(self, name: str, layer: str = "conformed") -> DataFrame:
        return self.store.changes(layer, name, self.since[f"{layer}.{name}"])

    def values(self, name: str, column: str, alias: str, layer: str = "conformed") -> DataFrame | None:
        """Distinct values of a column in rows that changed; None without any change."""
        if not self.changed(name, layer):
            return None
        return self.changes(name, layer).select(F.col(column).alias(alias)).filter(F.col(alias).isNotNull()).distinct()


def _merged(store: LayerStore, layer: str, name: str, rows: DataFrame, touched: DataFrame, update_cols: list[str]) -> Published | None:
    """Upsert the rows and delete the touched keys that have none any more. ``touched`` is read several times."""
    keys = MERGE_KEYS[name]
    rows = stored(rows, name)
    # Every touched key is marked as gone; the merge's one look at a key finds whether it has a row.
    marks = touched.select(*keys).withColumn("_gone", F.lit(True))
    source = rows.withColumn("_gone", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    if source.isEmpty():
        return None
    return store.merge(layer, name, source, keys, merged_by=upsert_or_delete, apart=True, update_cols=update_cols, on_dup="last")


def run_enrich_changes(
    store: LayerStore, since: dict[str, int], cohort_codes: list[str] | None = None
) -> dict[str, Published | None]:
    """Bring the four enriched tables up to date with all that changed since the given versions (of ``ENRICH_INPUTS``)."""
    inputs = _Inputs(store, since)
    profile_changed = any(inputs.changed(name, layer) for layer, name in ENRICH_INPUTS if name in _PROFILE_INPUTS)
    students = None
    if profile_changed:
        # The profile is of student size; its own two versions tell whose rows differ.
        before = store.version("enriched", "student_profile")
        sheet = inputs.now("general_information_sheet", "landing")
        subjects = enrich.subject_profile(
            inputs.now("student_education"), inputs.now("subject_mapping"), inputs.now("course_mapping"),
            inputs.now("college_mapping"), inputs.now("university_mapping"),
        )
        store.publish("enriched", "student_profile", enrich.student_profile(
            inputs.now("student_details"), enrich.clean_sheet(sheet, sheet.columns), inputs.now("location_mapping"),
            inputs.now("student_registration_details"), subjects,
        ))
        students = stored(store.changes("enriched", "student_profile", before), "profile-changes")
    profile = store.read("enriched", "student_profile")
    sessions_changed = inputs.changed("live_session") or inputs.changed("cohort")
    sessions = enrich.sessions_in_cohorts(inputs.now("live_session"), inputs.now("cohort"), cohort_codes)

    def session_ids() -> DataFrame | None:
        if inputs.changed("cohort"):  # its dates move sessions in and out: all of them are looked at again
            return inputs.now("live_session").select(F.col("id").alias("session_id")).distinct()
        return inputs.values("live_session", "id", "session_id") if sessions_changed else None

    facts: dict[str, tuple[str, Callable[[DataFrame], DataFrame], Callable[[], DataFrame | None]]] = {
        "final_quiz": ("student_quiz", lambda f: enrich.final_quiz(f, inputs.now("resource"), profile), lambda: inputs.values("resource", "id", "resource_id")),
        "final_assignment": (
            "student_assignment", lambda f: enrich.final_assignment(f, inputs.now("resource"), profile), lambda: inputs.values("resource", "id", "resource_id"),
        ),
        "daily_weekly_attendance": ("student_session", lambda f: enrich.daily_weekly_attendance(f, sessions, profile), session_ids),
    }
    done: dict[str, Published | None] = {}
    for name, (fact, build, changed_names) in facts.items():
        keys = MERGE_KEYS[name]
        parts = [inputs.changes(fact)] if inputs.changed(fact) else []
        for values in (None if students is None else students.select("student_id").distinct(), changed_names()):
            if values is not None:
                parts.append(inputs.now(fact).join(values, values.columns, "left_semi").withColumn(SIGN, F.lit(1).cast("long")))
        if not parts:
            done[name] = None
            continue
        touched = stored(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), f"{name}-touched")
        current = touched.filter(F.col(SIGN) > 0).drop(SIGN).dropDuplicates()
        rows = build(current)
        done[name] = _merged(store, "enriched", name, rows, touched, enrich.updated_columns(name, rows))
    done["student_demography"] = None
    if students is not None:
        ids = students.select("student_id").distinct()
        rows = enrich.student_demography(profile.join(ids, "student_id", "left_semi"))
        touched = students.select(*MERGE_KEYS["student_demography"])
        done["student_demography"] = _merged(store, "enriched", "student_demography", rows, touched, enrich.updated_columns("student_demography", rows))
    return done


def publish_counts(store: LayerStore) -> Published:
    """The counts per group that changes adjust later, from the whole fact table."""
    counts = report.submission_counts(store.read("enriched", "final_assignment"), report.GROUP, with_rows=True)
    return store.publish("reporting", COUNTS, counts, bucket_keys=MERGE_KEYS["resubmission_count_overview"])


def moved_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """The groups of ``counts`` that signed rows touch, with their counts now; a group that is gone has 0 ``rows``.

    Counts move by the signed rows. A maximum moves up by new rows; where a removed row held it, the group is ``lost``.
    """
    status, sign, at = F.col("submission_status"), F.col(SIGN), F.col("submitted_at")
    submitted = status == report.SUBMITTED

    def moved(wanted: Column) -> Column:
        return F.coalesce(F.sum(F.when(wanted, sign)), F.lit(0))

    delta = changes.groupBy(*report.GROUP).agg(
        moved(submitted).alias("d_total"), moved(status == report.ACCEPTED).alias("d_accepted"), moved(status == report.REJECTED).alias("d_rejected"),
        F.sum(sign).alias("d_rows"), F.max(F.when(submitted & (sign > 0), at)).alias("came"), F.max(F.when(submitted & (sign < 0), at)).alias("went"),
    )
    here, there = counts.alias("c"), delta.alias("d")
    same = reduce(lambda a, b: a & b, [F.col(f"c.{g}").eqNullSafe(F.col(f"d.{g}")) for g in report.GROUP])
    pairs = there.join(here, same, "left")
    zero = F.lit(0).cast("long")
    return pairs.select(
        *[F.col(f"d.{g}").alias(g) for g in report.GROUP],
        *[(F.coalesce(F.col(f"c.{c}"), zero) + F.col(d)).alias(c) for c, d in (("total_submissions", "d_total"), ("accepted_count", "d_accepted"), ("rejected_count", "d_rejected"), ("rows", "d_rows"))],
        F.greatest("c.last_submission_date", "came").alias("last_submission_date"),
        (F.col("went") >= F.col("c.last_submission_date")).alias("lost"),
    )


def adjusted_counts(moved: DataFrame, facts: DataFrame) -> DataFrame:
    """``moved_counts`` with the maximum of lost groups, for which their submitted facts are read again; without groups that are gone.

    ``moved`` is read several times.
    """
    lost = moved.filter("rows > 0 and lost").drop("lost", "last_submission_date")
    # Null-safe on the whole group, with the keys that are never NULL in a fact first.
    submitted = facts.filter(F.col("submission_status") == report.SUBMITTED).select(*report.GROUP, "submitted_at")
    again = lost.alias("l").join(submitted.alias("f"), reduce(lambda a, b: a & b, [F.col(f"l.{g}").eqNullSafe(F.col(f"f.{g}")) for g in report.GROUP]), "left")
    whole = again.groupBy(*[F.col(f"l.{c}").alias(c) for c in lost.columns]).agg(F.max("f.submitted_at").alias("last_submission_date"))
    kept = moved.filter("rows > 0 and (lost is null or not lost)").drop("lost")
    return kept.unionByName(stored(whole, "recounted").select(*kept.columns))


def run_report_changes(store: LayerStore, since: dict[str, int]) -> dict[str, Published | None]:
    """Bring both reporting tables up to date with all that changed since the given versions (of ``REPORT_INPUTS``)."""
    inputs, done = _Inputs(store, since), {}
    students = inputs.now("student_details")
    people = inputs.values("student_details", "id", "student_id")
    overview, keys = "resubmission_count_overview", MERGE_KEYS["resubmission_count_overview"]
    touched = None
    if inputs.changed("final_assignment", "enriched"):
        changes = stored(inputs.changes("final_assignment", "enriched"), "changes")
        moved = stored(moved_counts(store.read("reporting", COUNTS), changes), "moved")
        now = adjusted_counts(moved, inputs.now("final_assignment", "enriched"))
        gone = moved.filter("rows <= 0").drop("lost")
        source = now.withColumn("_gone", F.lit(False)).unionByName(gone.withColumn("_gone", F.lit(True)))
        store.merge("reporting", COUNTS, source, keys, merged_by=_groups_replaced)
        touched = moved.select(*keys)
    if people is not None:
        theirs = store.read("reporting", COUNTS).join(people, "student_id", "left_semi").select(*keys)
        touched = theirs if touched is None else touched.unionByName(theirs)
    done[overview] = None
    if touched is not None:
        touched = stored(touched.distinct(), "touched")
        groups = store.read("reporting", COUNTS).drop("rows").join(touched, keys, "left_semi")
        rows = report.overview_of(groups, students)
        done[overview] = _merged(store, "reporting", overview, rows, touched, [c for c in rows.columns if c not in keys])

    registration = "student_registration_overview"
    ids = [v for v in (
        people, inputs.values("student_registration_details", "student_id", "student_id"),
        inputs.values("student_demography", "student_id", "student_id", "enriched"),
    ) if v is not None]
    done[registration] = None
    if ids:
        ids = stored(reduce(DataFrame.unionByName, ids).distinct(), "students")
        rows = report.registration_overview(
            inputs.now("student_demography", "enriched").join(ids, "student_id", "left_semi"), students, inputs.now("student_registration_details")
        )
        before = stored(store.read("reporting", registration).join(ids, "student_id", "left_semi").select(*MERGE_KEYS[registration]), "before")
        done[registration] = _merged(store, "reporting", registration, rows, before, [c for c in rows.columns if c not in MERGE_KEYS[registration]])
    return done


def _groups_replaced(target: DataFrame, source: DataFrame, keys: list[str], mark_changes: bool = False) -> DataFrame:
    """Groups of the source take the place of equal ones (NULLs alike); groups that are gone leave."""
    kept = target.join(source.select(*[F.col(g).alias(f"_{g}") for g in report.GROUP]), reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in report.GROUP]), "left_anti")
    new = source.filter("not _gone").select(*target.columns)
    if not mark_changes:
        return kept.unionByName(new)
    return kept.withColumn("_change", F.lit(None).cast("string")).unionByName(new.withColumn("_change", F.lit("updated")))
