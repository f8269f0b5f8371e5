"""Onboarding an institution: one upload becomes students, addresses, registrations and education rows.

Student ids are dealt once, to the rows of the upload, and stored with them; all three tables take them from there. Each step adds
the rows its table lacks by id, in one append, and is logged, so a run that broke after or within any step is repeated with
its id and ends with the same rows, ids and times.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import local_now
from ..operators.keys import assign_sequential_ids
from ..operators.merge import Audit
from ..session import stored
from ..sources.schemas import conformed_schema
from ..sources.tables import LayerStore
from . import conform
from .guard import guarded
from .restart import RunLog

#: Steps in their order; each is a restart point.
STEPS = ["sheet", "student_details", "student_registration_details", "student_education"]


def _lacking(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    return rows.join(table.select(key).filter(F.col(key).isNotNull()), key, "left_anti").select(*rows.columns)


def run_onboarding(
    store: LayerStore, upload: DataFrame, run_id: str, domain: str, order_by: list[str] | None = None,
    as_of: dt.date | None = None, now: dt.datetime | None = None, until: str | None = None,
) -> dict[str, int]:
    """Rows added per table. Rows of the upload without a name are no students.

    Ids follow ``order_by`` (all columns, if none are given) after the largest id there is. ``until`` names the last step to do.
    """
    if until is not None and until not in STEPS:
        raise ValueError(f"until must be one of {STEPS}, not {until!r}")
    log, sheet = RunLog(store, f"onboarding-{run_id}"), f"onboarding_{run_id}"

    def started() -> dict:
        moment = now or store.spark.range(1).select(local_now().cast("timestamp_ntz")).first()[0]
        return {"now": moment.isoformat(), "as_of": (as_of or moment.date()).isoformat()}

    plan = log.once("plan", started)
    audit, day = Audit(now=dt.datetime.fromisoformat(plan["now"])), dt.date.fromisoformat(plan["as_of"])

    def dim(name: str) -> DataFrame:
        if not store.exists("conformed", name):
            store.publish("conformed", name, store.spark.createDataFrame([], conformed_schema(name)))
        return store.read("conformed", name)

    def dealt() -> dict:
        named = upload.drop("student_id").filter(F.col("full_name").isNotNull()).withColumn("student_id", F.lit(None).cast("int"))
        taken = dim("student_details").select(F.col("id").alias("student_id"))
        numbered = assign_sequential_ids(named, "student_id", order_by or [c for c in named.columns if c != "student_id"], taken=taken)
        return {"rows": store.publish("landing", sheet, numbered).rows}

    def students() -> DataFrame:
        return conform.fill_emails(conform.onboard_students(store.read("landing", sheet), audit), domain)

    def registrations() -> DataFrame:
        return conform.onboard_registrations(store.read("landing", sheet), dim("student_details"), audit)

    def education() -> DataFrame:
        return conform.onboard_education(
            store.read("landing", sheet), dim("student_details"), dim("course_mapping"), dim("subject_mapping"),
            dim("college_mapping"), dim("location_mapping"), dim("university_mapping"), day, audit,
        )

    def added(name: str, rows: DataFrame, key: str) -> dict:
        table = dim(name)
        new = stored(_lacking(rows, table, key), name)
        if "id" not in new.columns:
            new = new.withColumn("id", F.lit(None).cast("int"))
            new = assign_sequential_ids(new, "id", [key, *[c for c in new.columns if c not in (key, "id")]], taken=table)
        store.append("conformed", name, guarded(store, name, new, run_id, ["id"]))
        ours = store.read("landing", sheet).select(F.col("student_id").alias(key))
        return {"rows": store.read("conformed", name).join(ours, key, "left_semi").count()}

    work = {
        "sheet": dealt,
        "student_details": lambda: added("student_details", students(), "id"),
        "student_registration_details": lambda: added("student_registration_details", registrations(), "student_id"),
        "student_education": lambda: added("student_education", education(), "student_id"),
    }
    done = {}
    for step in STEPS:
        done[step] = log.once(step, work[step])["rows"]
        if step == until:
            break
    return done
