"""Runs that break anywhere and are repeated; table rules on the way in."""

import datetime as dt

import pytest
from conftest import values

from tierflow.operators import quality
from tierflow.plans import guard, onboard, run
from tierflow.sources.schemas import aligned
from tierflow.sources.tables import LayerStore, audited

NOW, DAY = dt.datetime(2025, 7, 1, 12), dt.date(2025, 7, 1)


class Broken(RuntimeError):
    pass


def breaking(monkeypatch, owner, name, at):
    """Let the ``at``-th call of a method fail, before or after its work."""
    calls, whole = [0], getattr(owner, name)

    def call(*args, **options):
        calls[0] += 1
        if calls[0] == at:
            raise Broken(name)
        return whole(*args, **options)

    monkeypatch.setattr(owner, name, call)


UPLOAD = "full_name string, caste string, annual_family_income string, assigned_through string, registration_date string, currently_pursuing_year string, currently_pursuing_degree string, subject_area string, college_name string, district string, state_union_territory string, city_category string, university_name string"


def new_world(spark, rows, root):
    store = LayerStore(spark, str(root))
    store.publish("conformed", "student_details", aligned(rows("id int, email string, first_name string", (7, "a@x", "Old")), "student_details"))
    store.publish("conformed", "course_mapping", rows("course_id int, display_name string, course_duration int", (1, "BSc", 3), (2, "bsc ", 4)))
    for name in ("subject_mapping", "college_mapping", "location_mapping", "university_mapping"):
        store.publish("conformed", name, aligned(rows("id int", *[]), name))
    upload = rows(
        UPLOAD, ("Asha Rao", "OBC", "x", "web", "2025-06-01", "2nd", "BSC", "Optics", None, None, None, None, None),
        ("Asha Rao", "OBC", "x", "web", "2025-06-01", "2nd", "BSC", "Optics", None, None, None, None, None),  # a namesake: a student of her own
        (None, "z", "x", None, None, None, None, None, None, None, None, None, None), ("R. Devi", None, None, None, "soon", None, "BA", "", None, None, None, None, None),
    )
    return store, upload


def onboarded(store):
    people = values(store.read("conformed", "student_details"), "id", "email", "first_name", "last_name", "inserted_at")
    registered = values(store.read("conformed", "student_registration_details"), "id", "student_id", "registration_date", "inserted_at")
    return people, registered, values(store.read("conformed", "student_education"), "id", "student_id", "education_course_id", "start_year", "end_year")


def test_onboarding_goes_on_after_a_break_anywhere(spark, rows, tmp_path, monkeypatch):
    store, upload = new_world(spark, rows, tmp_path / "whole")
    counts = onboard.run_onboarding(store, upload, "u", "example.org", None, DAY, NOW)
    assert counts == {"sheet": 3, "student_details": 3, "student_registration_details": 3, "student_education": 4}
    want = onboarded(store)
    assert [r[0] for r in want[0]] == [10, 7, 8, 9] and want[0][0][1] == "10@example.org"
    # Both steps of a table can break: the append, and the row of the log after it.
    for n, (owner, name, at) in enumerate([
        (LayerStore, "append", 1), (LayerStore, "_log", 1), (LayerStore, "_log", 4),
    ]):
        store, upload = new_world(spark, rows, tmp_path / f"broken{n}")
        with monkeypatch.context() as m:
            breaking(m, owner, name, at)
            with pytest.raises(Broken):
                onboard.run_onboarding(store, upload, "u", "example.org", None, DAY, NOW)
                raise AssertionError("nothing broke")
        again = onboard.run_onboarding(store, upload, "u", "example.org", None, DAY, dt.datetime(2031, 1, 1))
        assert onboarded(store) == want and again == counts, (owner, name, at)


def test_a_step_whose_log_row_was_lost_is_not_done_twice(spark, rows, tmp_path, monkeypatch):
    store, upload = new_world(spark, rows, tmp_path)
    onboard.run_onboarding(store, upload, "u", "example.org", None, DAY, NOW, until="student_details")
    log = onboard.RunLog(store, "onboarding-u")
    kept = [(k, __import__("json").dumps(v)) for k, v in log.facts.items() if k != "student_details"]
    spark.createDataFrame(kept, "step string, facts string").coalesce(1).write.mode("overwrite").parquet(log.path + "-kept")
    monkeypatch.setattr(onboard.RunLog, "__init__", lambda self, s, r, whole=onboard.RunLog.__init__: (whole(self, s, r), self.facts.pop("student_details", None))[0])
    counts = onboard.run_onboarding(store, upload, "u", "example.org", None, DAY, NOW, until="student_details")
    assert counts["student_details"] == 3 and store.read("conformed", "student_details").count() == 4
    with pytest.raises(ValueError):
        onboard.run_onboarding(store, upload, "u", "example.org", until="nothing")
    with pytest.raises(ValueError):
        onboard.RunLog(store, "a/b")


def three_tables(spark, rows, root):
    store = LayerStore(spark, str(root))
    for name in ("student_quiz", "student_assignment"):
        store.publish("conformed", name, rows("id int, student_id int, resource_id int", *[(i, i % 5 if i % 7 else None, i) for i in range(40)]), bucket_keys=["student_id", "resource_id"], buckets=4)
    store.publish("conformed", "student_details", rows("id int, email string", *[(i, f"{i}@x") for i in range(5)]), bucket_keys=["id"], buckets=4)
    store.publish("landing", "general_information_sheet", rows("Student_id string, Email string", ("2", "2@x"), ("3", "3@x"), (None, "n@x")))
    return store


TABLES = [("conformed", "student_quiz"), ("conformed", "student_assignment"), ("conformed", "student_details"), ("landing", "general_information_sheet")]


def state(store):
    return [values(store.read(*t)) for t in TABLES]


def test_removal_over_tables_goes_on_after_a_break_anywhere(spark, rows, tmp_path, monkeypatch):
    ids = rows("student int, x int", (2, 0), (4, 0), (99, 0))
    store = three_tables(spark, rows, tmp_path / "whole")
    before = state(store)
    removed = run.run_removal(store, ids, "r", dry_run=True)
    assert removed == {"student_quiz": 14, "student_assignment": 14, "student_details": 2, "general_information_sheet": 1} and state(store) == before
    assert run.run_removal(store, ids, "r") == removed
    want = state(store)
    assert all(2 not in r and "2@x" not in r for rows_ in want for r in rows_ if len(r) == 2) and want != before
    for name, breaks in (("stage_delete", (3,)), ("switch", (1, 2, 4))):
        for at in breaks:
            store = three_tables(spark, rows, tmp_path / f"{name}{at}")
            with monkeypatch.context() as m:
                breaking(m, LayerStore, name, at)
                with pytest.raises(Broken):
                    run.run_removal(store, ids, "r")
            if name == "stage_delete":
                assert state(store) == before  # nothing is switched before all is prepared
            assert run.run_removal(store, ids, "r") == removed and state(store) == want
            assert [audited(spark, f"{store.root}/audit/removed_students_{t}", "r").count() for _, t in TABLES] == list(removed.values())
    # Only buckets that lost rows were written, and the layout is kept.
    entry = store._current("conformed", "student_details")
    assert entry["bucket_keys"] == ["id"] and len(entry["folders"]) == 2


def test_a_table_written_in_between_is_not_overwritten(spark, rows, tmp_path, monkeypatch):
    store = three_tables(spark, rows, tmp_path)
    with monkeypatch.context() as m:
        breaking(m, LayerStore, "switch", 1)
        with pytest.raises(Broken):
            run.run_removal(store, rows("id int", (2,)), "r")
    store.append("conformed", "student_quiz", rows("id int, student_id int, resource_id int", (100, 2, 100)))
    with pytest.raises(ValueError, match="written after"):
        run.run_removal(store, rows("id int", (2,)), "r")


def test_loads_rolled_back(spark, rows, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    at = [dt.datetime(2025, 1, d) for d in (1, 2, 3)]
    for name in ("student_education", "student_registration_details"):
        store.publish("conformed", name, rows("id int, inserted_at timestamp_ntz", *[(i, t) for i, t in enumerate(at)], (9, None)))
    loads = [("conformed", "student_education", at[1], at[2]), ("conformed", "student_registration_details", at[0], at[2])]
    assert run.run_rollback(store, loads, "x", dry_run=True) == {"student_education": 1, "student_registration_details": 2}
    assert run.run_rollback(store, loads, "x") == run.run_rollback(store, loads, "x") == {"student_education": 1, "student_registration_details": 2}
    assert values(store.read("conformed", "student_education"), "id") == [(0,), (2,), (9,)]
    assert values(store.read("conformed", "student_registration_details"), "id") == [(2,), (9,)]


def test_rules_on_the_way_in(spark, rows, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    store.publish("conformed", "cohort", rows("cohort_code string", ("INC001",)))
    store.publish("conformed", "student_cohort", rows("student_code string, student_id int, cohort_code string", ("S1", 1, "INC001")))
    new = rows(
        "student_code string, student_id int, cohort_code string", ("S1", 1, "INC001"), ("S1", 2, "INC001"), ("S2", 3, "INC001"), ("S2", 4, "INC001"), ("S2", 4, "INC001"),
        (None, 5, "INC001"), ("S3", 6, "INC002"), ("S4" + "x" * 20, 7, None), ("S5", 8, "INC0019"),
    )
    keys = ["student_code", "student_id"]
    good = guard.guarded(store, "student_cohort", new, "r", keys, keys)
    assert values(good, "student_id") == [(1,), (3,)]
    bad = audited(spark, f"{store.root}/audit/rule_breaks_student_cohort", "r")
    assert sorted((r["student_id"], tuple(r["reasons"])) for r in bad.collect()) == [
        (2, ("unique:student_code",)), (4, ("unique:student_code",)), (4, ("unique:student_code",)), (5, ("not_null:student_code",)),
        (6, ("reference:cohort_code",)), (7, ("max_length:student_code",)), (8, ("max_length:cohort_code", "reference:cohort_code")),
    ]
    # Without a broken rule nothing is listed, and an empty table passes.
    assert guard.guarded(store, "student_cohort", new.limit(0), "r2", keys).count() == 0
    assert audited(spark, f"{store.root}/audit/rule_breaks_student_cohort", "r2").count() == 0
    assert values(guard.with_reasons(new.limit(1), [quality.not_null("student_id")]), "reasons") == [([],)]
