"""Runs of several steps that go on where they stopped."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException

from ..sources.tables import LayerStore


class RunLog:
    """Finished steps of one run: a small row each, with the facts later steps need, below ``<root>/run_log/<run>``.

    A step that broke has no row and is done again, so it must not harm to do a step twice; a finished one is not repeated.
    """

    def __init__(self, store: LayerStore, run: str):
        if not re.fullmatch(r"[\w.-]+", run):
            raise ValueError(f"a run is named by letters, digits, dots and dashes, not {run!r}")
        self.spark, self.path = store.spark, f"{store.root}/run_log/{run}"
        self.facts = {}
        try:
            rows = self.spark.read.schema("step string, facts string").parquet(self.path).collect()  # one for each step of the run
            self.facts = {r["step"]: json.loads(r["facts"]) for r in rows}
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise

    def once(self, step: str, work: Callable[[], dict]) -> dict:
        """The facts of a step, from the log or from doing it now."""
        if step not in self.facts:
            facts = work()
            row = self.spark.createDataFrame([(step, json.dumps(facts))], "step string, facts string")
            row.coalesce(1).write.mode("append").parquet(self.path)
            self.facts[step] = facts
        return self.facts[step]
