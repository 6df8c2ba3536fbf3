"""One run of a pipeline: its name, its one time, and a journal of finished steps.

All tables of a run share one time: whatever takes "now" for rows without a date takes it from the run.
With a journal (a small table, one row a step), a rerun under the same name
begins behind the last finished step, with the time of the first attempt; steps are written
so that one which stopped half-way can be run again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession

from layertables.sources.tables import read_table_or_empty

_JOURNAL = "step string, finished timestamp, started timestamp, report string, run_id string"
_START = "start"


@dataclass
class Run:
    """``now`` is the time of the whole run; :meth:`step` runs a step once."""

    spark: SparkSession
    run_id: str
    now: dt.datetime
    journal: str | None = None
    finished: dict[str, dict] = field(default_factory=dict)

    def _note(self, step: str, report: dict[str, Any]) -> None:
        if self.journal:
            row = (step, dt.datetime.now(dt.timezone.utc), self.now, json.dumps(report, default=str), self.run_id)
            self.spark.createDataFrame([row], _JOURNAL).coalesce(1).write.mode("append").partitionBy("run_id").parquet(self.journal)

    def step(self, name: str, work: Callable[[], dict[str, Any]]) -> dict[str, Any]:
        """The report of ``work``; one that this run has finished before is not run again."""
        if name not in self.finished:
            report = work()
            self._note(name, report)
            self.finished[name] = report
        return self.finished[name]


def start_run(spark: SparkSession, run_id: str | None = None, journal: str | None = None, now: dt.datetime | None = None) -> Run:
    """Begin a run, or go on with the one of that name in the journal (then with its time)."""
    if journal and not run_id:
        raise ValueError("a run with a journal needs a name that a rerun can give again")
    run = Run(spark, run_id or uuid.uuid4().hex, now or dt.datetime.now(dt.timezone.utc), journal)
    if journal is None:
        return run
    rows = read_table_or_empty(spark, journal, None)
    # A row a step of one run; other runs are other partitions, which are not read.
    done = [] if rows is None else rows.filter(rows["run_id"] == run.run_id).select("step", "started", "report").collect()
    if not done:
        run._note(_START, {})
        return run
    run.now = done[0]["started"].astimezone(dt.timezone.utc)
    run.finished = {r["step"]: json.loads(r["report"]) for r in done if r["step"] != _START}
    return run
