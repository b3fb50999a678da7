"""Statistics of job runs: one row each, those that fail too."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from fogline.operators.checks import observe_counts
from fogline.sources.tables import CommitConflict, FileTable

RUNS = "job string, started_at timestamp, finished_at timestamp, outcome string, error string, counts map<string,bigint>"
#: Other jobs may add their rows at the same moment.
ATTEMPTS = 20


class Run:
    """What one run has counted. Metrics are collected while Spark writes the watched frames; no pass is added."""

    def __init__(self, job: str):
        self.job = job
        self.counts: dict[str, int] = {}
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, **conditions: Column) -> DataFrame:
        """``df`` whose rows, and those that meet the conditions, are counted under the step's name when it is computed.

        It must be computed once: pin it (``cut_lineage``) before it is written by ranges, which are sampled first, or read twice.
        """
        watched, seen = observe_counts(df, f"{self.job}.{step}.{len(self._watched)}", **conditions)
        self._watched.append((step, seen))
        return watched

    def note(self, **counts: int) -> None:
        self.counts.update(counts)

    def collect(self) -> None:
        """Metrics of the watched frames, all of which have been computed."""
        for step, seen in self._watched:
            self.counts.update({step if name == "rows" else f"{step}_{name}": int(n) for name, n in seen.get.items()})


@contextmanager
def recorded(spark: SparkSession, table: FileTable | None, job: str) -> Iterator[Run]:
    """Adds a row about the enclosed run to ``table``, then lets its error go on. None: nothing is recorded."""
    run, started = Run(job), dt.datetime.now(dt.timezone.utc)
    try:
        yield run
        run.collect()
    except Exception as error:
        _add(spark, table, run, started, "failed", f"{type(error).__name__}: {error}"[:500])
        raise
    _add(spark, table, run, started, "done", None)


def _add(spark: SparkSession, table: FileTable | None, run: Run, started: dt.datetime, outcome: str, error: str | None) -> None:
    if table is None:
        return
    row = (run.job, started, dt.datetime.now(dt.timezone.utc), outcome, error, run.counts)
    for attempt in range(ATTEMPTS):
        try:
            table.append(spark.createDataFrame([row], RUNS))
            return
        except CommitConflict:
            if attempt + 1 == ATTEMPTS:
                raise
