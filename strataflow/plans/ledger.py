"""Run ledger: append-only event logs, folded into the latest state when read, and compacted as they grow."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import schemas
from strataflow.operators.dedup import latest_value
from strataflow.sinks.eventlog import COMPACT_AFTER, EventLog

RUNNING, SUCCESS, FAILED, SKIPPED = "RUNNING", "SUCCESS", "FAILED", "SKIPPED"


def _order():
    return F.struct("event_ts", (F.col("status") != RUNNING).alias("ended"))


_LATEST = ["status", "rows_processed", "last_checkpoint", "error_message"]


def begin_runs(events: DataFrame) -> DataFrame:
    """One mergeable row an event: each field with the time that decides about it."""
    ended = F.col("status") != RUNNING

    def timed(name: str, keep=True):
        return F.when(keep, F.struct(_order().alias("at"), F.col(name).alias("value"))).alias(name)

    return events.select(
        "ingestion_run_id",
        timed("run_scope", F.lit(True)),
        F.when(~ended, F.col("event_ts")).alias("start_ts"),
        F.when(ended, F.col("event_ts")).alias("end_ts"),
        *[timed(name, F.col(name).isNotNull()) for name in _LATEST],
    )


def merge_runs(rows: DataFrame) -> DataFrame:
    """One mergeable row a run; merging in parts gives the same."""
    return rows.groupBy("ingestion_run_id").agg(
        F.min("run_scope").alias("run_scope"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        *[F.max(name).alias(name) for name in _LATEST],
    )


def finish_runs(merged: DataFrame) -> DataFrame:
    """The run as it is reported."""
    return merged.select(
        "ingestion_run_id", F.col("run_scope.value").alias("run_scope"), "start_ts", "end_ts",
        *[F.col(f"{name}.value").alias(name) for name in _LATEST],
    )


def fold_runs(events: DataFrame) -> DataFrame:
    """One row per run: its start, its end if there is one, and its latest state.

    A field an end event leaves NULL keeps its earlier value.
    """
    return finish_runs(merge_runs(begin_runs(events)))


def last_run_per_scope(runs: DataFrame) -> DataFrame:
    """The run of each scope that started last."""
    values = [name for name in runs.columns if name != "run_scope"]
    return latest_value(runs, ["run_scope"], ["start_ts", "ingestion_run_id"], **{v: v for v in values})


def fold_checkpoints(saved: DataFrame) -> DataFrame:
    """Latest value per source."""
    return latest_value(saved, ["source"], ["saved_ts", "value"], value="value", saved_ts="saved_ts")


@dataclass
class RunState:
    """What a run reports when it ends."""

    run_id: str
    status: str = SUCCESS
    rows: int | None = None
    checkpoint: str | None = None


class RunLedger:
    """Runs and checkpoints under one root folder."""

    def __init__(self, spark: SparkSession, root: str, compact_after: int = COMPACT_AFTER):
        self.spark = spark
        base = root.rstrip("/")
        self.run_log = EventLog(spark, f"{base}/runs", schemas.LEDGER, begin_runs, merge_runs, compact_after)
        self.mark_log = EventLog(
            spark, f"{base}/checkpoints", schemas.CHECKPOINTS, lambda saved: saved, fold_checkpoints, compact_after
        )

    def _append(self, log: EventLog, row: tuple) -> None:
        values = [F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, log.schema.fields)]
        log.append(self.spark.range(0, 1, 1, 1).select(values))

    def start_run(self, run_scope: str) -> str:
        run_id = str(uuid4())
        self._append(self.run_log, (run_id, run_scope, datetime.now(timezone.utc), RUNNING, None, None, None))
        return run_id

    def end_run(
        self,
        run_id: str,
        status: str = SUCCESS,
        *,
        rows_processed: int | None = None,
        last_checkpoint: str | None = None,
        error_message: str | None = None,
    ) -> None:
        """Append the end of a run. This does not move the checkpoint of any source."""
        started = self.list_runs().where(F.col("ingestion_run_id") == run_id).first()
        if started is None:
            raise KeyError(f"no run {run_id!r} in the ledger")
        self._close(run_id, started["run_scope"], status, rows_processed, last_checkpoint, error_message)

    def _close(self, run_id, run_scope, status, rows_processed=None, last_checkpoint=None, error_message=None) -> None:
        rows = None if rows_processed is None else int(rows_processed)
        mark = None if last_checkpoint is None else str(last_checkpoint)
        self._append(self.run_log, (run_id, run_scope, datetime.now(timezone.utc), status, rows, mark, error_message))

    @contextmanager
    def run(self, run_scope: str) -> Iterator[RunState]:
        """Record a run around a block: FAILED with its message if the block raises."""
        state = RunState(self.start_run(run_scope))
        try:
            yield state
        except Exception as error:
            self._close(state.run_id, run_scope, FAILED, error_message=str(error))
            raise
        self._close(state.run_id, run_scope, state.status, state.rows, state.checkpoint)

    def list_runs(self, run_scope: str | None = None) -> DataFrame:
        runs = finish_runs(self.run_log.read())
        return runs if run_scope is None else runs.where(F.col("run_scope") == run_scope)

    def last_run(self, run_scope: str | None = None) -> DataFrame:
        """The run that started last, as zero or one row."""
        return self.list_runs(run_scope).orderBy(F.desc("start_ts"), F.desc("ingestion_run_id")).limit(1)

    def save_checkpoint(self, source: str, value) -> None:
        self._append(self.mark_log, (source, None if value is None else str(value), datetime.now(timezone.utc)))

    def save_checkpoints(self, marks: DataFrame) -> None:
        """Append many (source, value) marks in one job."""
        self.mark_log.append(
            marks.select("source", F.col("value").cast("string"), F.lit(datetime.now(timezone.utc)).alias("saved_ts"))
        )

    def checkpoints(self) -> DataFrame:
        return self.mark_log.read()

    def load_checkpoint(self, source: str, default: str | None = None) -> str | None:
        row = self.checkpoints().where(F.col("source") == source).first()
        return default if row is None else row["value"]

    def compact(self) -> None:
        """Fold all events so far, so that the next read opens one state and what came after it."""
        self.run_log.compact()
        self.mark_log.compact()
