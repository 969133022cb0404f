"""Append-only events that are folded into a state from time to time.

Events lie as files right below the log's folder. ``compact`` folds the last state and the
events after it into a new state, which names the files it has folded; a read takes the newest state and
the files that it doesn't name, so it opens as many files as came since, however long the
log has run. A state counts once its list of files is complete, which is written after its rows; the files
it names go last. Cut short anywhere, a compaction leaves the events or the state that
holds them, and the next one cleans up. Events may be appended meanwhile; compactions
take turns.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strataflow.sources.folders import child_files, child_folders, read_text, remove, write_text

Fold = Callable[[DataFrame], DataFrame]

STATES, FOLDED, END = "_states", "_folded", "end"
COMPACT_AFTER = 64


class EventLog:
    """``begin`` makes a mergeable row of each event, ``merge`` one of several rows with one key."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, begin: Fold, merge: Fold, compact_after: int = COMPACT_AFTER):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.begin, self.merge, self.compact_after = begin, merge, compact_after

    def append(self, events: DataFrame) -> None:
        """Add events; above ``compact_after`` files since the last state a new one is made."""
        events.select(*self.schema.fieldNames()).write.mode("append").parquet(self.path)
        if len(self._tail()[1]) > self.compact_after:
            self.compact()

    def _states(self) -> list[str]:
        return [f"{self.path}/{STATES}/{name}" for name in child_folders(self.spark, f"{self.path}/{STATES}")]

    def _newest(self) -> tuple[str | None, set[str]]:
        """The newest state that is whole, and the files that it has folded."""
        for state in reversed(self._states()):
            lines = (read_text(self.spark, f"{state}/{FOLDED}") or "").split("\n")
            if lines[-1] == END:
                return state, set(lines[:-1])
        return None, set()

    def _tail(self) -> tuple[str | None, list[str], set[str]]:
        """Newest state, event files after it, and those it has folded."""
        state, folded = self._newest()
        return state, [name for name in child_files(self.spark, self.path) if name not in folded], folded

    def _rows(self, state: str | None, files: list[str]) -> DataFrame:
        """Mergeable rows: those of the state, and one for each event in the files."""
        read = self.spark.read.schema(self.schema)
        events = read.parquet(*[f"{self.path}/{name}" for name in files]) if files else self.spark.createDataFrame([], self.schema)
        rows = self.begin(events)
        if state is None:
            return rows
        return self.spark.read.schema(rows.schema).parquet(f"{state}/rows").unionByName(rows)

    def read(self) -> DataFrame:
        """The folded rows as of now."""
        state, files, _ = self._tail()
        return self.merge(self._rows(state, files))

    def compact(self) -> int:
        """Make a new state of all events so far; how many files it has folded."""
        state, files, folded = self._tail()
        if files:
            number = 0 if state is None else int(state.rsplit("/", 1)[1].split("-")[0]) + 1
            new = f"{self.path}/{STATES}/{number:012d}-{uuid4().hex}"
            self.merge(self._rows(state, files)).write.parquet(f"{new}/rows")
            # Files of the last state that were to be deleted may still be there.
            left = folded.intersection(child_files(self.spark, self.path))
            write_text(self.spark, f"{new}/{FOLDED}", "\n".join([*sorted(left.union(files)), END]))
        self._clean()
        return len(files)

    def _clean(self) -> None:
        """Delete what the newest state has folded, and the states before it."""
        state, folded = self._newest()
        if state is not None:
            there = folded.intersection(child_files(self.spark, self.path))
            remove(self.spark, [f"{self.path}/{name}" for name in sorted(there)])
            remove(self.spark, [old for old in self._states() if old < state])
