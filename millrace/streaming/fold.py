"""E2 with keyed state: events folded into the current state of their run, one event at a time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace import contract as K

KEYED_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOLDED = ("run_id long, attempt int, last_event string, last_at timestamp, finished boolean, status string, "
          "sources_completed long, sources_failed long, records long, silent boolean, step long")
_RUN = ("attempt int, last_event string, last_at long, last_rank int, finished boolean, status string, "
        "status_at long, status_rank int, completed long, failed long, records long, silent boolean, step long")
_FIELDS = [f.split()[0] for f in _RUN.split(", ")]
_FIRST = {"last_at": -1 << 62, "last_rank": -1, "finished": False, "status_at": -1 << 62, "status_rank": -1,
          "completed": 0, "failed": 0, "records": 0, "silent": False, "step": 0}
# By source: what is known of it, as bits.
_COMPLETED, _FAILED = 1, 2


class RunFold(StatefulProcessor):
    """State of one run: a row, and a map of its sources. Both are as large as the run
    has sources, whatever the number of its events."""

    def __init__(self, silent_ms: int | None) -> None:
        self.silent_ms = silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _RUN)
        self.sources = handle.getMapState("sources", "source string", "known int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.run.get()
        state = dict(zip(_FIELDS, held)) if held is not None else {**dict.fromkeys(_FIELDS), **_FIRST}
        for batch in rows:
            for e in batch.to_dict("records"):
                self._fold(state, e)
        state["silent"], state["step"] = False, state["step"] + 1
        self._watch(state, timerValues)
        self.run.update(tuple(state[f] for f in _FIELDS))
        yield self._row(key, state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.run.get()
        if held is None:
            return
        state = dict(zip(_FIELDS, held))
        if state["finished"]:
            return
        state["silent"], state["step"] = True, state["step"] + 1
        self.run.update(tuple(state[f] for f in _FIELDS))
        yield self._row(key, state)

    def _fold(self, state: dict, e: dict) -> None:
        attempt = int(e["attempt"])
        if state["attempt"] is None or attempt > state["attempt"]:
            # A later attempt at the run begins anew.
            state.update(_FIRST, attempt=attempt, last_event=None, status=None, step=state["step"])
            self.sources.clear()
        elif attempt < state["attempt"]:
            return
        at, rank = int(e["at"]), int(e["rank"])
        if (at, rank) > (state["last_at"], state["last_rank"]):
            state.update(last_event=e["event"], last_at=at, last_rank=rank)
        if e["event"] == "INGESTION_COMPLETED":
            state["finished"] = True
        if e["status"] is not None and (at, rank) > (state["status_at"], state["status_rank"]):
            state.update(status=e["status"], status_at=at, status_rank=rank)
        state["records"] += 0 if pd.isna(e["records"]) else int(e["records"])
        mark = {"SOURCE_COMPLETED": _COMPLETED, "SOURCE_FAILED": _FAILED}.get(e["event"], 0)
        if mark and e["source"] is not None:
            name = (e["source"],)
            known = self.sources.getValue(name)[0] if self.sources.containsKey(name) else 0
            if not known & mark:
                state["completed" if mark == _COMPLETED else "failed"] += 1
                self.sources.updateValue(name, (known | mark,))

    def _watch(self, state: dict, timers) -> None:
        if self.silent_ms is None:
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not state["finished"]:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.silent_ms)

    @staticmethod
    def _row(key, state: dict) -> pd.DataFrame:
        return pd.DataFrame({
            "run_id": [key[0]], "attempt": [state["attempt"]], "last_event": [state["last_event"]],
            "last_at": [pd.Timestamp(state["last_at"], unit="us", tz="UTC")], "finished": [state["finished"]], "status": [state["status"]],
            "sources_completed": [state["completed"]], "sources_failed": [state["failed"]],
            "records": [state["records"]], "silent": [state["silent"]], "step": [state["step"]]})

    def close(self) -> None:
        pass


def keyed_run_state(events: DataFrame, silent_after: float | None = None) -> DataFrame:
    """The state of each run of a stream of events after every micro-batch that changed it: what
    operators.events.run_state() folds at once, in any order of arrival. ``step`` counts a run's
    changes. With ``silent_after`` the query looks at its timers again and again, so it needs a trigger
    that goes on (not ``availableNow``). Events of a later ``attempt`` (1 where there is no such column) replace the earlier ones';
    a run that does not finish and has no event for ``silent_after`` seconds is given out as silent."""
    order = F.array(*[F.lit(e) for e in K.EVENT_TYPES])
    attempt = F.coalesce("attempt", F.lit(1)) if "attempt" in events.columns else F.lit(1)
    rows = events.filter(F.col("run_id").isNotNull()).select(
        "run_id", attempt.cast("int").alias("attempt"), "event", F.unix_micros("timestamp").alias("at"),
        F.array_position(order, F.col("event")).cast("int").alias("rank"), "source",
        F.col("records").cast("long").alias("records"), "status").filter("at is not null")
    return rows.groupBy("run_id").transformWithStateInPandas(
        statefulProcessor=RunFold(None if silent_after is None else int(1000 * silent_after)),
        outputStructType=FOLDED, outputMode="Update", timeMode="none" if silent_after is None else "processingTime")
