"""Runs of several stages: gating, a log of what happened, and what a watcher can tell of a run."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusloom.sources import files

STALL_SECONDS = 1500  # fixed value


@dataclass(frozen=True)
class Stage:
    """``work`` raises or returns False when it fails; the run ends there if the stage is ``required``."""

    name: str
    work: Callable[[], object]
    required: bool = True


def run_stages(spark: SparkSession, stages: list[Stage], log: str | None = None) -> dict[str, str]:
    """State of each stage (``done, failed, skipped``), in order; ``log`` is a folder for the events."""
    states: dict[str, str] = {}
    for stage in stages:
        if any(states[s.name] == "failed" and s.required for s in stages if s.name in states):
            states[stage.name], note = "skipped", "a required stage before it has failed"
        else:
            try:
                states[stage.name], note = ("failed", "it said no") if stage.work() is False else ("done", "")
            except Exception as e:  # noqa: BLE001  a stage may fail in any way; the log says how
                states[stage.name], note = "failed", str(e).splitlines()[0] if str(e) else type(e).__name__
        if log is not None:
            files.append_log(spark, log, stage.name, f"{states[stage.name]} {note}".strip())
    return states


def run_state(finished: Column, alive: Column, age_s: Column, limit_s: float = STALL_SECONDS) -> Column:
    """The first that holds: finished, gone, stalled, running.  An unknown age is no stall."""
    return F.when(finished, "finished").when(~alive, "gone").when(F.coalesce(age_s > limit_s, F.lit(False)), "stalled").otherwise("running")


LOG, EXIT, DONE = "log", "exit", "done"  # kinds of events of a run


class _Watch(StatefulProcessor):
    """State of one run: when it last wrote a log (in milliseconds), and what was told of it."""

    def __init__(self, limit_s: int):
        self.limit = limit_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms long, state string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ms, state = self.last.get() if self.last.exists() else (None, None)
        for row in sorted(rows, key=lambda r: (r.ms, r.kind)):
            if state == "finished" or (ms is not None and row.ms < ms and row.kind != DONE):
                continue
            if state == "running" and row.ms - ms > self.limit:
                state = "stalled"
                yield Row(run=key[0], ms=ms + self.limit, state=state)
            new = {LOG: "running", EXIT: "gone", DONE: "finished"}.get(row.kind, state)
            ms = row.ms
            if new != state:
                state = new
                yield Row(run=key[0], ms=ms, state=state)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if ms is not None:
            self.last.update((ms, state))
        if state == "running":
            self.handle.registerTimer(ms + self.limit + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ms, state = self.last.get()
        if state == "running":
            self.last.update((ms, "stalled"))
            yield Row(run=key[0], ms=ms + self.limit, state="stalled")


def watched(events: DataFrame, limit_s: int = STALL_SECONDS, delay: str = "0 seconds", clock: str = "EventTime") -> DataFrame:
    """``run, at, state`` whenever the state of a run changes, from a stream of ``run, at, kind``.

    A run is running once it writes a log, gone when its process is (``exit``), finished for good when it
    says so (``done``), and stalled when there is no event for longer than the limit: a timer of the run
    tells, so no event of its own is needed.  With the clock ``EventTime`` time is what the events of all
    runs say, less ``delay`` for late ones; with ``ProcessingTime`` it is the wall clock.
    Needs the RocksDB state store (see :func:`watch`).
    """
    timed = events.select("run", "at", F.unix_millis("at").alias("ms"), "kind")
    if clock == "EventTime":
        timed = timed.withWatermark("at", delay)
    changes = timed.groupBy("run").transformWithState(_Watch(limit_s), "run string, ms long, state string", "Update", clock)
    return changes.select("run", F.timestamp_millis("ms").alias("at"), "state")


def watch(events: DataFrame, out: str, checkpoint: str, limit_s: int = STALL_SECONDS) -> None:
    """Work off the events that are there, and write state changes to ``out``; the next call goes on."""
    spark, store = events.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        changes = watched(events, limit_s)
        write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")  # noqa: E731  a repeated batch replaces itself
        changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(store, before)


def newest_age(logs: DataFrame, age: str = "age_s") -> DataFrame:
    """One row: the age of the newest log, null without one."""
    return logs.agg(F.min(age).alias(age))
