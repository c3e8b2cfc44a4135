"""Status events and live progress of runs, as batches and as streams.

An event is sent unless the last one sent for its run had the same status and phase and is too recent. Terminal events are
always sent and not remembered. The clock is the events' own, so that a replay gives the same result. This compares
with the last event *sent*, so it is a fold in the order of (ts, event_id): each run's events are read in order, one at a
time, with a state of three values.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: Fixed values.
TERMINAL = frozenset(("succeeded", "failed", "canceled", "cancelled", "dead_letter"))
INTERVAL_SECONDS, KEEP_SECONDS = 5.0, 172_800
EVENT = "run_id string, event_id long, ts timestamp, status string, phase string"


def _passes(state: tuple | None, ts: pd.Timestamp, status: str, phase: str, seconds: float) -> tuple[bool, tuple | None]:
    """(sent, new state) for one event; the state is (time, status, phase) of the last event sent and remembered."""
    if status in TERMINAL:
        return True, state
    if state and state[1] == status and state[2] == phase and (ts - state[0]).total_seconds() < seconds:
        return False, state
    return True, (ts, status, phase)


def _clean(events: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))
    rows = events.select(text("run_id").alias("run_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"), text("status").alias("status"), text("phase").alias("phase"))
    return rows.filter("run_id <> ''")


def throttled(events: DataFrame, seconds: float = INTERVAL_SECONDS) -> DataFrame:
    """The events that are sent, of a table (run_id, event_id, ts, status, phase)."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, state = None, None
        for batch in batches:
            keep = []
            for e in batch.itertuples(index=False):
                if e.run_id != run:
                    run, state = e.run_id, None
                sent, state = _passes(state, e.ts, e.status, e.phase, seconds)
                keep.append(sent)
            yield batch[keep]

    return _clean(events).repartition("run_id").sortWithinPartitions("run_id", "ts", "event_id").mapInPandas(fold, EVENT)


def throttled_stream(events: DataFrame, seconds: float = INTERVAL_SECONDS) -> DataFrame:
    """The same of a stream; within a micro-batch events are taken in the order of (ts, event_id). A run's state is given up
    KEEP_SECONDS after its last event, on the watermark's clock, and events that late are dropped. A micro-batch's events of one run are held by one task: bound them with the
    source's maxFilesPerTrigger.
    """

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get if state.exists else None
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "event_id"])
        known, keep = (tuple(last) if last else None), []
        for e in rows.itertuples(index=False):
            sent, known = _passes(known, e.ts, e.status, e.phase, seconds)
            keep.append(sent)
        if known:
            state.update(known)
            state.setTimeoutTimestamp(max(int(known[0].timestamp() * 1000), state.getCurrentWatermarkMs()) + KEEP_SECONDS * 1000)
        yield rows[keep][["run_id", "event_id", "ts", "status", "phase"]]

    rows = _clean(events).withWatermark("ts", f"{KEEP_SECONDS} seconds")
    return rows.groupBy("run_id").applyInPandasWithState(fold, EVENT, "ts timestamp, status string, phase string", "append", GroupStateTimeout.EventTimeTimeout)


UPDATE = (
    "run_id string, event_id long, updated_at timestamp, started_at timestamp, importer string, source string, confidence string, status string, phase string, "
    "unit string, message string, label string, done double, total double, pct double, elapsed_seconds double, eta_seconds double"
)
LIVE = (
    "run_id string, updated_at timestamp, started_at timestamp, importer string, source string, confidence string, status string, phase string, unit string, "
    "message string, label string, done double, total double, pct double, eta_seconds double, estimated_finish_at timestamp, stale boolean"
)
UPDATE_FIELDS, LIVE_FIELDS = ([tuple(c.split()) for c in text.split(", ")] for text in (UPDATE, LIVE))
NOTHING, SHOWN = {n: None for n, _ in UPDATE_FIELDS}, Row(*[n for n, _ in LIVE_FIELDS])
NUMBERS = frozenset(n for n, t in UPDATE_FIELDS if t == "double")
AT_ONCE = 10_000
DEFAULTS = {"importer": "unknown", "source": "import-live-progress", "confidence": "live", "status": "running"}
CARRIED = ("importer", "source", "confidence")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATE_SECONDS, STALE_SECONDS, MICROS = 3600.0, 90, 1_000_000


def carried(before: dict | None, update: dict) -> dict:
    """What an update leaves for the next one: its time, its start, importer, source and confidence.

    An update takes over from the one before, unless that is KEEP_SECONDS old or the update has neither a start nor both
    counts and knows its importer: the earliest start, and what it does not know itself.
    """
    now = {"at": update["updated_at"], "started_at": update["started_at"]} | {c: DEFAULTS[c] if update[c] is None else update[c] for c in CARRIED}
    joins = update["started_at"] is not None or (update["done"] is not None and update["total"] is not None) or now["importer"] == "unknown"
    if before is None or not joins or now["at"] - before["at"] > KEEP_SECONDS * MICROS:
        return now
    for c in CARRIED:
        if now[c] in ("", "unknown"):
            now[c] = before[c] or now[c]
    starts = [x for x in (before["started_at"], now["started_at"]) if x is not None]
    return now | {"started_at": min(starts, default=None)}


def merged_late(before: dict | None, update: dict) -> dict:
    """The same for an update that is older than what was kept apart: it can only add an earlier start, and what is not known
    yet.
    """
    if before is None or before["at"] - update["updated_at"] > KEEP_SECONDS * MICROS:
        return before or carried(None, update)
    starts = [x for x in (before["started_at"], update["started_at"]) if x is not None]
    known = {c: update[c] if before[c] in ("", "unknown") and update[c] not in (None, "") else before[c] for c in CARRIED}
    return before | known | {"started_at": min(starts, default=None)}


def _shown(run: object, update: dict, kept: dict, stale: bool = False) -> Row:
    """The row of LIVE of a run's last update."""
    status = update["status"] or DEFAULTS["status"]
    ended = status.lower() in TERMINAL
    done, total, pct, eta = (update[c] for c in ("done", "total", "pct", "eta_seconds"))
    if pct is None and done is not None and total is not None and total > 0:
        pct = 100.0 * done / total
    if pct is not None:
        pct = 100.0 if ended else max(0.0, min(pct, 99.9))
    if eta is not None and not math.isfinite(eta):
        eta = None
    if eta is None and not ended and done is not None and total is not None and total > done > 0:
        spent = update["elapsed_seconds"]
        if spent is None and kept["started_at"] is not None:
            spent = (update["updated_at"] - kept["started_at"]) / MICROS
        if spent is not None and spent > 0:
            eta = (total - done) * spent / done
    if ended and done is None:
        done = total
    finish = update["updated_at"] + round(eta * MICROS) if eta is not None and eta >= 0 else None
    return SHOWN(run, update["updated_at"], kept["started_at"], *(kept[c] for c in CARRIED), status, *(update[c] for c in ("phase", "unit", "message", "label")), done, total, pct, eta, finish, stale)


class LiveProgress(StatefulProcessor):
    """A run's state is what updates up to a time left (`kept`), and the updates since then (`recent`), as JSON. Updates are
    kept apart for `late` seconds, so that those which arrive in another order give what they give in theirs. State is given
    up KEEP_SECONDS after its last change, by the clock.
    """

    def __init__(self, late: float) -> None:
        self.late = late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "row string", KEEP_SECONDS * 1000)
        self.recent = handle.getListState("recent", "row string", KEEP_SECONDS * 1000)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        kept, recent = self._state()
        for some in itertools.batched(rows, AT_ONCE):
            recent += [_plain(r["update"]) for r in some]
            recent, kept = self._settled(recent, kept)
        self.recent.put([(json.dumps(u),) for u in recent])
        if kept is not None:
            self.kept.update((json.dumps(kept),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + STALE_SECONDS * 1000)
        yield self._last(key, recent, kept)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        kept, recent = self._state()
        if recent:
            yield self._last(key, recent, kept, stale=True)

    def _state(self) -> tuple[dict | None, list[dict]]:
        kept = self.kept.get()
        return json.loads(kept[0]) if kept else None, [json.loads(x[0]) for x in self.recent.get()]

    def close(self) -> None:
        pass

    def _settled(self, recent: list[dict], kept: dict | None) -> tuple[list[dict], dict | None]:
        recent = sorted(recent, key=lambda u: (u["updated_at"], u["event_id"]))
        until = recent[-1]["updated_at"] - self.late * MICROS
        for u in [u for u in recent[:-1] if u["updated_at"] <= until]:
            kept = merged_late(kept, u) if kept is not None and u["updated_at"] < kept["at"] else carried(kept, u)
        return [u for u in recent[:-1] if u["updated_at"] > until] + recent[-1:], kept

    @staticmethod
    def _last(key: tuple, recent: list[dict], kept: dict | None, stale: bool = False) -> Row:
        for u in recent:
            kept = carried(kept, u)
        return _shown(key[0], recent[-1], kept, stale)


def _plain(written: str) -> dict:
    """An update from JSON, in which what is null is left out and numbers that are not finite are texts."""
    out = NOTHING | json.loads(written)
    return out | {c: float(v) for c, v in out.items() if c in NUMBERS and isinstance(v, str)}


def live_progress_stream(updates: DataFrame, late_seconds: float = LATE_SECONDS) -> DataFrame:
    """The progress of every run of a stream of updates (some columns of UPDATE), whenever it changes: the last update, with
    what those before it left. `stale` rows come STALE_SECONDS after a run's last batch, by the clock.

    Updates may come in any order: within `late_seconds` of a run's last one they give what they would give in order, and
    later ones still add their start and what is not known yet. None is dropped.

    Needs the RocksDB state store. With timers by the clock there is always another batch, so that a trigger that ends when
    all is read needs batches without data switched off (see read_to_end).
    """
    have = set(updates.columns)
    columns = [F.col(n).cast(t).alias(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in UPDATE_FIELDS]
    rows = updates.select(*columns).filter("updated_at is not null and trim(run_id) <> ''").withColumns({"run_id": F.trim("run_id"), "event_id": F.coalesce("event_id", F.lit(0))})
    # one text for each update: cells cost Python more than what is in them
    plain = {"timestamp": F.unix_micros, "double": lambda c: F.when(~F.isnan(c), c)}
    update = F.to_json(F.struct(*[plain.get(t, F.col)(F.col(n) if t in plain else n).alias(n) for n, t in UPDATE_FIELDS if n in have - {"run_id"} | {"event_id"}]))
    found = rows.select("run_id", update.alias("update")).groupBy("run_id").transformWithState(LiveProgress(late_seconds), LIVE.replace("timestamp", "long"), "Update", "ProcessingTime")
    return found.withColumns({n: F.timestamp_micros(n) for n, t in LIVE_FIELDS if t == "timestamp"})


def read_to_end(spark: SparkSession, writer: DataStreamWriter) -> None:
    """Runs a stream with timers by the clock until all that is there has been read."""
    settings = {"spark.sql.streaming.noDataMicroBatches.enabled": "false", "spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
