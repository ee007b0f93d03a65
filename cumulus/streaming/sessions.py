"""Sessions on a stream with arbitrary state and timers.

``session_window`` reports a session once it can't change any more, so what
is still open when a stream stops, or lives on for days, is never seen. Here
the open sessions are state: every batch reports the sessions that it opened
or changed (status ``open``), an event-time timer reports each one a last
time when the watermark passes its end (``closed``) and frees its state, a
session that was joined to an earlier one is withdrawn (``gone``), and an
event too late for any session becomes a row of its own (``late``), so that
sessions and late rows together account for every event.

Keys are dealt over a fixed number of buckets. A bucket is one state entry:
the open sessions of its keys, merged with a batch's events in one vectorised
step, and one timer for the session that ends first. ``buckets`` belongs to
the checkpoint and can't change with a restart; take a few times as many as
tasks. State is bounded by the sessions that the watermark leaves open.

Read the newest row of a (key, session start) with ``latest_sessions``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cumulus.session import BASE_CONF
from cumulus.streaming.streams import WATERMARK, read_latest, run_to_log, with_event_time

OPEN, CLOSED, GONE, LATE = "open", "closed", "gone", "late"
BUCKETS = 64
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = BASE_CONF[PROVIDER]
_SPAN = ["first", "last", "n"]  # first and last event in microseconds, number of events


def merged(sessions: pd.DataFrame, keys: list[str], gap: int) -> pd.DataFrame:
    """Sessions (keys, first, last, n) with those of a key at most ``gap``
    apart joined."""
    if sessions.empty:
        return sessions
    key = sessions.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    s = sessions.assign(_key=key).sort_values(["_key", "first"], kind="stable", ignore_index=True)
    ended = s.groupby("_key")["last"].cummax().shift(1)
    begins = (s["_key"] != s["_key"].shift(1)) | (s["first"] - ended > gap)
    out = s.groupby(begins.cumsum().to_numpy(), sort=False).agg({"first": "min", "last": "max", "n": "sum"})
    names = s.loc[begins.to_numpy(), keys].reset_index(drop=True)
    return pd.concat([names, out.reset_index(drop=True)], axis=1)


class SessionProcessor(StatefulProcessor):
    def __init__(self, keys: Sequence[str], state: str, gap: int):
        self.keys, self.state, self.gap = list(keys), state, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("sessions", self.state)

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        old = self._read()
        now, late = old, []
        for part in rows:
            part = pd.DataFrame({**{k: part[k].astype(object) for k in self.keys}, "first": part["us"], "last": part["us"], "n": 1})
            too_late = part["last"] + self.gap <= passed
            late.append(part[too_late].assign(status=LATE))
            now = merged(pd.concat([now, part[~too_late]], ignore_index=True), self.keys, self.gap)
        name = [*self.keys, "first"]
        both = now.merge(old, on=name, how="outer", suffixes=("", "_old"), indicator=True)
        changed = both[(both["_merge"] == "left_only") | ((both["_merge"] == "both") & (both["n"] != both["n_old"]))]
        gone = both[both["_merge"] == "right_only"]
        gone = gone.assign(last=gone["last_old"], n=gone["n_old"])
        self._write(now)
        yield self._out(pd.concat([changed.assign(status=OPEN), gone.assign(status=GONE), *late], ignore_index=True))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        old = self._read()
        over = self._end_ms(old["last"]) <= timerValues.getCurrentWatermarkInMs()
        self._write(old[~over])
        yield self._out(old[over].assign(status=CLOSED))

    def _end_ms(self, last: Any) -> Any:
        return -(-(last + self.gap) // 1000)

    def _read(self) -> pd.DataFrame:
        rows = pd.DataFrame(list(self.held.get()), columns=[*self.keys, *_SPAN])
        return rows.astype({**{k: object for k in self.keys}, **{c: "int64" for c in _SPAN}})

    def _write(self, sessions: pd.DataFrame) -> None:
        """Keeps the sessions, with a timer for the one that ends first; a
        timer left over from an earlier end finds nothing to close."""
        if sessions.empty:
            self.held.clear()
            return
        kept = sessions.astype({c: object for c in _SPAN})  # plain integers for the state's rows
        self.held.put(list(kept[[*self.keys, *_SPAN]].itertuples(index=False, name=None)))
        self.handle.registerTimer(int(self._end_ms(sessions["last"].min())))

    def _out(self, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[[*self.keys, *_SPAN, "status"]].astype({c: "int64" for c in _SPAN})
        return out.astype({c: object for c in [*self.keys, "status"]})


def session_updates(events: DataFrame, time_col: str, keys: Sequence[str], gap_seconds: int,
                    delay: str = WATERMARK, buckets: int = BUCKETS) -> DataFrame:
    """The stream of session rows: the keys, session_start, session_end,
    num_hits and status. A gap of exactly ``gap_seconds`` merges."""
    gap = int(gap_seconds) * 1_000_000
    timed = with_event_time(events, time_col, delay)
    # Only the microseconds go on: with the event-time column itself Spark
    # would drop late rows before they are seen.
    timed = timed.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"), *keys,
                         F.unix_micros(F.col(time_col)).alias("us"))
    kinds = {f.name: f.dataType.simpleString() for f in timed.schema}
    state = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"{c} bigint" for c in _SPAN)])
    # The process that prepares the state need not have this package on its path.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    out = timed.groupBy("_bucket").transformWithStateInPandas(
        SessionProcessor(keys, state, gap), outputStructType=state + ", status string", outputMode="Update",
        timeMode="EventTime")
    end = F.col("last") + F.when(F.col("status") == LATE, 0).otherwise(gap)
    return out.select(*keys, F.timestamp_micros("first").alias("session_start"), F.timestamp_micros(end).alias("session_end"),
                      F.col("n").alias("num_hits"), "status")


def run_sessions(updates: DataFrame, base: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None, wait: bool = True):
    """Runs ``session_updates`` into an epoch log; returns (query, base).
    State of this kind lives in the RocksDB store only. A query that is waited
    for gets it for its own run, and the session's setting is put back; one
    that goes on needs a session that has it (``get_session`` does)."""
    conf = updates.sparkSession.conf
    before = conf.get(PROVIDER)
    if before != ROCKSDB and not wait:
        raise ValueError(f"{PROVIDER} must be {ROCKSDB}")
    conf.set(PROVIDER, ROCKSDB)
    try:
        return run_to_log(updates, "update", base, checkpoint, trigger, wait=wait)
    finally:
        conf.set(PROVIDER, before)


def latest_sessions(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The sessions as of the newest epoch, each with its status."""
    log = read_latest(spark, base, [*keys, "session_start"], where=F.col("status") != LATE)
    return log.where(F.col("status") != GONE)


def late_events(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The events that came too late, one row each, with their time."""
    rows = spark.read.parquet(base).where(F.col("status") == LATE)
    return rows.select(*keys, F.col("session_start").alias("event_time"))
