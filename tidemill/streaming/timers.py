"""Alerts from event-time timers: keyed state that ends by itself."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemill.streaming.runs import use_rocksdb

_SESSIONS = T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("first", "last", "n")])
#: rows of a key that are merged at a time
_ROWS = 10_000


def merged_sessions(sessions: Sequence[tuple[int, int, int]], times: np.ndarray, gap: int) -> list[tuple[int, int, int]]:
    """Sessions (first, last, rows) with more rows at ``times``; rows less than ``gap`` apart are one session."""
    edges = sorted([*sessions, *_runs(np.sort(times), gap)])
    out: list[tuple[int, int, int]] = []
    for first, last, n in edges:
        if out and first < out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def _runs(times: np.ndarray, gap: int) -> list[tuple[int, int, int]]:
    if not len(times):
        return []
    cut = np.flatnonzero(np.diff(times) >= gap) + 1
    begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(times)]))
    return [(int(times[a]), int(times[b - 1]), int(b - a)) for a, b in zip(begin, end)]


class SilenceAlerts(StatefulProcessor):
    """Keeps the open sessions of a key and one timer, at the end of the one that closes first; nothing once the last one has
    closed.  What a key costs does not grow with its sessions: each call of a timer closes all that the watermark has passed."""

    def __init__(self, silence_us: int):
        self.silence = silence_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _SESSIONS)

    def _due(self, last: int) -> int:
        """When a session is over: the millisecond that timers and the watermark know."""
        return (last + self.silence) // 1000

    def _sessions(self) -> list[tuple[int, int, int]]:
        held = self.open.get()
        return [] if held is None else list(zip(*held))

    def _keep(self, sessions: list[tuple[int, int, int]]) -> None:
        self.open.update(tuple(map(list, zip(*sessions))))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = sessions = self._sessions()
        times = (r[-1] for r in rows)
        while part := list(islice(times, _ROWS)):
            sessions = merged_sessions(sessions, np.array(part, np.int64), self.silence)
        self._keep(sessions)
        # sessions are in order of time: the first one closes first
        old, new = (self._due(s[0][1]) if s else None for s in (before, sessions))
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # the sessions whose own timers would have expired in this batch
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        sessions = self._sessions()
        over = [s for s in sessions if self._due(s[1]) <= now]
        left = sessions[len(over) :]
        if left:
            self._keep(left)
            self.handle.registerTimer(self._due(left[0][1]))
        else:
            self.open.clear()
        if over:
            yield Row(*(f"k{i}" for i in range(len(key))), "last", "n")(*key, [s[1] for s in over], [s[2] for s in over])

    def close(self) -> None:
        pass


def silence_alerts(
    source: DataFrame, keys: Sequence[str], time_col: str, silence: str, lateness: str, important: Column | None = None
) -> DataFrame:
    """One alert per key and silence, as :func:`~tidemill.streaming.runs.silent_keys` gives them: no row for ``silence`` after
    ``last_seen``.  The alert comes from an event-time timer; a key without an open session has no state.

    Rows may come in any order within ``lateness``; later ones are left out.  A row in the gap joins two sessions, and the
    alert between them is not given.  Rows of a key are taken in by batches of bounded size,
    and a key with many open sessions is called once for all that are over.
    """
    use_rocksdb(source)
    silence_us = source.sparkSession.range(1).select((F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {silence}"))).alias("s")).first()["s"]
    rows = source if important is None else source.filter(important)
    narrow = rows.withWatermark(time_col, lateness).select(*keys, time_col, F.unix_micros(time_col).alias("_at"))
    kinds = [T.StructField(f"k{i}", narrow.schema[k].dataType) for i, k in enumerate(keys)]
    out = T.StructType([*kinds, *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("last", "n"))])
    alerts = narrow.groupBy(*keys).transformWithState(
        statefulProcessor=SilenceAlerts(silence_us), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )
    named = [F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]
    each = alerts.select(*named, F.explode(F.arrays_zip("last", "n")).alias("_s"))
    last = F.col("_s.last")
    return each.select(
        *keys, F.timestamp_micros(last).alias("last_seen"), F.timestamp_micros(last + silence_us).alias("alert_at"), F.col("_s.n").alias("n")
    )
