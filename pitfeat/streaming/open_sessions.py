"""Sessions on a stream as they are so far: open ones too, and corrected by late rows."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MICROS = 1_000_000
#: rows of a key that a task holds at a time
ROWS = 10_000
EPOCH, MICRO = datetime(1970, 1, 1, tzinfo=timezone.utc), timedelta(microseconds=1)
PROVISIONAL, WITHDRAWN, FINAL = "provisional", "withdrawn", "final"
_LOG = "session_start timestamp, session_end timestamp, number_of_hits long, status string, revision long"


def _micros(at: datetime) -> int:
    return (at - EPOCH) // MICRO


def _time(micros: int) -> datetime:
    return EPOCH + micros * MICRO


def spans(micros: np.ndarray, gap_s: int) -> list[tuple[int, int, int]]:
    """(first, last, rows) of the sessions of some times; pauses in whole seconds."""
    at = np.sort(micros)
    cut = np.flatnonzero(np.diff(at // MICROS) > gap_s) + 1
    bounds = [0, *cut.tolist(), len(at)]
    return [(int(at[i]), int(at[j - 1]), j - i) for i, j in zip(bounds, bounds[1:]) if j > i]


def joined(parts: list[tuple[int, int, int]], gap_s: int) -> list[tuple[int, int, int]]:
    """Spans at most the gap apart become one."""
    out: list[tuple[int, int, int]] = []
    for first, last, rows in sorted(parts):
        if out and first // MICROS - out[-1][1] // MICROS <= gap_s:
            a, b, n = out[-1]
            out[-1] = (a, max(b, last), n + rows)
        else:
            out.append((first, last, rows))
    return out


class SessionLog(StatefulProcessor):
    """Keeps the sessions of a key that a row may still join, and logs every change.

    A timer fires when the watermark has passed the end of a session by more than
    the gap: no row can join it any more, so it is final and leaves the state.

    Every read or write of state and every timer is a round trip to the executor. So the open
    sessions of a key are one value, and only the session that ends first has a timer: a key
    costs a few trips a batch, however many sessions it has. Rows are plain, as a pandas frame for
    the few rows of each key costs more than all that is done with them.
    """

    def __init__(self, key: list[str], t: str, gap_s: int):
        self.key, self.t, self.gap_s = key, t, gap_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # sessions: (first, last, hits) as 64-bit numbers; timer: the one set last
        self.state = handle.getValueState("open", "sessions binary, timer long, revision long")

    def _stored(self) -> tuple[dict[int, tuple[int, int]], int | None, int]:
        """Open sessions by their start, the timer and the next revision."""
        found = self.state.get()
        if found is None:
            return {}, None, 0
        rows = np.frombuffer(found[0], np.int64).reshape(-1, 3).tolist()
        return {a: (b, n) for a, b, n in rows}, found[1], found[2]

    def _passed_at(self, last: int) -> int:
        """The watermark in milliseconds from which no row can join a session that ends so."""
        return (last // MICROS + self.gap_s + 1) * 1000

    def _keep(self, sessions: dict[int, tuple[int, int]], timer: int | None, passed: int, revision: int) -> None:
        """Store the open sessions; a timer that lies ahead serves if it comes before any end."""
        due = min((self._passed_at(b) for b, _ in sessions.values()), default=None)
        if due is not None and not (timer is not None and passed < timer <= due):
            self.handle.registerTimer(due)
            timer = due
        rows = np.array([(a, b, n) for a, (b, n) in sessions.items()], np.int64)
        self.state.update((rows.tobytes(), None if due is None else timer, revision))

    def _log(self, key, rows: list[tuple[int, int, int, str]], revision: int) -> Iterator[Row]:
        line = Row(*self.key, "session_start", "session_end", "number_of_hits", "status", "revision")
        for a, b, n, status in rows:
            yield line(*key, _time(a), _time(b), n, status, revision)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh: list[tuple[int, int, int]] = []
        while part := [_micros(row[self.t]) for row in islice(rows, ROWS)]:
            fresh = joined(fresh + spans(np.array(part), self.gap_s), self.gap_s)
        stored, timer, revision = self._stored()
        now = joined([(a, b, n) for a, (b, n) in stored.items()] + fresh, self.gap_s)
        kept = {a: (b, n) for a, b, n in now}
        out = [(a, b, n, WITHDRAWN) for a, (b, n) in stored.items() if a not in kept]
        out += [(a, b, n, PROVISIONAL) for a, (b, n) in kept.items() if stored.get(a) != (b, n)]
        self._keep(kept, timer, timerValues.getCurrentWatermarkInMs(), revision + 1)
        yield from self._log(key, out, revision)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        stored, timer, revision = self._stored()
        done = [(a, b, n, FINAL) for a, (b, n) in stored.items() if self._passed_at(b) <= passed]
        kept = {a: (b, n) for a, (b, n) in stored.items() if self._passed_at(b) > passed}
        self._keep(kept, timer, passed, revision + bool(done))
        yield from self._log(key, done, revision)

    def close(self) -> None:
        pass


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep state in RocksDB, as timers need.

    The caller's own session keeps its settings.
    """
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    other.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    other.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return other


def session_log(events: DataFrame, by: list[str], t: str, gap_s: int, watermark: str) -> DataFrame:
    """A log of sessions by key: each change of a session is a row, open sessions included.

    ``status`` is 'provisional' for a session as it is so far, 'withdrawn' for one whose
    start has moved to an earlier row, 'final' once the watermark has passed it. Rows as late
    as the watermark allows reopen, lengthen or join sessions; later ones are dropped. Rows
    with a null key or time are left out. ``events`` belongs to a `stateful_session`.
    """
    known = events.select(*by, t).dropna().withWatermark(t, watermark)
    keys = [f"{f.name} {f.dataType.simpleString()}" for f in known.select(*by).schema.fields]
    return known.groupBy(*by).transformWithState(
        statefulProcessor=SessionLog(by, t, gap_s), outputStructType=", ".join([*keys, _LOG]),
        outputMode="Append", timeMode="EventTime")


def sessions_so_far(log: DataFrame, by: list[str]) -> DataFrame:
    """The newest state of every session in a log: start, end, hits and whether it is final."""
    newest = Window.partitionBy(*by, "session_start").orderBy(F.desc("revision"))
    last = log.withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    return last.where(F.col("status") != WITHDRAWN).select(
        *by, "session_start", "session_end", "number_of_hits", (F.col("status") == FINAL).alias("final"))
