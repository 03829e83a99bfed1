"""Streams with state of their own: an inactivity timer, and a day cursor."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
RUNS = "key string, ms long, action string, open long"


class Inactivity(StatefulProcessor):
    """Decides when a harvest runs, from notices of tasks that were created and that ended.

    State of a key is four numbers: tasks that are open, those of them whose products may become inputs, the time of the
    last decision or notice, and the deadline. A row that ends the last open task runs a harvest. Without a notice for the
    pause, one is forced as long as an open task may feed an input, again after each further pause; else the key stops,
    until a notice comes. Rows come in any order within a batch and are taken by time; what a row finds overdue is decided
    before it, so cuts into batches make no difference as long as they follow time. Rows behind the watermark are dropped.
    """

    def __init__(self, pause_ms: int):
        self.pause = pause_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "open long, feeding long, deadline long")

    def load(self) -> list:
        return list(self.state.get()) if self.state.exists() else [0, 0, None]

    def overdue(self, now: int, state: list) -> Iterator[tuple[int, str, int]]:
        while state[2] is not None and state[2] <= now:
            if state[1] > 0:
                yield state[2], "force", state[0]
                state[2] += self.pause
            else:
                yield state[2], "stop", state[0]
                state[2] = None

    def keep(self, state: list, before: int | None) -> None:
        self.state.update(tuple(state))
        if before != state[2]:
            if before is not None:
                self.handle.deleteTimer(before)
            if state[2] is not None:
                self.handle.registerTimer(state[2])

    def found(self, key, rows: list[tuple[int, str, int]]) -> Iterator[pd.DataFrame]:
        if rows:
            yield pd.DataFrame(rows, columns=["ms", "action", "open"]).assign(key=key[0])[["key", "ms", "action", "open"]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """A key's notices of one batch as whole columns of numbers: in order of time, created before ended. Of those of one
        time and kind any order gives the same."""
        state = self.load()
        before, behind = state[2], timerValues.getCurrentWatermarkInMs()
        parts = [(p["ms"].to_numpy(np.int64), p["ended"].to_numpy(bool), p["feeds"].to_numpy(bool)) for p in rows]
        ms, ended, feeds = (np.concatenate(x) for x in zip(*parts, strict=True))
        place = np.lexsort((ended, ms))
        place = place[ms[place] >= behind]
        if len(place):
            ms, ended, feeds = ms[place], ended[place], feeds[place]
            step = np.where(ended, -1, 1)
            open_, feeding = state[0] + np.cumsum(step), state[1] + np.cumsum(step * feeds)
            out = [(k, 1, (int(ms[k]), "harvest", 0)) for k in np.flatnonzero(ended & (open_ == 0)).tolist()]
            for k in [0, *(np.flatnonzero(np.diff(ms) >= self.pause) + 1).tolist()]:  # where time may pass a deadline
                at = state if k == 0 else [int(open_[k - 1]), int(feeding[k - 1]), int(ms[k - 1]) + self.pause]
                out += [(k, 0, x) for x in self.overdue(int(ms[k]), at)]
            yield from self.found(key, [x for _, _, x in sorted(out, key=lambda o: o[:2])])
            state = [int(open_[-1]), int(feeding[-1]), int(ms[-1]) + self.pause]
        self.keep(state, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.load()
        before = state[2]
        yield from self.found(key, list(self.overdue(timerValues.getCurrentWatermarkInMs(), state)))
        if before is not None and before <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.update(tuple(state))
            if state[2] is not None:
                self.handle.registerTimer(state[2])
        else:
            self.keep(state, before)


def harvest_runs(notices: DataFrame, pause: datetime.timedelta, late: str) -> DataFrame:
    """key, ts, action (harvest, force, stop) and open of a stream of notices: key, task, feeds (whether its product may
    become an input), ended, ts. Each task is noticed once as created and once as ended."""
    some = notices.select(F.col("key").cast("string").alias("key"), "feeds", "ended", "ts", F.unix_millis("ts").alias("ms")).withWatermark("ts", late)
    found = some.groupBy("key").transformWithStateInPandas(Inactivity(round(pause.total_seconds() * 1000)), RUNS, "Append", "eventTime")
    return found.select("key", F.timestamp_millis("ms").alias("ts"), "action", "open")


DAYS = "key string, day date, kind string, n long, item string"


class DayCursor(StatefulProcessor):
    """Computes each day once, and only reports what comes for it later.

    State of a key is the newest day that was seen, the cursor (the last day computed) and a count for each open day, so
    its size follows the lag. After each batch the cursor goes on to the newest day less the lag, or by so many days a
    batch at most.
    """

    def __init__(self, lag: int, most: int | None):
        self.lag, self.most = lag, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.span = handle.getValueState("span", "newest long, cursor long")
        self.open = handle.getMapState("open", "day long", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest, cursor = self.span.get() if self.span.exists() else (None, None)
        seen: dict[int, int] = {}
        as_day = lambda n: datetime.date(1970, 1, 1) + datetime.timedelta(n)
        for r in rows:
            if cursor is not None and r.n_day <= cursor:
                yield Row(key=key[0], day=as_day(r.n_day), kind="late", n=1, item=r.item)
                continue
            seen[r.n_day] = seen.get(r.n_day, 0) + 1
            newest = r.n_day if newest is None else max(newest, r.n_day)
        for day, n in seen.items():
            had = self.open.getValue((day,))[0] if self.open.containsKey((day,)) else 0
            self.open.updateValue((day,), (had + n,))
        if newest is None:
            return
        days = sorted(k[0] for k in self.open.keys())  # as many as the lag at most, and those that this batch brought
        until = newest - self.lag
        if self.most is not None:
            until = min(until, (cursor if cursor is not None else min(days) - 1) + self.most)
        for day in [d for d in days if d <= until]:
            yield Row(key=key[0], day=as_day(day), kind="computed", n=self.open.getValue((day,))[0], item=None)
            self.open.removeKey((day,))
        self.span.update((newest, until if cursor is None else max(cursor, until)))


def day_cursor(items: DataFrame, lag: int, most: int | None = None) -> DataFrame:
    """key, day, kind, n, item of a stream of items (key, day, item): a computed row for each day with the items it had,
    and a late row for each item that came after its day was computed. Rows without a day are left out."""
    some = items.where("day is not null").select(F.col("key").cast("string").alias("key"), F.datediff("day", F.lit("1970-01-01")).cast("bigint").alias("n_day"), F.col("item").cast("string").alias("item"))
    return some.groupBy("key").transformWithState(DayCursor(lag, most), DAYS, "Append", "none")
