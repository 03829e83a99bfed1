"""Streams with timers and cursors over several batches, with a restart, against plain simulation."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from cellweave.session import shared_path
from cellweave.streaming import status, timers

T0 = datetime.datetime(2024, 1, 1)


def notices(seed):
    rng = random.Random(seed)
    rows = []
    for key in "abc":
        at = T0
        for k in range(40):
            at += datetime.timedelta(seconds=rng.choice([1, 20, 59, 61, 200, 500]))
            rows.append((key, f"{key}{k}", rng.random() < 0.5, False, at))
            if rng.random() < 0.9:
                rows.append((key, f"{key}{k}", rows[-1][2], True, at + datetime.timedelta(seconds=rng.choice([3, 30, 90, 400]), milliseconds=7)))
    return sorted(rows, key=lambda r: r[4])


def simulated(rows, pause, until):
    out = []
    for key in {r[0] for r in rows}:
        tasks, deadline = {}, None

        def fire(now):
            nonlocal deadline
            while deadline is not None and deadline <= now:
                able = any(tasks.values())  # noqa: B023
                out.append((key, deadline, "force" if able else "stop", len(tasks)))  # noqa: B023
                deadline = deadline + pause if able else None

        for _, task, feeds, ended, ts in sorted((r for r in rows if r[0] == key), key=lambda r: (r[4], r[3], r[1])):
            fire(ts)
            if ended:
                del tasks[task]
                if not tasks:
                    out.append((key, ts, "harvest", 0))
            else:
                tasks[task] = feeds
            deadline = ts + pause
        fire(until)
    return sorted(out)


def save(spark, rows, schema, folder, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


@pytest.mark.parametrize("cuts", [(1,), (5, 60, 61)])
def test_inactivity_with_a_restart(spark, cuts):
    rows, schema = notices(4), "key string, task string, feeds boolean, ended boolean, ts timestamp"
    folder, places = shared_path(spark, "notices"), (shared_path(spark, "out"), shared_path(spark, "state"))
    runs = lambda: status.run_available(timers.harvest_runs(stream_of(spark, folder, schema), datetime.timedelta(seconds=60), "10 minutes"), places=places)
    edges = [0, *cuts, len(rows)]
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        save(spark, rows[a:b], schema, folder, f"part{k}")
        if k != 1 or k == len(edges) - 2:
            found = runs()  # each goes on from the one before; the second file waits for the third
    got = sorted((r.key, r.ts, r.action, r.open) for r in found.collect())
    assert got == simulated(rows, datetime.timedelta(seconds=60), rows[-1][4] - datetime.timedelta(minutes=10))
    assert {r[2] for r in got} == {"force", "harvest", "stop"}


def test_late_notices_are_dropped_and_state_stays_small(spark):
    schema = "key string, task string, feeds boolean, ended boolean, ts timestamp"
    folder = shared_path(spark, "notices")
    at = lambda s: T0 + datetime.timedelta(seconds=s)
    save(spark, [("a", "1", True, False, at(0)), ("a", "1", True, True, at(10))], schema, folder, "a")
    save(spark, [("b", "2", False, False, at(5000))], schema, folder, "b")
    save(spark, [("a", "3", True, False, at(20)), ("b", "2", False, True, at(5010))], schema, folder, "c")
    got = status.run_available(timers.harvest_runs(stream_of(spark, folder, schema), datetime.timedelta(seconds=60), "1 minute"))
    assert sorted((r.key, (r.ts - T0).total_seconds(), r.action) for r in got.collect()) == [("a", 10.0, "harvest"), ("a", 70.0, "stop"), ("b", 5010.0, "harvest")]


def cursor_by_hand(batches, lag, most):
    out, newest, cursor, open_ = [], {}, {}, {}
    for batch in batches:
        for key in sorted({r[0] for r in batch}):
            for _, day, item in [r for r in batch if r[0] == key and r[1]]:
                if key in cursor and day <= cursor[key]:
                    out.append((key, day, "late", 1, item))
                    continue
                open_.setdefault(key, {}).setdefault(day, []).append(item)
                newest[key] = max(newest.get(key, day), day)
            if key not in newest:
                continue
            until = newest[key] - datetime.timedelta(lag)
            if most:
                until = min(until, cursor.get(key, min(open_[key], default=until) - datetime.timedelta(1)) + datetime.timedelta(most))
            for day in sorted(d for d in open_[key] if d <= until):
                out.append((key, day, "computed", len(open_[key].pop(day)), None))
            cursor[key] = max(cursor.get(key, until), until)
    return sorted(out, key=str)


@pytest.mark.parametrize("lag,most", [(0, None), (2, None), (1, 1)])
def test_day_cursor_reports_what_is_late(spark, lag, most):
    rng = random.Random(lag)
    schema, folder = "key string, day date, item string", shared_path(spark, "items")
    day = lambda k: (T0 + datetime.timedelta(k)).date()
    batches = [[(rng.choice("ab"), day(max(0, b - rng.choice([0, 0, 0, 1, 3, 5]))), f"{b}-{k}") for k in range(12)] for b in range(6)]
    batches[2].append(("a", None, "none"))
    for b, rows in enumerate(batches):
        save(spark, rows, schema, folder, f"b{b}")
    got = status.run_available(timers.day_cursor(stream_of(spark, folder, schema), lag, most)).collect()
    assert sorted((tuple(r) for r in got), key=str) == cursor_by_hand(batches, lag, most)
    assert {r.kind for r in got} == {"late", "computed"}


def events_in_files(spark, batches):
    schema, folder = "event_id long, user_id long, event_type string, ts timestamp", shared_path(spark, "events")
    for b, rows in enumerate(batches):
        save(spark, [(i, u, k, T0 + datetime.timedelta(minutes=m)) for i, u, k, m in rows], schema, folder, f"b{b}")
    return stream_of(spark, folder, schema), (folder, schema)


def test_windows_close_once_and_late_rows_stay_out(spark):
    events, _ = events_in_files(spark, [[(1, 1, "a", 5), (2, 1, "b", 65)], [(3, 1, "a", 20), (4, 1, "a", 300)], [(6, 1, "a", 301)], [(5, 1, "a", 50), (7, 1, "a", 1000)]])
    got = status.run_available(status.per_window(events.withWatermark("ts", "60 minutes"), "1 hour")).collect()
    assert sorted(((r.start - T0).total_seconds() / 3600, r.event_type, r.n) for r in got) == [(0, "a", 2), (1, "b", 1), (5, "a", 2)]  # event 5 came after its hour was closed; the last hour is still open


def test_gate_and_bursts_are_decided_in_the_stream(spark):
    rows = [[(k, 1, "a", k) for k in range(5)], [(9, 1, "a", 61), (10, 2, "a", 500)], [(11, 2, "a", 5000)]]
    events, _ = events_in_files(spark, rows)
    gate = status.run_available(status.volume_gate(events.withWatermark("ts", "10 minutes"), "1 hour", 2)).collect()
    assert [((r.start - T0).total_seconds(), r.n) for r in gate] == [(0.0, 5)]
    events, _ = events_in_files(spark, rows)
    bursts = status.run_available(status.bursts(events.withWatermark("ts", "10 minutes"), "30 minutes")).collect()
    assert sorted((r.user_id, (r.start - T0).total_seconds() / 60, (r.idle_at - T0).total_seconds() / 60, r.n) for r in bursts) == [(1, 0, 34, 5), (1, 61, 91, 1), (2, 500, 530, 1)]


def test_upserts_go_on_after_a_restart(spark):
    events, (folder, schema) = events_in_files(spark, [[(1, 1, "view", 1), (2, 2, "error", 2)], [(3, 1, "error", 3)]])
    places = (shared_path(spark, "out"), shared_path(spark, "state"))
    first = status.run_available(status.current_status(events), "update", places=places, keys=["user_id"])
    assert {r.user_id: r.status for r in first.collect()} == {1: "error", 2: "error"}
    save(spark, [(4, 2, "purchase", T0 + datetime.timedelta(minutes=9)), (5, 1, "view", T0)], schema, folder, "later")
    again = status.run_available(status.current_status(stream_of(spark, folder, schema)), "update", places=places, keys=["user_id"])
    assert {r.user_id: r.status for r in again.collect()} == {1: "error", 2: "purchase"}
    batches = spark.read.parquet(places[0]).groupBy("batch").count().collect()
    assert sum(r["count"] for r in batches) == 5  # a batch writes the keys that it changed, not all


def test_a_batch_of_notices_is_taken_as_columns():
    """Many notices of one key, in pieces of any order: the rows and the state are those of a plain loop."""
    import numpy as np
    import pandas as pd

    class State(dict):
        exists = lambda self: "now" in self
        get = lambda self: self["now"]
        update = lambda self, x: self.__setitem__("now", x)

    class Times:
        getCurrentWatermarkInMs = lambda self: 50

    class Handle:
        deleteTimer = registerTimer = lambda self, ms: None

    rng = np.random.default_rng(1)
    n = 3000
    made = pd.DataFrame({"ms": rng.integers(0, 90000, n), "feeds": rng.random(n) < 0.1, "ended": False})
    rows = pd.concat([made, made.assign(ms=made["ms"] + rng.integers(1, 40, n), ended=True)]).sample(frac=1, random_state=2)
    rows = pd.concat([rows, pd.DataFrame({"ms": [200000], "feeds": [True], "ended": [False]})])
    processor = timers.Inactivity(60)
    processor.handle, processor.state = Handle(), State()
    got = pd.concat(processor.handleInputRows(("k",), iter([rows[:2500], rows[2500:]]), Times()))
    open_, feeding, deadline, want = 0, 0, None, []
    for r in sorted((r for r in rows.itertuples() if r.ms >= 50), key=lambda r: (r.ms, r.ended)):
        while deadline is not None and deadline <= r.ms:
            want.append((deadline, "force" if feeding > 0 else "stop", open_))
            deadline = deadline + 60 if feeding > 0 else None
        open_, feeding, deadline = open_ + (-1 if r.ended else 1), feeding + (0 if not r.feeds else -1 if r.ended else 1), r.ms + 60
        if r.ended and open_ == 0:
            want.append((r.ms, "harvest", 0))
    assert list(got[["ms", "action", "open"]].itertuples(index=False, name=None)) == want and {x[1] for x in want} >= {"harvest", "stop"}
    assert processor.state["now"] == (open_, feeding, deadline)
