"""The session machine keeps a bucket of ids side by side; it does what Sessions does for each id on its own."""

import random
from types import SimpleNamespace as NS

import pandas as pd
from pyspark.sql import Row
from test_processors import GAP, Feed, _Handle

from millrace.streaming import processors


class _Counted:
    """A value state that counts reads and writes."""

    def __init__(self):
        self.value, self.calls = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.value = None


class _Bucket:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, *args):
        return self.states.setdefault(name, _Counted())

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def _times(mark):
    return NS(getCurrentWatermarkInMs=lambda: mark, getCurrentProcessingTimeInMs=lambda: 0)


def _alone(batches, initial):
    """What each id's own machine gives, by batch."""
    machines, out = {}, []

    def machine(i):
        if i not in machines:
            machines[i] = processors.Sessions(GAP), _Handle()
            machines[i][0].init(machines[i][1])
        return machines[i]

    for i, is_open, start, end, n in initial:
        machine(i)[0].handleInitialState((i,), Row(start_ms=start if is_open else None, end_ms=end, n=n), _times(0))
    for mark, spans in batches:
        found = []
        for i in sorted({s[0] for s in spans}):
            rows = iter([Row(start_ms=s, end_ms=e, n=n) for j, s, e, n in spans if j == i])
            found += machine(i)[0].handleInputRows((i,), rows, _times(mark))
        for i, (m, handle) in machines.items():
            for timer in sorted(t for t in handle.timers if t <= mark):
                found += m.handleExpiredTimer((i,), _times(mark), NS(getExpiryTimeInMs=lambda t=timer: t))
                handle.timers.discard(timer)
        out.append(sorted(tuple(r) for r in found))
    return out


def _together(batches, initial):
    machine, handle, out = processors.SessionBuckets(GAP), _Bucket(), []
    machine.init(handle)
    if initial:
        machine.handleInitialState((3,), pd.DataFrame(initial, columns=["id", "is_open", "start_ms", "end_ms", "n"]), _times(0))
    for mark, spans in batches:
        frames = [pd.DataFrame(part, columns=["id", "start_ms", "end_ms", "n"]) for part in (spans[::2], spans[1::2]) if part]
        found = list(machine.handleInputRows((3,), iter(frames), _times(mark))) if frames else []
        assert len(handle.timers) <= 1
        for timer in [t for t in handle.timers if t <= mark]:
            found += machine.handleExpiredTimer((3,), _times(mark), NS(getExpiryTimeInMs=lambda t=timer: t))
            handle.timers.discard(timer)
        out.append(sorted(tuple(r) for f in found for r in f.itertuples(index=False)))
    return out, handle


def test_a_bucket_gives_what_its_ids_give_alone():
    for seed in range(8):
        rng = random.Random(seed)
        batches = []
        for mark in (0, 4000, 9000, 9000, 30_000, 90_000):
            at = [(rng.choice(["a", "b", "", "ü", "e"]), rng.randrange(mark, mark + 12_000)) for _ in range(rng.randrange(40))]
            batches.append((mark, [(i, t, t + rng.choice([0, 5, 700, 2500]), rng.randrange(1, 4)) for i, t in at]))
        initial = [("a", True, 100, 300, 2), ("a", True, 2000, 2000, 1), ("a", False, 0, 0, 7), ("x", True, 5, 50, 4)] if seed % 2 else []
        got, _ = _together(batches, initial)
        assert got == _alone(batches, initial)


def test_calls_of_state_do_not_grow_with_the_sessions():
    def calls(sessions):
        spans = [(f"u{k}", 10_000 + 3 * k, 10_000 + 3 * k, 1) for k in range(sessions)]
        got, handle = _together([(0, spans), (10**9, [])], [])
        assert [len(rows) for rows in got] == [sessions, sessions]
        return sum(s.calls for s in handle.states.values())

    assert calls(500) == calls(5)


def test_a_stored_run_keeps_rows_of_state_by_bucket(spark, tmp_path):
    ids = [f"u{k}" for k in range(3000)]
    feed = Feed(spark, tmp_path).send([(i, 10 + k % 700) for k, i in enumerate(ids)])
    assert feed.open() == {(i, 10 + k % 700): (10 + k % 700, 1) for k, i in enumerate(ids)}
    stored = spark.read.format("statestore").option("stateVarName", "open").load(feed.checkpoint).count()
    assert 0 < stored <= processors.SESSION_BUCKETS < len(ids)
