"""State machines on streams: sessions by timers, state taken over, a time to live."""

import random
import time

import pytest

from millrace.session import cut_lineage
from millrace.streaming import processors, run

GAP = 1000


def spans_of(events):
    """{(id, start): (end, n)} of sessions by gaps."""
    out, last = {}, {}
    for t, i in sorted((t, i) for i, t in events):
        if i in last and t - out[last[i]][0] <= GAP:
            key = last[i]
            out[key] = (t, out[key][1] + 1)
        else:
            last[i] = (i, t)
            out[i, t] = (t, 1)
    return out


class Feed:
    """Batches given one after the other to one run of the session machine."""

    def __init__(self, spark, folder, initial=None, delay="0 seconds"):
        self.spark, self.folder, self.initial, self.delay = spark, folder, initial, delay
        self.out, self.checkpoint = f"{folder}/out", f"{folder}/checkpoint"

    def send(self, events):
        schema = "session_id string, at_ms long"
        self.spark.createDataFrame(events, schema).repartition(3).write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(schema).parquet(f"{self.folder}/in")
        machine = processors.session_machine(stream, GAP, self.initial, delay=self.delay)
        run.drain(machine, "update", checkpoint=self.checkpoint, out=self.out, settings=processors.ROCKSDB)
        self.schema = machine.schema
        return self

    def rows(self, expired):
        found = run.all_batches(self.spark, self.out, self.schema).where(f"expired = {str(expired).lower()}").collect()
        return {(r["id"], r["start_ms"]): (r["end_ms"], r["num_events"]) for r in found}

    def state(self):
        return cut_lineage(processors.session_state(self.spark, self.checkpoint))

    def open(self):
        return {(r["id"], r["start_ms"]): (r["end_ms"], r["n"]) for r in self.state().where("start_ms IS NOT NULL").collect()}


def test_sessions_end_by_their_timer_and_state_is_taken_over(spark, tmp_path):
    rng = random.Random(3)
    events = sorted(((rng.choice("aaaabcdef"), rng.randint(0, 40_000)) for _ in range(400)), key=lambda e: e[1])
    first = Feed(spark, tmp_path / "1").send(events[:100]).send(events[100:200])
    second = Feed(spark, tmp_path / "2", first.state()).send(events[200:300]).send(events[300:])
    ended, held, want = {**first.rows(True), **second.rows(True)}, second.open(), spans_of(events)
    assert {**ended, **held} == want and not set(ended) & set(held)
    mark = max(t for _, t in events[200:300])
    assert set(held) == {k for k, (end, _) in want.items() if end + GAP > mark}
    counts = {r["id"]: r["n"] for r in second.state().where("start_ms IS NULL").collect()}
    assert counts == {i: sum(k[0] == i for k in ended) for i in {k[0] for k in ended}}


def test_spans_out_of_order_join(spark, tmp_path):
    feed = Feed(spark, tmp_path, delay="1 hour").send([("a", 10), ("a", 5000), ("b", 100)])
    feed.send([("a", 1800), ("a", 900)]).send([("a", 2700), ("a", 3600), ("a", 4400)])
    assert feed.open() == {("a", 10): (5000, 7), ("b", 100): (100, 1)}
    assert feed.rows(True) == {}


def test_nulls_are_left_out_and_ids_with_equal_ends(spark, tmp_path):
    feed = Feed(spark, tmp_path).send([("a", 2), (None, 5), ("b", None), ("c", 2), ("a", 2), ("", 3)])
    assert feed.open() == {("a", 2): (2, 2), ("c", 2): (2, 1), ("", 3): (3, 1)}
    feed.send([("z", 50_000)]).send([("z", 50_001)])
    assert feed.rows(True) == {("a", 2): (2, 2), ("c", 2): (2, 1), ("", 3): (3, 1)}
    assert feed.open() == {("z", 50_000): (50_001, 2)}


def test_timers_by_the_clock(spark, tmp_path):
    """Without news for the gap a session is over, though nothing else arrives."""
    schema = "session_id string, at_ms long"
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 7)], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    job = run.Until(processors.session_machine(stream, GAP, event_time=False), "update", settings=processors.ROCKSDB)
    found = job.wait(lambda r: r.where("expired").count() >= 2).stop()
    got = {(r["id"], r["start_ms"], r["end_ms"], r["num_events"]) for r in found.where("expired").collect()}
    assert got == {("a", 1, 2, 2), ("b", 7, 7, 1)}


@pytest.mark.parametrize("ttl_ms, passed", [(600_000, 1), (1, 2)])
def test_first_seen_within_a_time_to_live(spark, tmp_path, ttl_ms, passed):
    schema = "value long, request string"
    for batch in ([(2, "r1"), (1, "r1"), (5, "r2")], [(3, "r1"), (9, "r3")]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        fresh = processors.first_seen(stream, "request", ttl_ms)
        run.drain(fresh, "update", checkpoint=str(tmp_path / "c"), out=str(tmp_path / "out"), settings=processors.ROCKSDB)
        time.sleep(0.01)
    got = run.all_batches(spark, str(tmp_path / "out"), fresh.schema).collect()
    assert sorted(r["value"] for r in got if r["request"] == "r1") == [1, 3][:passed]
    assert sorted(r["value"] for r in got if r["request"] != "r1") == [5, 9]


class _Handle:
    """A state handle in memory that counts the timers a key holds."""

    class _Map:
        def __init__(self):
            self.rows = {}

        def exists(self):
            return bool(self.rows)

        def iterator(self):
            return iter(list(self.rows.items()))

        def updateValue(self, key, value):
            self.rows[key] = value

        def removeKey(self, key):
            self.rows.pop(key, None)

        def clear(self):
            self.rows.clear()

    class _Value:
        def __init__(self):
            self.value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    def __init__(self):
        self.timers, self.map, self.value = set(), self._Map(), self._Value()

    def getMapState(self, *args):
        return self.map

    def getValueState(self, *args):
        return self.value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def test_a_key_holds_one_timer_and_all_sessions_due_end_together():
    from types import SimpleNamespace as NS

    from pyspark.sql import Row

    handle, machine = _Handle(), processors.Sessions(GAP)
    machine.init(handle)
    times = lambda wm: NS(getCurrentWatermarkInMs=lambda: wm, getCurrentProcessingTimeInMs=lambda: 0)
    spans = [Row(start_ms=0, end_ms=10, n=2), Row(start_ms=5000, end_ms=5000, n=1), Row(start_ms=9000, end_ms=9500, n=3)]
    opened = list(machine.handleInputRows(("a",), iter(spans), times(0)))
    assert [(r.start_ms, r.end_ms, r.num_events, r.expired) for r in opened] == [
        (0, 10, 2, False), (5000, 5000, 1, False), (9000, 9500, 3, False)]
    assert handle.timers == {10 + GAP}
    handle.timers.discard(10 + GAP)
    over = list(machine.handleExpiredTimer(("a",), times(6000), NS(getExpiryTimeInMs=lambda: 10 + GAP)))
    assert [(r.seq, r.start_ms, r.expired) for r in over] == [(1, 0, True), (2, 5000, True)]
    assert handle.timers == {9500 + GAP} and list(handle.map.rows) == [(9000,)]
    more = list(machine.handleInputRows(("a",), iter([Row(start_ms=10000, end_ms=10200, n=1)]), times(6000)))
    assert [(r.seq, r.start_ms, r.end_ms, r.num_events) for r in more] == [(2, 9000, 10200, 4)]
    assert handle.timers == {10200 + GAP}
