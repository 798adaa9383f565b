"""State machines on streams: keyed sessions with timers, and rows that are new within a time to live.

State is kept in RocksDB, so a task's memory doesn't bound the number of keys; it can be read as a table and handed to a later run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle,
                                                      TimerValues)

# Settings of a query that uses these.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SESSION = "id string, seq long, start_ms long, end_ms long, num_events long, expired boolean"
_SPAN = "id string, start_ms long, end_ms long, n long, at timestamp"


class Sessions(StatefulProcessor):
    """Sessions of a key: spans of events no further than ``gap_ms`` apart.

    Map state holds the open sessions by their start, value state how many were closed; each open session is due at its
    end plus the gap, and the key has one timer, at the soonest of these. In event time it fires once the watermark is
    there, and every session due by then is over; spans that come in time but out of order join the sessions they reach,
    and may join two to one. In processing time a session is due by the clock, as for a reader that waits ``gap_ms`` for news.
    :class:`SessionBuckets` is the same for many ids at once.
    """

    def __init__(self, gap_ms: int, event_time: bool = True):
        self.gap, self.event_time = gap_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start_ms long", "end_ms long, n long, timer long")
        self.closed = handle.getValueState("closed", "seq long")

    def _due(self, end: int, times: TimerValues) -> int:
        return (end if self.event_time else times.getCurrentProcessingTimeInMs()) + self.gap

    def _now(self, times: TimerValues) -> int:
        """The time up to which timers fire in this batch: a timer at or before it is expired."""
        return times.getCurrentWatermarkInMs() if self.event_time else times.getCurrentProcessingTimeInMs()

    def handleInitialState(self, key, initialState, timerValues: TimerValues) -> None:
        """A row of the state table: an open session, or the number of closed ones where start_ms is null."""
        if initialState.start_ms is None:
            self.closed.update((initialState.n,))
        else:
            timer = self._due(initialState.end_ms, timerValues)
            self.handle.registerTimer(timer)
            self.open.updateValue((initialState.start_ms,), (initialState.end_ms, initialState.n, timer))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held = {start: tuple(value) for (start,), value in self.open.iterator()} if self.open.exists() else {}
        spans = sorted([(r.start_ms, r.end_ms, r.n) for r in rows] + [(s, e, n) for s, (e, n, _) in held.items()])
        merged: list[list[int]] = []
        for start, end, n in spans:
            if merged and start - merged[-1][1] <= self.gap:
                merged[-1][1], merged[-1][2] = max(merged[-1][1], end), merged[-1][2] + n
            else:
                merged.append([start, end, n])
        kept = {s: (e, n) for s, e, n in merged}
        changed = {s: v for s, v in kept.items() if held.get(s, (None, None))[:2] != v}
        for start in held:
            if start not in kept:
                self.open.removeKey((start,))
        timers = {s: t for s, (_, _, t) in held.items() if s in kept and s not in changed}
        seq = self.closed.get()[0] if changed and self.closed.exists() else 0
        for start, (end, n) in changed.items():
            timers[start] = self._due(end, timerValues)
            self.open.updateValue((start,), (end, n, timers[start]))
            yield Row(id=key[0], seq=seq, start_ms=start, end_ms=end, num_events=n, expired=False)
        before = min((t for _, _, t in held.values()), default=None)
        soonest = min(timers.values(), default=None)
        if before != soonest:
            if before is not None:
                self.handle.deleteTimer(before)
            if soonest is not None:
                self.handle.registerTimer(soonest)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        due = max(expiredTimerInfo.getExpiryTimeInMs(), self._now(timerValues))
        held = sorted((timer, start, end, n) for (start,), (end, n, timer) in self.open.iterator()) if self.open.exists() else []
        over = [h for h in held if h[0] <= due]
        if not over:
            return
        seq = self.closed.get()[0] if self.closed.exists() else 0
        if len(over) == len(held):
            self.open.clear()
        for _, start, end, n in over:
            if len(over) < len(held):
                self.open.removeKey((start,))
            seq += 1
            yield Row(id=key[0], seq=seq, start_ms=start, end_ms=end, num_events=n, expired=True)
        self.closed.update((seq,))
        if len(over) < len(held):
            self.handle.registerTimer(held[len(over)][0])

    def close(self) -> None:
        pass


def _packed(table: pa.Table) -> bytes:
    """A table as one Arrow stream; any column type and nulls come back as they were."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(packs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packs]).combine_chunks()


def _rows_of_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("pack").to_pylist():
            yield from pa.ipc.open_stream(data)


_OPEN = pa.schema([("id", pa.string()), *((c, pa.int64()) for c in ("start_ms", "end_ms", "n", "timer"))])
_CLOSED = pa.schema([("id", pa.string()), ("seq", pa.int64())])


class SessionBuckets(Sessions):
    """:class:`Sessions` for the ids of a bucket side by side, with spans in frames.

    One value state holds the open sessions of all these ids, another how many each id closed, both packed; a bucket and
    batch cost a read and a write of each, not some calls per session. The bucket has one timer, at the soonest of its sessions.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "pack binary")
        self.closed = handle.getValueState("closed", "pack binary")

    @staticmethod
    def _read(state, schema: pa.Schema) -> pd.DataFrame:
        return (_unpacked([state.get()[0]]) if state.exists() else schema.empty_table()).to_pandas()

    @staticmethod
    def _write(state, rows: pd.DataFrame, schema: pa.Schema) -> None:
        if len(rows):
            state.update((_packed(pa.Table.from_pandas(rows, schema, preserve_index=False).replace_schema_metadata()),))
        elif state.exists():
            state.clear()

    def _closed(self) -> pd.Series:
        return self._read(self.closed, _CLOSED).set_index("id")["seq"]

    def _keep(self, held: pd.DataFrame, before: pd.DataFrame) -> None:
        """Store the open sessions; the timer moves when the soonest of them does."""
        self._write(self.open, held, _OPEN)
        was, soonest = (int(f["timer"].min()) if len(f) else None for f in (before, held))
        if was != soonest:
            if was is not None:
                self.handle.deleteTimer(was)
            if soonest is not None:
                self.handle.registerTimer(soonest)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """Rows of the state table, with ``is_open`` for a null start_ms."""
        before = self._read(self.open, _OPEN)
        opened = initialState[initialState["is_open"]]
        opened = opened.assign(timer=self._due(opened["end_ms"], timerValues))[_OPEN.names]
        self._keep(pd.concat([before, opened]).drop_duplicates(["id", "start_ms"], keep="last"), before)
        closed = initialState.loc[~initialState["is_open"], ["id", "n"]].set_axis(_CLOSED.names, axis=1)
        if len(closed):
            self._write(self.closed, pd.concat([self._read(self.closed, _CLOSED), closed]).drop_duplicates("id", keep="last"), _CLOSED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        held = self._read(self.open, _OPEN)
        spans = [held, *(frame[_OPEN.names[:-1]].assign(timer=0) for frame in rows)]
        ids = np.concatenate([f["id"].to_numpy(object) for f in spans])
        start, end, n, timer = (np.concatenate([f[c].to_numpy("int64") for f in spans]) for c in _OPEN.names[1:])
        code, _ = pd.factorize(ids)
        order = np.lexsort((n, end, start, code))
        ids, code, start, end, n, timer, new = (a[order] for a in (ids, code, start, end, n, timer, np.arange(len(ids)) >= len(held)))
        # In order of start, an id's furthest end so far is that of its last session.
        reach = pd.Series(end).groupby(code).cummax().to_numpy()
        news = np.bincount(code, new) > 0  # the sessions of other ids stay as they are
        first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (start[1:] - reach[:-1] > self.gap)] | ~news[code])
        kept = pd.DataFrame({"id": ids[first], "start_ms": start[first], "end_ms": np.maximum.reduceat(end, first),
                             "n": np.add.reduceat(n, first), "timer": timer[first]})
        changed = np.logical_or.reduceat(new, first) | (np.diff(np.r_[first, len(ids)]) > 1)
        kept.loc[changed, "timer"] = self._due(kept.loc[changed, "end_ms"], timerValues)
        self._keep(kept, held)
        shown = kept[changed]
        seq = self._closed().reindex(shown["id"], fill_value=0).to_numpy()
        yield self._rows(shown, seq, False)

    @staticmethod
    def _rows(sessions: pd.DataFrame, seq: np.ndarray, expired: bool) -> pd.DataFrame:
        return pd.DataFrame({"id": sessions["id"].to_numpy(object), "seq": seq, "start_ms": sessions["start_ms"].to_numpy(),
                             "end_ms": sessions["end_ms"].to_numpy(), "num_events": sessions["n"].to_numpy(), "expired": expired})

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = max(expiredTimerInfo.getExpiryTimeInMs(), self._now(timerValues))
        held = self._read(self.open, _OPEN)
        is_over = held["timer"] <= due
        if not is_over.any():
            return
        over, left, closed = held[is_over].sort_values(["timer", "start_ms"]), held[~is_over], self._closed()
        count = over.groupby("id").cumcount().to_numpy() + 1
        seq = closed.reindex(over["id"], fill_value=0).to_numpy() + count
        self._write(self.open, left, _OPEN)
        counted = pd.concat([closed, pd.Series(seq, index=over["id"])]).groupby(level=0).max()
        self._write(self.closed, pd.DataFrame({"id": counted.index, "seq": counted.to_numpy()}), _CLOSED)
        if len(left):
            self.handle.registerTimer(int(left["timer"].min()))
        yield self._rows(over, seq, True)


#: Buckets of ids of :func:`session_machine`; a checkpoint holds to the number it was started with.
SESSION_BUCKETS = 1024


def _spans(gap_ms: int):
    """Per Arrow batch, the spans of each id: a hot id sends few rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, at = batch.column("session_id").dictionary_encode(), batch.column("at_ms").to_numpy()
            code = ids.indices.to_numpy()
            order = np.lexsort((at, code))
            code, at = code[order], at[order]
            starts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (at[1:] - at[:-1] > gap_ms)])
            stops = np.r_[starts[1:], len(at)]
            last = pa.array(at[stops - 1])
            yield pa.RecordBatch.from_arrays([
                ids.dictionary.take(pa.array(code[starts])), pa.array(at[starts]), last, pa.array(stops - starts),
                pa.compute.multiply(last, 1000).cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))],
                ["id", "start_ms", "end_ms", "n", "at"])

    return work


def session_machine(events: DataFrame, gap_ms: int, initial: DataFrame | None = None, event_time: bool = True,
                    delay: str = "0 seconds") -> DataFrame:
    """Rows of SESSION for a stream of (session_id, at_ms): open sessions as they change, and each once more when it is over.

    ``initial`` is a table as :func:`session_state` gives it: the sessions a former run left open are gone on with. Events
    with null id or time are left out. In event time, times are after 1970: a watermark starts there, and what is not behind it is late.
    """
    spans = events.where("session_id IS NOT NULL AND at_ms IS NOT NULL").select("session_id", "at_ms").mapInArrow(_spans(gap_ms), _SPAN)
    if event_time:
        spans = spans.withWatermark("at", delay)
    bucket = F.pmod(F.xxhash64("id"), F.lit(SESSION_BUCKETS)).alias("_bucket")
    if initial is not None:
        whole = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("start_ms", "end_ms")]
        initial = initial.select(bucket, "id", F.col("start_ms").isNotNull().alias("is_open"), *whole, "n").groupBy("_bucket")
    return spans.select(bucket, *spans.columns).groupBy("_bucket").transformWithStateInPandas(
        SessionBuckets(gap_ms, event_time), SESSION, "Update", "EventTime" if event_time else "ProcessingTime", initialState=initial)


def session_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """id, start_ms, end_ms, n: the sessions a run left open, and with null start_ms the number it closed, from its checkpoint."""
    read = lambda name, rows: (spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
                               .select("value.pack").mapInArrow(_rows_of_packs, rows))
    null = F.lit(None).cast("long")
    held = read("open", "id string, start_ms long, end_ms long, n long, timer long").drop("timer")
    return held.union(read("closed", "id string, seq long").select("id", null, null, "seq"))


class FirstSeen(StatefulProcessor):
    """Passes the first row of a key; the key is forgotten ``ttl_ms`` after that, by the clock.

    The grouping key is a bucket of keys: its list state holds (key, at_ms) of each key seen, every element with its own
    time to live, and is read and added to in one call per bucket and batch rather than a few calls per key.
    :class:`FirstSeenPacks` is the same for rows that come packed.
    """

    def __init__(self, ttl_ms: int, columns: list[str], key_type: str = "string"):
        self.ttl, self.columns, self.key_type = ttl_ms, columns, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", f"k {self.key_type}, at_ms long", self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        first: dict = {}
        for r in rows:
            row = tuple(r[c] for c in self.columns)
            if row[0] not in first or row < first[row[0]]:
                first[row[0]] = row
        known = {k for k, _ in self.seen.get()} if self.seen.exists() else set()
        fresh = [row for k, row in first.items() if k not in known]
        if fresh:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.seen.appendList([(row[0], now) for row in fresh])
        for row in fresh:
            yield Row(**dict(zip(self.columns, row)))

    def close(self) -> None:
        pass


def _least(table: pa.Table, columns: list[str]) -> pa.Table:
    """The least row by all columns of each key; the key is the first column and nulls come last."""
    if any(pa.types.is_nested(table.schema.field(c).type) for c in columns):
        rows = list(zip(*([(v is None, v) for v in table.column(c).to_pylist()] for c in columns)))
        table = table.take(sorted(range(len(rows)), key=rows.__getitem__))
    else:
        table = table.sort_by([(c, "ascending") for c in columns])
    keys = table.column(columns[0]).combine_chunks().dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
    return table.filter(pa.array(np.r_[True, keys[1:] != keys[:-1]]))


# A pack is made of so many rows or bytes of a task's input at most.
_PACK_ROWS, _PACK_BYTES = 1 << 18, 32 << 20


def _packs(columns: list[str]):
    """Rows with a bucket to one pack per bucket and stretch of the input, with one row per key: a hot key sends few rows."""
    def pack(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _least(pa.Table.from_batches(held), columns).sort_by("_bucket")
        bucket = table.column("_bucket").to_numpy()
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        rows = table.select(columns).combine_chunks()
        data = [_packed(rows.slice(a, b - a)) for a, b in zip(starts, np.r_[starts[1:], len(bucket)])]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int64()), pa.array(data, pa.binary())], ["_bucket", "pack"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= _PACK_ROWS or sum(b.nbytes for b in held) >= _PACK_BYTES:
                yield from pack(held)
                held = []
        if held:
            yield from pack(held)

    return work


class FirstSeenPacks(FirstSeen):
    """:class:`FirstSeen` for a bucket's rows in packs: all keys of a bucket are looked up side by side.

    An element of the list state is the pack of the keys that one batch passed. They have one time of passing, so the
    element's time to live is that of each of them.
    """

    def __init__(self, ttl_ms: int, columns: list[str]):
        super().__init__(ttl_ms, columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "pack binary, at_ms long", self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        fresh = _least(_unpacked([p for frame in rows for p in frame.iloc[:, -1]]), self.columns)
        name = self.columns[0]
        known = [pack for pack, _ in self.seen.get()] if self.seen.exists() else []
        if known:
            fresh = fresh.filter(pc.invert(pc.is_in(fresh.column(name), value_set=_unpacked(known).column(name).combine_chunks())))
        if fresh.num_rows:
            self.seen.appendValue((_packed(fresh.select([name])), timerValues.getCurrentProcessingTimeInMs()))
            yield pd.DataFrame({"pack": [_packed(fresh)]})


#: Buckets of keys of :func:`first_seen`; a checkpoint holds to the number it was started with.
FIRST_SEEN_BUCKETS = 1024


def first_seen(stream: DataFrame, key: str, ttl_ms: int) -> DataFrame:
    """The rows of ``stream`` whose key wasn't seen in the last ``ttl_ms``; of several in a batch, the least by all columns."""
    columns = [key, *[c for c in stream.columns if c != key]]
    rows = stream.select(*columns)
    keyed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(FIRST_SEEN_BUCKETS)))
    packs = keyed.mapInArrow(_packs(columns), "_bucket long, pack binary")
    fresh = packs.groupBy("_bucket").transformWithStateInPandas(FirstSeenPacks(ttl_ms, columns), "pack binary", "Update", "ProcessingTime")
    return fresh.mapInArrow(_rows_of_packs, rows.schema)
