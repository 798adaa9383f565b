"""Running counts, sums, sessions, a changelog and a stream-to-table join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import split_java
from ..operators import changelog
from ..operators.joins import join_hot, join_salted
from ..session import scratch_path

# Fixed value: a session without data for this long is over.
SESSION_TIMEOUT_MS = 10_000


def read_json(spark: SparkSession, schema, folder: str) -> DataFrame:
    """Stream a folder of JSON files under an explicit schema."""
    return spark.readStream.schema(schema).json(folder)


def word_counts(lines: DataFrame) -> DataFrame:
    """Count per word so far; for complete mode."""
    return lines.select(F.explode(split_java(F.col("value"))).alias("value")).groupBy("value").count()


def word_events(lines: DataFrame) -> DataFrame:
    """Line and time to one event per word: (session_id, timestamp)."""
    return lines.select(F.explode(split_java(F.col("value"))).alias("session_id"), "timestamp")


def key_sums(pushes: DataFrame) -> DataFrame:
    """Sum per key so far; for update or complete mode."""
    return pushes.groupBy("key").agg(F.sum("val").alias("val"))


def join_static(stream: DataFrame, table: DataFrame, hot: list[tuple[object, int]] = ()) -> DataFrame:
    """Records joined to a stored table on ``key``; both copies stay, no state is kept.

    Micro-batches run without adaptive execution. ``hot`` names the keys known to have many records and the number of parts that
    each is dealt over (:func:`~millrace.operators.joins.hot_keys` of earlier records); only their table rows are copied.
    """
    other = table.toDF(*[f"s_{c}" for c in table.columns])
    return join_salted(stream, other, "key", "s_key", list(hot))


def join_static_batches(table: DataFrame, path: str):
    """The same join as a ``foreachBatch`` sink that spreads the hot keys of each batch."""
    other = table.toDF(*[f"s_{c}" for c in table.columns])

    def write(batch: DataFrame, batch_id: int) -> None:
        join_hot(batch, other, "key", "s_key").write.mode("overwrite").parquet(
            f"{path}/batch_id={batch_id}")

    return write


# --- sessions -------------------------------------------------------------

def _partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.groupby("session_id", as_index=False)["at_ms"].agg(
            n="count", first="min", last="max")


def stateful(stream: DataFrame, key: str, update: Callable, show: Callable, output: str, state: str,
             timeout_ms: int = SESSION_TIMEOUT_MS) -> DataFrame:
    """State per key of a stream, kept by user functions.

    ``update(key, frames, old)`` takes the key's rows of a batch as pandas frames and the old state (None at first)
    and returns the new state, a tuple of the ``state`` schema. ``show(key, state, expired)`` gives the row
    of the ``output`` schema that each batch reports for the key. A key without rows for ``timeout_ms`` is
    shown once more as expired, and its state is removed.
    """
    columns = [f.split(" ")[0] for f in output.split(", ")]

    def run(keys, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        expired = held.hasTimedOut
        if expired:
            now = held.get
            held.remove()
        else:
            now = update(keys[0], parts, held.get if held.exists else None)
            held.update(now)
            held.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame([show(keys[0], now, expired)], columns=columns)

    return stream.groupBy(key).applyInPandasWithState(
        run, output, state, "update", GroupStateTimeout.ProcessingTimeTimeout)


def _add_to_session(key, parts: Iterator[pd.DataFrame], old: tuple | None) -> tuple:
    """Count adds, the end only rises, the start is never lowered once it is stored."""
    n, first, last = 0, [], []
    for part in parts:
        n += int(part["n"].sum())
        first.append(int(part["first"].min()))
        last.append(int(part["last"].max()))
    if old is None:
        return n, min(first), max(last)
    return old[0] + n, old[1], max(old[2], *last)


def _session_row(key, state: tuple, expired: bool) -> tuple:
    count, start, end = state
    return key, end - start, count, expired


#: Buckets of sessions of :func:`sessionize`; a checkpoint holds to the number it was started with.
SESSION_BUCKETS = 1024
_HELD = ["id", "count", "start", "end", "seen"]
_SESSION_OUT = ["id", "duration_ms", "num_events", "expired"]


def _bucket_of_sessions(timeout_ms: int) -> Callable:
    """The sessions of one bucket side by side, each as :func:`_add_to_session` keeps it and with its own timeout.

    ``seen`` is the processing time of a session's last rows; one without rows for ``timeout_ms`` is shown once more as
    expired and removed. The bucket's timeout is that of its oldest session, so it is called when that one is due.
    """

    def run(keys, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        now = held.getCurrentProcessingTimeMs()
        old = pd.DataFrame(dict(zip(_HELD, held.get)) if held.exists else {c: [] for c in _HELD})
        old = old.astype({"id": object, "count": "int64", "start": "int64", "end": "int64", "seen": "int64"}).set_index("id")
        frames = [p for p in parts if len(p)]
        new = (pd.concat(frames).groupby("session_id").agg(count=("n", "sum"), start=("first", "min"), end=("last", "max"))
               if frames else old.iloc[:0, :3])
        both = new.index.intersection(old.index)
        new.loc[both, "count"] += old.loc[both, "count"]
        new.loc[both, "start"] = old.loc[both, "start"]
        new.loc[both, "end"] = np.maximum(new.loc[both, "end"], old.loc[both, "end"])
        new["seen"] = now
        rest = old.drop(index=both)
        due = rest["seen"] + timeout_ms < now
        live = pd.concat([rest[~due], new]).astype("int64")
        if len(live):
            held.update(tuple([list(live.index), *(live[c].tolist() for c in _HELD[1:])]))
            held.setTimeoutDuration(max(1, int(live["seen"].min()) + timeout_ms - now))
        else:
            held.remove()
        shown = pd.concat([new.assign(expired=False), rest[due].assign(expired=True)])
        yield pd.DataFrame({"id": shown.index.astype(object), "duration_ms": (shown["end"] - shown["start"]).astype("int64"),
                            "num_events": shown["count"].astype("int64"), "expired": shown["expired"].astype(bool)},
                           columns=_SESSION_OUT)

    return run


def sessionize(events: DataFrame, timeout_ms: int = SESSION_TIMEOUT_MS) -> DataFrame:
    """Session updates of (session_id, at_ms) events: id, duration, count, expired.

    Events are counted per Arrow batch before they are shuffled, so a hot
    session sends a few rows per task and not all of its events. Sessions are
    kept in hash buckets, so a batch makes one Python call per bucket and not one per session.
    """
    parts = events.select("session_id", "at_ms").mapInPandas(
        _partials, "session_id string, n long, first long, last long")
    keyed = parts.withColumn("_bucket", F.pmod(F.xxhash64("session_id"), F.lit(SESSION_BUCKETS)))
    return keyed.groupBy("_bucket").applyInPandasWithState(
        _bucket_of_sessions(timeout_ms), "id string, duration_ms long, num_events long, expired boolean",
        "ids array<string>, counts array<long>, starts array<long>, ends array<long>, seen array<long>",
        "update", GroupStateTimeout.ProcessingTimeTimeout)


# --- changelog ------------------------------------------------------------

class ChangelogTable:
    """Key/value state kept from a stream of log batches.

    Each batch adds its own fold and its clients' highest request ids, in
    folders named by batch, so a repeated batch replaces itself. Every ``MARKS``
    batches the ids are folded, so a batch reads one fold and fewer than that many
    batches of ids, however long the stream has run. ``compact`` starts a new table from the joined parts;
    batches it covers are passed over there, so a repeated one changes nothing.
    Batches arrive in log order; inside a batch the log index gives the order.
    """

    MARKS = 16
    _PARTS = "key string, segment long, piece int, has_put boolean, text string"
    _MARK_ROWS = "client long, mark long"

    def __init__(self, spark: SparkSession, path: str | None = None,
                 bits: int = changelog.SEGMENT_BITS):
        self.spark, self.bits = spark, bits
        self.path = path or scratch_path(spark, "changelog")

    def _written(self, name: str) -> dict[int, str]:
        """Complete folders ``name/N`` by N."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return {}
        done = lambda p: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        found = [s.getPath() for s in fs.listStatus(root)]
        return {int(p.getName()): p.toString() for p in found if done(p)}

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def covered(self) -> int:
        """The last batch that the table was compacted from; -1 if it wasn't."""
        return max(self._written("base_marks"), default=-1)

    def _marks_before(self, batch_id: int) -> DataFrame:
        folds = {n: p for n, p in (self._written("base_marks") | self._written("mark_folds")).items() if n < batch_id}
        start = max(folds, default=-1)
        paths = [p for n, p in self._written("marks").items() if start < n < batch_id]
        return self._read(paths + ([folds[start]] if folds else []), self._MARK_ROWS).groupBy("client").agg(
            F.max("mark").alias("mark"))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Fold one batch; for ``foreachBatch``."""
        if batch_id <= self.covered():
            return
        batch = batch.persist()
        fresh = changelog.dedupe(batch, self._marks_before(batch_id))
        changelog.fold_segments(fresh, self.bits).write.mode("overwrite").parquet(f"{self.path}/parts/{batch_id}")
        changelog.client_marks(batch).write.mode("overwrite").parquet(f"{self.path}/marks/{batch_id}")
        batch.unpersist()
        if batch_id % self.MARKS == self.MARKS - 1:
            self._marks_before(batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/mark_folds/{batch_id}")

    def _parts(self) -> DataFrame:
        base, covered = self._written("base_parts"), self.covered()
        parts = [(-1, base[covered])] if covered in base else []
        parts += [(n, p) for n, p in self._written("parts").items() if n > covered]
        named = [self._read([p], self._PARTS).withColumn("part", F.lit(n).cast("long")) for n, p in parts]
        none = self.spark.createDataFrame([], self._PARTS + ", part long")
        return reduce(DataFrame.unionByName, named) if named else none

    def state(self) -> DataFrame:
        """(key, segment, piece, value) after all batches so far."""
        parts = self._parts()
        return changelog.live(changelog.merge_parts(parts), parts.where("has_put"))

    def compact(self, path: str) -> "ChangelogTable":
        """The same state as the base of a table at ``path``; later batches go on from there."""
        other = ChangelogTable(self.spark, path, self.bits)
        last = max([self.covered(), *self._written("parts")])
        if last >= 0:
            changelog.merge_parts(self._parts()).write.mode("overwrite").parquet(f"{path}/base_parts/{last}")
            self._marks_before(last + 1).write.mode("overwrite").parquet(f"{path}/base_marks/{last}")
        return other
