"""sessionize: sessions share hash buckets, one Python call per bucket and batch, and each keeps its own timeout."""

import pandas as pd
from conftest import rows
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import jobs, run


class _Held:
    def __init__(self, now, state=None, timed_out=False):
        self.now, self.state, self.hasTimedOut, self.duration = now, state, timed_out, None

    @property
    def exists(self):
        return self.state is not None

    @property
    def get(self):
        return self.state

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, state):
        self.state = state

    def setTimeoutDuration(self, ms):
        self.duration = ms

    def remove(self):
        self.state = None


def _part(*data):
    return pd.DataFrame(data, columns=["session_id", "n", "first", "last"])


def test_one_call_keeps_every_session_of_its_bucket_and_times_each_out_alone():
    run_ = jobs._bucket_of_sessions(1000)
    held = _Held(100)
    out = pd.concat(run_((7,), iter([_part(("a", 2, 10, 30), ("b", 1, 5, 5)), _part(("a", 1, 3, 40))]), held))
    assert sorted(map(tuple, out.values.tolist())) == [("a", 37, 3, False), ("b", 0, 1, False)]
    assert held.duration == 1000
    held.now = 600
    out = pd.concat(run_((7,), iter([_part(("b", 2, 1, 9))]), held))
    assert sorted(map(tuple, out.values.tolist())) == [("b", 4, 3, False)]
    assert held.duration == 500
    held.now, held.hasTimedOut = 1101, True
    out = pd.concat(run_((7,), iter([]), held))
    assert sorted(map(tuple, out.values.tolist())) == [("a", 37, 3, True)]
    assert held.state[0] == ["b"] and held.duration == 499


def test_many_sessions_are_kept_in_at_most_the_buckets(spark):
    path, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "checkpoint")
    data = [(f"s{i % 3000}", 1000 * i) for i in range(6000)]
    spark.createDataFrame(data, "session_id string, at_ms long").write.parquet(path)
    stream = spark.readStream.schema("session_id string, at_ms long").parquet(path)
    job = jobs.sessionize(stream, 3_600_000)
    got = run.latest_update(run.all_batches(spark, run.drain(job, "update", checkpoint=checkpoint), job.schema), ["id"])
    want = spark.createDataFrame(data, "session_id string, at_ms long").groupBy(F.col("session_id").alias("id")).agg(
        (F.max("at_ms") - F.min("at_ms")).alias("duration_ms"), F.count("*").alias("num_events"), F.lit(False).alias("expired"))
    assert rows(got) == rows(want)
    assert spark.read.format("statestore").load(checkpoint).count() <= jobs.SESSION_BUCKETS
