"""Streaming jobs over several micro-batches."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.times import epoch_ms
from millrace.operators import changelog
from millrace.session import scratch_path
from millrace.sources import kafka
from millrace.streaming import jobs, run


def second(s):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)


def put(spark, path, data, schema, mode="append"):
    spark.createDataFrame(data, schema).coalesce(1).write.mode(mode).parquet(path)


def test_word_count_over_batches(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [("a b ",), ("a",)], "value string")
    put(spark, path, [("b b  c",), ("   ",)], "value string")
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(path)
    counts = jobs.word_counts(lines)
    out = run.drain(counts, "complete")
    assert rows(run.latest_batch(spark, out, counts.schema)) == [("", 1), ("a", 2), ("b", 3), ("c", 1)]


def test_sums_over_batches(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [(1, 5), (2, 1)], "key long, val long")
    put(spark, path, [(1, 7)], "key long, val long")
    stream = spark.readStream.schema("key long, val long").option("maxFilesPerTrigger", 1).parquet(path)
    sums = jobs.key_sums(stream)
    updates = run.all_batches(spark, run.drain(sums, "update"), sums.schema)
    assert rows(run.latest_update(updates, ["key"])) == [(1, 12), (2, 1)]


def sessions(spark, path, timeout_ms):
    lines = spark.readStream.schema("value string, timestamp timestamp_ntz").parquet(path)
    words = jobs.word_events(lines).select("session_id", epoch_ms(F.col("timestamp")).alias("at_ms"))
    return run.Until(jobs.sessionize(words, timeout_ms), "update")


EVENTS = "value string, timestamp timestamp_ntz"


def test_sessions_and_timeout(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [("u", second(0)), ("u", second(4)), ("v", second(1))], EVENTS)
    done = lambda r: r.where("expired").count() == 2
    got = sessions(spark, path, 2000).wait(done).stop().drop("batch_id")
    assert rows(got) == [("u", 4000, 2, False), ("u", 4000, 2, True), ("v", 0, 1, False), ("v", 0, 1, True)]


def test_late_events_never_lower_the_start(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [("u", second(10)), ("u", second(12))], EVENTS)
    feed = sessions(spark, path, 600_000).wait(lambda r: r.count() == 1)
    put(spark, path, [("u", second(3)), ("u", second(15))], EVENTS)
    got = run.latest_update(feed.wait(lambda r: r.count() == 2).stop(), ["id"])
    assert rows(got) == [("u", 5000, 4, False)]


def test_nothing_to_wait_for(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [], EVENTS)
    feed = sessions(spark, path, 2000)
    assert rows(feed.wait(lambda r: r.count() >= 0).stop()) == []
    with pytest.raises(RuntimeError, match="not complete"):
        sessions(spark, path, 2000).wait(lambda r: r.count() > 0, timeout=3)


def test_a_stream_goes_on_from_its_checkpoint(spark):
    path, checkpoint, out = (scratch_path(spark, n) for n in ("in", "checkpoint", "out"))
    lines = spark.readStream.schema(EVENTS).parquet
    for piece in ([("u", second(1)), ("u", second(3))], [("u", second(2)), ("u", second(9))]):
        put(spark, path, piece, EVENTS)
        words = jobs.word_events(lines(path)).select("session_id", epoch_ms(F.col("timestamp")).alias("at_ms"))
        job = jobs.sessionize(words, 3_600_000)
        run.drain(job, "update", checkpoint=checkpoint, out=out)
    got = run.all_batches(spark, out, job.schema)
    assert rows(got.drop("batch_id")) == [("u", 2000, 2, False), ("u", 8000, 4, False)]


def test_own_state_function(spark):
    path = scratch_path(spark, "in")
    put(spark, path, [(1, 5), (2, 7), (1, 9)], "k long, v long")
    put(spark, path, [(1, 1)], "k long, v long")
    stream = spark.readStream.schema("k long, v long").option("maxFilesPerTrigger", 1).parquet(path)

    def largest(key, parts, old):
        return (max([int(p["v"].max()) for p in parts] + list(old or ())),)

    job = jobs.stateful(stream, "k", largest, lambda k, s, expired: (k, s[0]), "k long, top long", "top long", 3_600_000)
    got = run.latest_update(run.all_batches(spark, run.drain(job, "update"), job.schema), ["k"])
    assert rows(got) == [(1, 9), (2, 7)]


def test_join_with_a_table(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "key long, value string").write.json(path)
    table = spark.createDataFrame([(1, "x"), (3, "y")], "key long, value string")
    stream = jobs.read_json(spark, table.schema, path)
    joined = jobs.join_static(stream, table)
    want = [(1, "a", 1, "x"), (1, "c", 1, "x")]
    assert rows(run.all_batches(spark, run.drain(joined, "update"), joined.schema).drop("batch_id")) == want
    run.drain(jobs.read_json(spark, table.schema, path), "append", jobs.join_static_batches(table, out))
    assert rows(run.all_batches(spark, out, joined.schema).drop("batch_id")) == want


def test_changelog_over_batches(spark):
    path = scratch_path(spark, "log")
    schema = "log_index long, op string, key string, value string, client long, request_id long"
    log = [(i, "Put" if i % 11 == 0 else "Append", f"k{i % 3}", f"<{i}>", i % 2, i - (3 if i % 5 == 0 else 0))
           for i in range(60)]
    table = jobs.ChangelogTable(spark, bits=3)
    assert rows(table.state()) == []
    for batch, start in enumerate(range(0, 60, 20)):
        part = spark.createDataFrame(log[start:start + 20], schema)
        table.apply(part, batch)
        table.apply(part, batch)  # a batch that runs again replaces itself
    whole = changelog.fold(spark.createDataFrame(log, schema), bits=3)
    assert rows(table.state()) == rows(whole)
    short = table.compact(scratch_path(spark, "short"))
    assert rows(short.state()) == rows(whole)
    short.apply(spark.createDataFrame(log[40:], schema), 2)  # a batch that is run again after the compaction
    assert rows(short.state()) == rows(whole)
    assert rows(short.compact(scratch_path(spark, "shorter")).state()) == rows(whole)
    assert rows(jobs.ChangelogTable(spark).compact(scratch_path(spark, "none")).state()) == []
    more = [(60, "Append", "k0", "<60>", 0, 100), (61, "Append", "k0", "<no>", 1, 5)]
    short.apply(spark.createDataFrame(more, schema), 3)
    assert rows(short.state()) == rows(changelog.fold(spark.createDataFrame(log + more, schema), bits=3))
    put(spark, path, log, schema)
    streamed = jobs.ChangelogTable(spark, bits=3)
    run.drain(run.stream_table(spark, path), "append", streamed.apply)
    assert rows(streamed.state()) == rows(whole)


def test_marks_are_folded(spark):
    schema = "log_index long, op string, key string, value string, client long, request_id long"
    log = [(i, "Append", "k", f"<{i}>", i % 3, i // 3 - (2 if i % 7 == 0 else 0)) for i in range(24)]
    table = jobs.ChangelogTable(spark)
    table.MARKS = 3
    for batch in range(8):
        table.apply(spark.createDataFrame(log[3 * batch:3 * batch + 3], schema), batch)
    assert sorted(table._written("mark_folds")) == [2, 5]
    assert rows(table.state()) == rows(changelog.fold(spark.createDataFrame(log, schema)))


def test_topic_replay(spark):
    path = scratch_path(spark, "topic")
    spark.createDataFrame([(b"a", "t1"), (b"b", "t2"), (b"c", "u")], "value binary, topic string").select(
        F.lit(None).cast("binary").alias("key"), "value", "topic", F.lit(0).alias("partition"),
        F.lit(0).cast("long").alias("offset"), F.timestamp_millis(F.lit(1000)).alias("timestamp"),
        F.lit(0).alias("timestampType")).write.parquet(path)
    for how, topics, want in (("subscribe", "t1, u", ["a", "c"]), ("subscribePattern", "t.*", ["a", "b"])):
        lines = kafka.topic_lines(kafka.stream_topic(spark, how, topics, files=path))
        got = run.all_batches(spark, run.drain(lines, "append"), lines.schema)
        assert sorted(r.value for r in got.collect()) == want
