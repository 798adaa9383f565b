"""The stored topic as a data source."""

import collections
import json

import pytest
from pyspark.sql import functions as F

from millrace.sources import topics
from millrace.streaming import run

from conftest import rows


@pytest.fixture
def topic(spark, tmp_path):
    topics.register(spark)
    return f"file://{tmp_path}/topic"


def records(spark, first, last, parts=3):
    return spark.range(first, last, 1, parts).selectExpr("cast(id AS string) AS key", "concat('m', id) AS value")


def send(df, path, name="a", **options):
    df.write.format("topic").option("topic", name).options(**options).mode("append").save(path)


def read(spark, path, **options):
    return spark.read.format("topic").options(**options).load(path)


def places(df):
    """{(topic, partition): values in order of offset}, after a check that offsets are dense from their first."""
    found = collections.defaultdict(list)
    for r in df.orderBy("topic", "partition", "offset").collect():
        found[r["topic"], r["partition"]].append((r["offset"], r["value"].decode()))
    for got in found.values():
        assert [o for o, _ in got] == list(range(got[0][0], got[0][0] + len(got)))
    return {k: [v for _, v in got] for k, got in found.items()}


def test_batches_are_appended(spark, topic):
    send(records(spark, 0, 500), topic, fileRecords="40")
    send(records(spark, 500, 800), topic)
    got = read(spark, topic, subscribe="a", fileRecords="33")
    assert got.columns == [f.split(" ")[0] for f in topics.SCHEMA.split(", ")]
    found = places(got)
    assert sorted(v for values in found.values() for v in values) == sorted(f"m{i}" for i in range(800))
    assert rows(got.select((F.crc32("key") % 8).cast("int") == F.col("partition")).distinct()) == [(True,)]
    for values in found.values():  # the first write comes first in each partition
        assert [int(v[1:]) >= 500 for v in values] == sorted(int(v[1:]) >= 500 for v in values)


def test_subscriptions_and_offsets(spark, topic):
    for name in ("a1", "a2", "b"):
        send(records(spark, 0, 40, 1).withColumn("partition", F.expr("cast(key AS int) % 2")), topic, name)
    names = lambda **o: {(r["topic"], r["partition"]) for r in read(spark, topic, **o).select("topic", "partition").collect()}
    assert names(subscribe="a1, b") == {("a1", 0), ("a1", 1), ("b", 0), ("b", 1)}
    assert names(subscribePattern="a.") == {("a1", 0), ("a1", 1), ("a2", 0), ("a2", 1)}
    assert names(assign='{"b": [1], "none": [0]}') == {("b", 1)}
    got = read(spark, topic, subscribe="b", startingOffsets='{"b": {"0": 5, "1": -1}}', endingOffsets='{"b": {"0": 8, "1": -1}}')
    assert [(r["partition"], r["offset"], r["value"]) for r in got.orderBy("offset").collect()] == [
        (0, 5, b"m10"), (0, 6, b"m12"), (0, 7, b"m14")]
    for bad in ({}, {"subscribe": "a", "assign": "{}"}):
        with pytest.raises(Exception, match="one of subscribe"):
            read(spark, topic, **bad).collect()


def test_a_stream_goes_on_in_mid_topic(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for first in (0, 100, None, 250):
        if first is not None:
            send(records(spark, first, first + 100), topic)
        stream = spark.readStream.format("topic").options(subscribe="a", startingOffsets="earliest").load(topic)
        run.drain(stream, "append", checkpoint=checkpoint, out=out)
    got = run.all_batches(spark, out, stream.schema)
    want = [f"m{i}" for i in [*range(0, 200), *range(250, 350)]]
    assert sorted(v for values in places(got).values() for v in values) == sorted(want)
    assert got.select("batch_id").distinct().count() == 3


def test_a_limit_per_batch(spark, topic, tmp_path):
    send(records(spark, 0, 1000), topic)
    stream = spark.readStream.format("topic").options(
        subscribe="a", startingOffsets="earliest", maxOffsetsPerTrigger="120", group="g").load(topic)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    part = run.Until(stream, "append", "100 milliseconds", checkpoint=checkpoint, out=out).wait(lambda r: r.count() >= 200).stop()
    assert part.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 128
    done = run.Until(stream, "append", "100 milliseconds", checkpoint=checkpoint, out=out).wait(lambda r: r.count() >= 1000).stop()
    assert sorted(v for values in places(run.all_batches(spark, out, stream.schema)).values() for v in values) == sorted(f"m{i}" for i in range(1000))
    assert done.groupBy("batch_id").count().agg(F.max("count")).first()[0] <= 128


def test_a_failed_write_shows_nothing(spark, topic):
    send(records(spark, 0, 50), topic)
    bad = records(spark, 50, 100).withColumn("value", F.when(F.col("key") == "99", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        send(bad, topic)
    assert read(spark, topic, subscribe="a").count() == 50
    send(records(spark, 100, 120), topic)
    assert sum(map(len, places(read(spark, topic, subscribe="a")).values())) == 70


def test_a_repeated_batch_is_written_once(spark, topic, tmp_path):
    folder = topics.Folder(topic)
    for batch in (0, 1, 1, 0, 2):
        folder.fs.create_dir(f"{folder.root}/data", recursive=True)
        part = topics.Part("a", 0, 10, f"{batch}-{len(folder.entries())}-{batch}.parquet")
        with folder.fs.open_output_stream(f"{folder.root}/data/{part.file}") as file:
            file.write(b"")
        folder.commit([part], "w", batch)
    assert folder.last()[1]["ends"] == {"a": {"0": 30}}
    assert len(folder.entries()) == 3


def test_a_stream_to_a_stream(spark, topic, tmp_path):
    """Records travel from one topic to another with a writer of its own."""
    send(records(spark, 0, 300), topic)
    other = f"file://{tmp_path}/other"
    stream = spark.readStream.format("topic").options(subscribe="a", startingOffsets="earliest").load(topic)
    query = (stream.select("key", "value", "partition").writeStream.format("topic").option("topic", "b").option("writer", "copy")
             .option("path", other).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    got, want = places(read(spark, other, subscribe="b")), places(read(spark, topic, subscribe="a"))
    assert {p: sorted(v) for (_, p), v in got.items()} == {p: sorted(v) for (_, p), v in want.items()}
    assert json.loads(json.dumps(topics.Folder(other).last()[1]["writers"])) == {"copy": 0}


def test_empty_and_odd_records(spark, topic):
    assert read(spark, topic, subscribe="a").collect() == []
    send(spark.createDataFrame([], "key string, value string"), topic)
    send(spark.createDataFrame([(None, None), ("", "x"), (None, "y")], "key string, value string").coalesce(1), topic)
    got = read(spark, topic, subscribe="a")
    assert sorted((r["key"], r["value"] or b"") for r in got.collect() if r["key"] is not None) == [(b"", b"x")]
    assert [(r["partition"], r["offset"]) for r in got.orderBy("offset").collect()] == [(0, 0), (0, 1), (0, 2)]
    send(spark.createDataFrame([("v",)], "value string"), topic)
    assert read(spark, topic, subscribe="a").count() == 4
    with pytest.raises(Exception, match="only added to"):
        records(spark, 0, 1).write.format("topic").option("topic", "a").mode("overwrite").save(topic)
