"""Readers, writers, Kafka row layout and envelopes."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path, shared_dir
from millrace.sources import delimited, envelope, files, hive, kafka, labelled
from millrace.sources.catalog import Catalog
from millrace.streaming import run


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


PAIR = T.StructType().add("n", "integer").add("s", "string")


def test_delimited_good_and_bad(spark, tmp_path):
    path = write(tmp_path, "t.txt", "1, a\r\n\n2,b\nx,c\n3\n4,d")
    assert rows(delimited.scan_delimited(spark, path, PAIR)) == [(1, "a"), (2, "b"), (4, "d")]
    assert rows(delimited.scan_bad_rows(spark, path, PAIR)) == [("3",), ("x,c",)]


@pytest.mark.parametrize("sep", ["|", "\t", ".", "*"])
def test_delimited_separators(spark, tmp_path, sep):
    path = write(tmp_path, "t.txt", f" +7 {sep} b c {sep}\n-8{sep}{'y' * 200}{sep}z\n")
    schema = T.StructType().add("n", "integer").add("s", "string").add("t", "string")
    assert rows(delimited.scan_delimited(spark, path, schema, sep)) == [(-8, "y" * 128, "z"), (7, "b c", "")]


def test_delimited_limits(spark, tmp_path):
    path = write(tmp_path, "t.txt", "2147483647,a\n2147483648,b\n1.5,c\n")
    assert rows(delimited.scan_delimited(spark, path, PAIR)) == [(2147483647, "a")]
    with pytest.raises(ValueError):
        delimited.scan_delimited(spark, path, PAIR, "ab")


def test_labelled_csv(spark, tmp_path):
    path = write(tmp_path, "d.csv", "6,7,8\n9,10,11\n\n12,,14\n1e2,-2.5e-1,abc\n")
    got = labelled.scan_labelled(spark, path, 2, 3)
    assert sorted((r.label, r.features) for r in got.collect()) == [
        (0.0, [100.0, -0.25]), (8.0, [6.0, 7.0]), (11.0, [9.0, 10.0]), (14.0, [12.0, 0.0])]
    first = labelled.scan_labelled(spark, path, 0, 3)
    assert (6.0, [7.0, 8.0]) in [(r.label, r.features) for r in first.collect()]
    bad = write(tmp_path, "b.csv", "1,2,\n")
    with pytest.raises(Exception, match="wrong number of fields"):
        labelled.scan_labelled(spark, bad, 2, 3).collect()


def test_minibatch(spark):
    df = spark.range(0, 70, 7).toDF("id")
    got = labelled.minibatch(df, "id", 4).orderBy("id").collect()
    assert [r.batch_id for r in got] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_whole_files(spark, tmp_path):
    write(tmp_path, "a.txt", "one\ntwo\n")
    write(tmp_path, "b.txt", "three")
    got = {r.name.rsplit("/", 1)[1]: r.contents for r in files.scan_whole_files(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "one\ntwo\n", "b.txt": "three"}


def test_kv_json_and_dump(spark):
    pairs = spark.createDataFrame([("the", "1"), ("é", 'q"\n'), ("", "")], "key string, value string")
    path = scratch_path(spark, "kv")
    files.write_kv_json(pairs, path, 3)
    got = files.read_kv_json(spark, path)
    assert rows(got.select("key", "value")) == rows(pairs)
    assert {r.key: r.bucket for r in got.collect()} == {"the": 873378332 % 3, "é": 513665217 % 3, "": 18652613 % 3}
    out = scratch_path(spark, "dump")
    files.dump_rows(spark.createDataFrame([(1, "a")], "n int, s string"), out)
    assert [r.value for r in spark.read.text(out).collect()] == ["1\ta\t"]


def test_schema_file(spark, tmp_path):
    write(tmp_path, "schema.txt", "t (id int pk, name string)\n")
    write(tmp_path, "t.dat", "1,a\n2,b\n")
    catalog = Catalog(spark, "file_")
    assert catalog.load_schema(str(tmp_path / "schema.txt")) == ["t"]
    assert rows(catalog.table("t")) == [(1, "a"), (2, "b")]
    assert catalog.primary_key(catalog.table_id("t")) == "id"


def test_create_and_load_without_hive(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "key long, value string")
    place = scratch_path(spark, "src")
    assert not hive.has_hive(spark)
    table = hive.create_and_load(spark, "src_test_table", df, place)
    assert rows(table) == [(1, "a"), (2, "b")]
    hive.create_and_load(spark, "src_test_table", df, place)
    assert spark.table("src_test_table").count() == 4
    spark.sql("DROP TABLE src_test_table")


def test_int_keys(spark):
    df = spark.createDataFrame([(1,), (256,), (-1,)], "k int")
    got = [bytes(r[0]) for r in df.select(kafka.int_key(F.col("k"))).collect()]
    assert got == [(v).to_bytes(4, "big", signed=True) for v in (1, 256, -1)]


def test_producer_records_and_report(spark):
    path = scratch_path(spark, "topic")
    sent = spark.range(1, 11).selectExpr("int(id) AS key", "concat('Message_', id) AS value")
    kafka.write_topic(sent.select(kafka.int_key(F.col("key")).alias("key"), "value"), "t", files=path)
    stored = kafka.read_topic(spark, "t", files=path)
    assert stored.select(F.col("value").cast("string")).orderBy("value").first()[0] == "Message_1"
    places = stored.groupBy("partition").agg(F.sort_array(F.collect_list("offset")).alias("o")).collect()
    assert all(r.o == list(range(len(r.o))) for r in places) and sum(len(r.o) for r in places) == 10
    topic = stored.withColumn("timestamp", F.timestamp_millis(F.lit(1500)))
    report = kafka.delivery_report(sent.withColumn("sent_at", F.timestamp_millis(F.lit(1000))), topic)
    assert report.count() == 10 and report.where("elapsed_ms = 500").count() == 10
    twice = sent.union(sent).withColumn("sent_at", F.timestamp_millis(F.lit(1000)))
    again = scratch_path(spark, "topic")
    kafka.write_topic(twice.select(kafka.int_key(F.col("key")).alias("key"), "value"), "t", files=again)
    report = kafka.delivery_report(twice, kafka.read_topic(spark, "t", files=again))
    assert report.count() == 20 == report.select("partition", "offset").distinct().count()


def test_wide_keys_are_an_error(spark):
    df = spark.createDataFrame([(2 ** 32 + 5,)], "k long")
    with pytest.raises(Exception, match="no 4-byte key"):
        df.select(kafka.int_key(F.col("k"))).collect()
    assert bytes(df.select(kafka.int_key(F.col("k"), 8)).first()[0]) == (2 ** 32 + 5).to_bytes(8, "big")


def test_assigned_partitions(spark):
    path = scratch_path(spark, "topic")
    spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "topic string, partition int").select(
        F.lit(None).cast("binary").alias("key"), F.col("topic").cast("binary").alias("value"), "topic", "partition",
        F.lit(0).cast("long").alias("offset"), F.timestamp_millis(F.lit(0)).alias("timestamp"),
        F.lit(0).alias("timestampType")).write.parquet(path)
    rows_ = kafka.stream_topic(spark, "assign", '{"a": [1], "b": [0, 3]}', files=path)
    out = run.drain(rows_.select("topic", "partition"), "append")
    got = run.all_batches(spark, out, rows_.select("topic", "partition").schema)
    assert sorted((r.topic, r.partition) for r in got.collect()) == [("a", 1), ("b", 0)]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_subscriptions(spark):
    with pytest.raises(ValueError):
        kafka.stream_topic(spark, "anything", "t", files="/nowhere")


def test_envelope(spark):
    df = spark.createDataFrame([('say "hi"\t',)], "v string")
    text = df.select(envelope.wrap(F.col("v")).alias("v"))
    assert text.first()[0] == '{"schema":{"type":"string","optional":false},"payload":"say \\"hi\\"\\t"}'
    assert text.select(envelope.unwrap(F.col("v"))).first()[0] == 'say "hi"\t'
