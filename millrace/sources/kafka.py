"""Kafka source, sink and delivery report.

The connector jar is chosen at submit time. Where it is absent the same rows
are replayed from, or written to, files in the connector's row layout.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import topics

# Fixed value: the connector's row layout.
ROW_SCHEMA = ("key binary, value binary, topic string, partition int, offset bigint, "
              "timestamp timestamp, timestampType int")
SUBSCRIPTIONS = ("subscribe", "subscribePattern", "assign")


def stream_topic(spark: SparkSession, subscription: str, topics: str, servers: str | None = None,
                 files: str | None = None) -> DataFrame:
    """The raw topic stream, from brokers or replayed from a folder of files."""
    if subscription not in SUBSCRIPTIONS:
        raise ValueError(f"unknown subscription {subscription}")
    if files is not None:
        rows = spark.readStream.schema(ROW_SCHEMA).parquet(files)
        if subscription == "subscribePattern":
            return rows.where(F.col("topic").rlike(f"^(?:{topics})$"))
        if subscription == "subscribe":
            return rows.where(F.col("topic").isin(*[t.strip() for t in topics.split(",")]))
        wanted = [(t, p) for t, ps in json.loads(topics).items() for p in ps]
        named = F.array(*[F.struct(F.lit(t).alias("topic"), F.lit(p).alias("partition")) for t, p in wanted])
        return rows.where(F.array_contains(named, F.struct("topic", "partition")) if wanted else F.lit(False))
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option(subscription, topics).load())


def topic_lines(topic: DataFrame, with_time: bool = False) -> DataFrame:
    """The value as text, with the record time if wanted."""
    return topic.selectExpr("CAST(value AS STRING) AS value", *(["timestamp"] if with_time else []))


def int_key(number: Column, size: int = 4) -> Column:
    """A big-endian integer of 4 bytes, or of 8 where numbers may pass 2^31; a number that doesn't fit is an error."""
    if size == 4:
        wide = F.raise_error(F.concat(F.lit("no 4-byte key: "), number.cast("string"))).cast("long")
        number = F.when(number.between(-2**31, 2**31 - 1) | number.isNull(), number.cast("long")).otherwise(wide)
    return F.unhex(F.right(F.lpad(F.hex(number.cast("long")), 16, "0"), F.lit(2 * size)))


def partition_of(key: Column, partitions: int) -> Column:
    """The partition of a record by its key, as a stored topic chooses it."""
    return F.pmod(F.crc32(F.coalesce(key, F.lit("").cast("binary"))), F.lit(partitions)).cast("int")


def write_topic(records: DataFrame, topic: str, servers: str | None = None,
                files: str | None = None, partitions: int = 8) -> None:
    """Send (key, value) records; a Spark write returns when all are acknowledged.

    Written to files, as a stored topic (``topics``), a record gets a partition by its key, the next offset of that partition in
    the order of the tasks and their rows, and the time of the write, as brokers would give it.
    """
    rows = records.select("key", F.col("value").cast("binary").alias("value"))
    if files is None:
        (rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
        return
    topics.register(records.sparkSession)
    rows.write.format("topic").option("topic", topic).option("partitions", partitions).mode("append").save(files)


def read_topic(spark: SparkSession, topic: str, servers: str | None = None, files: str | None = None) -> DataFrame:
    """All records of a topic so far, in the connector's row layout."""
    if files is None:
        return spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    topics.register(spark)
    return spark.read.format("topic").option("subscribe", topic).load(files)


def delivery_report(sent: DataFrame, topic: DataFrame, key_size: int = 4) -> DataFrame:
    """Where each sent record landed and how long it took: key, value, partition, offset, elapsed_ms.

    ``sent`` is (key, value, sent_at) with an int key, and is stored, so that the times are those before the write; ``topic`` holds topic
    rows read back. A record is known by key and value; the n-th of equal ones is the n-th of
    its partition. Times are differences of timestamps of the same kind. A record that was not stored has no row.
    """
    nth = lambda *order: F.row_number().over(Window.partitionBy("k_b", "value").orderBy(*order)).alias("nth")
    landed = topic.select(F.col("key").alias("k_b"), F.col("value").cast("string").alias("value"), "partition",
                          "offset", F.col("timestamp").alias("stored_at"))
    landed = landed.select("*", nth("partition", "offset"))
    given = sent.withColumn("k_b", int_key(F.col("key"), key_size))
    joined = given.select("*", nth("sent_at")).join(landed, ["k_b", "value", "nth"])
    waited = (F.unix_millis(F.col("stored_at").cast("timestamp"))
              - F.unix_millis(F.col("sent_at").cast("timestamp")))
    return joined.select("key", "value", "partition", "offset", waited.alias("elapsed_ms"))
