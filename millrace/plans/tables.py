"""Sources, sinks and the catalog, on files written from the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import message
from ..functions.times import instant
from ..operators import textjobs
from ..session import conversations, cut_lineage, load, scratch_path
from ..sources import delimited, files, hive, kafka, labelled
from ..sources.catalog import Catalog
from .registry import query

# The words of a text, for SQL: split on Unicode white space, empties dropped.
WORDS_SQL = (r"list_filter(regexp_split_to_array({c}, '[\s\v\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}"
             r"\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+'), lambda w: w <> '')")


def words_sql(column: str) -> str:
    return WORDS_SQL.format(c=column)


_PART = T.StructType().add("key", "string").add("name", "string").add("size", "integer")


@query("scan_delimited", """
SELECT CAST(p_partkey AS VARCHAR) AS key, left(trim(p_name || ' ' || repeat(p_type || ' ', 20)), 128) AS name,
       p_size AS size FROM part""")
def scan_delimited(spark, sf):
    path = scratch_path(spark, "part")
    load(spark, sf, "part").selectExpr(
        "concat(' ', p_partkey, ' |', '  ', p_name, ' ', repeat(p_type || ' ', 20), '|', p_size, '\r')"
    ).write.text(path)
    return delimited.scan_delimited(spark, path, _PART, "|")


_FLAGS = T.StructType().add("key", "string").add("level", "integer").add("status", "string")


@query("scan_bad_rows", """
SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderkey || ',' || o_orderpriority || ',P'
            ELSE CAST(o_orderkey AS VARCHAR) END AS line
FROM orders WHERE o_orderstatus IN ('P', 'O')""")
def scan_bad_rows(spark, sf):
    path = scratch_path(spark, "orders")
    load(spark, sf, "orders").selectExpr(
        "CASE o_orderstatus WHEN 'P' THEN concat_ws(',', o_orderkey, o_orderpriority, 'P') "
        "WHEN 'O' THEN cast(o_orderkey AS string) "
        "ELSE concat_ws(',', o_orderkey, left(o_orderpriority, 1), o_orderstatus) END"
    ).write.text(path)
    return delimited.scan_bad_rows(spark, path, _FLAGS)


@query("load_report", """
WITH l AS (
  SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'P' THEN o_orderkey || ',' || o_orderpriority || ',P'
    WHEN 'O' THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderkey || ',' || left(o_orderpriority, 1) || ',' || o_orderstatus END AS line
  FROM orders)
SELECT count(*) FILTER (o_orderstatus = 'F') AS good, count(*) FILTER (o_orderstatus <> 'F') AS bad,
  CAST(sum(strlen(line)) AS BIGINT) AS bytes, first(line ORDER BY o_orderkey) FILTER (o_orderstatus <> 'F') AS first_bad,
  count(*) FILTER (o_orderstatus = 'F') AS loaded, count(*) FILTER (o_orderstatus <> 'F') AS quarantined
FROM l""")
def load_report(spark, sf):
    """Lines with bad ones among them, loaded in one pass that reports what it met."""
    path, out = scratch_path(spark, "orders"), scratch_path(spark, "loaded")
    load(spark, sf, "orders").repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").selectExpr(
        "CASE o_orderstatus WHEN 'P' THEN concat_ws(',', o_orderkey, o_orderpriority, 'P') "
        "WHEN 'O' THEN cast(o_orderkey AS string) "
        "ELSE concat_ws(',', o_orderkey, left(o_orderpriority, 1), o_orderstatus) END"
    ).write.text(path)
    report = delimited.load_delimited(spark, path, _FLAGS, out)
    good, bad = delimited.loaded(spark, _FLAGS, out)
    sizes = good.agg(F.count(F.lit(1)).alias("loaded")).join(bad.agg(F.count(F.lit(1)).alias("quarantined")))
    return report.join(sizes)


@query("scan_labelled_csv", """
SELECT CAST(label AS FLOAT) AS label, CAST(vec_id AS FLOAT) AS row_id, len(embedding) + 1 AS n_features,
       embedding[1] AS first_value, embedding[64] AS last_value FROM embeddings""")
def scan_labelled_csv(spark, sf):
    path = scratch_path(spark, "vectors")
    load(spark, sf, "embeddings").select(F.concat_ws(
        ",", F.col("vec_id").cast("string"), F.col("label").cast("string"),
        F.transform("embedding", lambda v: v.cast("string")))).write.text(path)
    rows = labelled.scan_labelled(spark, path, label_col=1, width=66)
    return rows.select("label", F.get("features", F.lit(0)).alias("row_id"),
                       F.size("features").alias("n_features"),
                       F.get("features", F.lit(1)).alias("first_value"),
                       F.get("features", F.lit(64)).alias("last_value"))


@query("minibatch", """
SELECT vec_id, label, CAST((row_number() OVER (ORDER BY vec_id) - 1) // 32 AS BIGINT) AS batch_id
FROM embeddings""")
def minibatch(spark, sf):
    return labelled.minibatch(load(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", 32)


@query("scan_whole_files", f"""
SELECT source, CAST(sum(len({words_sql('text')})) AS BIGINT) AS n_words,
       CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes
FROM documents GROUP BY source""")
def scan_whole_files(spark, sf):
    path = scratch_path(spark, "documents")
    load(spark, sf, "documents").select("source", "text").write.partitionBy("source").option(
        "maxRecordsPerFile", 100).text(path)
    whole = files.scan_whole_files(spark, path)
    return whole.groupBy("source").agg(
        F.sum(F.size(textjobs.split_fields(F.col("contents"))).cast("long")).alias("n_words"),
        F.sum(F.octet_length("contents").cast("long")).alias("n_bytes"))


FNV_SQL = ("CASE WHEN {k} = '' THEN 18652613 ELSE list_reduce(list_prepend(CAST(2166136261 AS HUGEINT), "
           "list_transform(range(1, strlen({k}) + 1), "
           "lambda i: CAST(('0x' || substr(hex(encode({k})), 2 * i - 1, 2)) AS HUGEINT))), "
           "lambda a, b: (xor(a, b) * 16777619) % 4294967296) END")


def fnv_sql(key: str) -> str:
    return FNV_SQL.format(k=key)


@query("kv_json_roundtrip", f"""
SELECT CAST({fnv_sql('key')} % 2147483648 % 8 AS INT) AS bucket, key, value, count(*) AS n
FROM (SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value FROM events) GROUP BY ALL""")
def kv_json_roundtrip(spark, sf):
    path = scratch_path(spark, "kv")
    pairs = load(spark, sf, "events").selectExpr("cast(user_id AS string) AS key", "event_type AS value")
    files.write_kv_json(pairs, path, 8)
    return files.read_kv_json(spark, path).groupBy("bucket", "key", "value").agg(
        F.count(F.lit(1)).alias("n"))


@query("merged_text", f"""
SELECT word || ': ' || count(*) AS line
FROM (SELECT unnest({words_sql('text')}) AS word FROM conversations) GROUP BY word""")
def merged_text(spark, sf):
    path = scratch_path(spark, "merged")
    counts = textjobs.word_count(conversations(spark, sf), "text")
    files.write_lines(textjobs.merged_lines(
        counts.selectExpr("word AS key", "cast(count AS string) AS value")), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("dump_rows", r"""
SELECT c_custkey || chr(9) || c_name || chr(9) || c_nationkey || chr(9) || c_acctbal || chr(9) || c_mktsegment || chr(9) AS line
FROM customer""")
def dump_rows(spark, sf):
    path = scratch_path(spark, "dump")
    files.dump_rows(load(spark, sf, "customer"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("load_schema_catalog", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, n_name AS nation
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def load_schema_catalog(spark, sf):
    folder = scratch_path(spark, "catalog")
    customer, nation = load(spark, sf, "customer", "nation")
    customer.selectExpr("concat_ws(',', c_custkey, c_name, c_nationkey)").write.text(
        f"{folder}/clients.dat")
    nation.selectExpr("concat_ws(',', n_nationkey, n_name)").write.text(f"{folder}/countries.dat")
    spark.createDataFrame(
        [("clients (id string pk, name string, country int)",), ("countries (id int pk, nation string)",)],
        "line string").coalesce(1).write.text(f"{folder}/schema.txt")
    catalog = Catalog(spark, prefix="loaded_")
    catalog.load_schema(f"{folder}/schema.txt")
    return spark.sql("SELECT c.id, c.name, n.nation FROM loaded_clients c "
                     "JOIN loaded_countries n ON c.country = n.id")


@query("catalog_lookup", """
SELECT 'customer' AS table_name, 5 AS n_fields, 'c_custkey' AS pk, count(*) AS n_rows FROM customer
UNION ALL SELECT 'orders', 6, 'o_orderkey', count(*) FROM orders
UNION ALL SELECT 'lineitem', 11, '', count(*) FROM lineitem
UNION ALL SELECT 'events', 6, 'event_id', count(*) FROM events""")
def catalog_lookup(spark, sf):
    catalog = Catalog(spark, prefix="known_")
    catalog.add_table(load(spark, sf, "supplier"), "customer", "s_suppkey")
    for name, pk in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", ""),
                     ("events", "event_id")):
        catalog.add_table(load(spark, sf, name), name, pk)
    return catalog.summary()


@query("hive_create_load", "SELECT s_suppkey AS key, s_name AS value FROM supplier")
def hive_create_load(spark, sf):
    rows = load(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS value")
    return hive.create_and_load(spark, f"src_{uuid.uuid4().hex}", rows, scratch_path(spark, "src"))


def topic_rows(spark, sf):
    """Events in the connector's row layout, keyed by event id."""
    return load(spark, sf, "events").select(
        kafka.int_key(F.col("event_id"), 8).alias("key"),
        message(F.col("event_id")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), instant(F.col("ts")).alias("timestamp"),
        F.lit(0).alias("timestampType"))


@query("kafka_sink", """
SELECT lower(lpad(printf('%X', event_id), 16, '0')) AS key, 'Message_' || event_id AS value FROM events""")
def kafka_sink(spark, sf):
    path = scratch_path(spark, "topic")
    records = load(spark, sf, "events").select(
        kafka.int_key(F.col("event_id"), 8).alias("key"), message(F.col("event_id")).alias("value"))
    kafka.write_topic(records, "messages", files=path)
    return kafka.read_topic(spark, "messages", files=path).select(
        F.lower(F.hex("key")).alias("key"), F.col("value").cast("string").alias("value"))


@query("delivery_report", """
WITH crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
      SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
      FROM range(256) r(i))),
  sent AS (
    SELECT event_id, 'Message_' || event_id AS value, (xor(list_reduce(list_prepend(4294967295, list_transform([56, 48, 40, 32, 24, 16, 8, 0],
      lambda s: (event_id >> s) & 255)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 8)::INTEGER AS partition
    FROM events, crc)
SELECT event_id AS key, value, partition, row_number() OVER (PARTITION BY partition ORDER BY event_id) - 1 AS "offset",
  event_id % 2 = 0 AS waited, true AS timed FROM sent""")
def delivery_report(spark, sf):
    """Records are written, read back and matched. Those with an even number were given out an hour before the others."""
    path = scratch_path(spark, "topic")
    later = F.when(F.col("event_id") % 2 == 0, F.expr("INTERVAL 3600 SECONDS")).otherwise(F.expr("INTERVAL 0 SECONDS"))
    sent = cut_lineage(load(spark, sf, "events").select(
        F.col("event_id").alias("key"), message(F.col("event_id")).alias("value"), (F.current_timestamp() - later).alias("sent_at")), "sent")
    key = kafka.int_key(F.col("key"), 8)
    part = kafka.partition_of(key, 8)
    ordered = sent.repartitionByRange(spark.sparkContext.defaultParallelism, part, "key").sortWithinPartitions(part, "key")
    kafka.write_topic(ordered.select(key.alias("key"), "value"), "messages", files=path)
    report = kafka.delivery_report(sent, kafka.read_topic(spark, "messages", files=path), key_size=8)
    return report.select("key", "value", "partition", "offset", (F.col("elapsed_ms") >= 3_600_000).alias("waited"),
                         F.col("elapsed_ms").between(0, 7_200_000).alias("timed"))


@query("int_keys", "SELECT o_orderkey, lower(lpad(printf('%X', o_orderkey), 8, '0')) AS key FROM orders")
def int_keys(spark, sf):
    """Big-endian keys of four bytes."""
    return load(spark, sf, "orders").select("o_orderkey", F.lower(F.hex(kafka.int_key(F.col("o_orderkey")))).alias("key"))
