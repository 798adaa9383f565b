"""Scalar and array expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, hashing, text
from ..functions.times import session_duration as duration_ms
from ..operators import textjobs
from ..session import conversations, documents, load
from .profiles import CODE_SQL, code_sql
from .registry import query
from .tables import fnv_sql, words_sql

@query("lenient_float", """
SELECT event_id AS id, CAST(CAST('-' || value || 'e' || least(user_id % 30, 38) AS DOUBLE) AS FLOAT) AS number FROM events
UNION ALL SELECT o_orderkey + 1000000000000, CAST(left(o_orderpriority, 1) AS FLOAT) FROM orders
UNION ALL SELECT c_custkey + 2000000000000, CAST(0 AS FLOAT) FROM customer""")
def lenient_float(spark, sf):
    events, orders, customer = load(spark, sf, "events", "orders", "customer")
    texts = events.selectExpr(
        "event_id AS id", "concat('  -', value, 'e', user_id % 30, event_type) AS s").unionAll(
        orders.selectExpr("o_orderkey + 1000000000000", "o_orderpriority")).unionAll(
        customer.selectExpr("c_custkey + 2000000000000", "c_name"))
    return texts.select("id", text.lenient_float(F.col("s")).alias("number"))


@query("split_java", """
SELECT conv_id, turn, word, count(*) AS n FROM (
  SELECT conv_id, turn, unnest(CASE WHEN regexp_full_match(text, ' +') THEN [] ELSE
    string_split(rtrim(text, ' '), ' ') END) AS word FROM conversations) GROUP BY ALL""")
def split_java(spark, sf):
    words = conversations(spark, sf).select(
        "conv_id", "turn", F.explode(text.split_java(F.col("text"))).alias("word"))
    return words.groupBy("conv_id", "turn", "word").agg(F.count(F.lit(1)).alias("n"))


@query("split_fields", f"""
SELECT doc_id, len({words_sql('text')}) AS n_words, {words_sql('text')}[1] AS first_word,
       {words_sql('text')}[-1] AS last_word FROM documents""")
def split_fields(spark, sf):
    words = documents(spark, sf).select(
        "doc_id", text.split_fields(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("n_words"),
                        F.get("w", F.lit(0)).alias("first_word"),
                        F.get("w", F.size("w") - 1).alias("last_word"))


@query("trim_truncate", """
SELECT doc_id, left(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 128) AS head FROM documents""")
def trim_truncate(spark, sf):
    return documents(spark, sf).select("doc_id", text.trim_truncate(F.col("text")).alias("head"))


@query("dot_product", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))), 6) AS dot
FROM embeddings""")
def dot_product(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", F.round(
        arrays.dot_product(F.col("embedding"), F.col("embedding")), 6).alias("dot"))


@query("fnv1a32", f"""
SELECT word, CAST(CASE WHEN word = '' THEN 2166136261 ELSE {fnv_sql('word')} END AS BIGINT) AS hash
FROM (SELECT DISTINCT unnest({words_sql('text')}) AS word FROM conversations)""")
def fnv1a32(spark, sf):
    keys = textjobs.words(conversations(spark, sf), "text").distinct()
    return keys.select("word", hashing.fnv1a32(F.col("word")).alias("hash"))


@query("array_slice", """
SELECT vec_id, idx, part[idx + 1] AS v FROM (SELECT vec_id, embedding[9:16] AS part,
  CAST(unnest(range(0, 8)) AS INT) AS idx FROM embeddings)""")
def array_slice(spark, sf):
    cut = load(spark, sf, "embeddings").select("vec_id", arrays.array_slice(
        F.col("embedding"), 8, 16).alias("part"))
    return cut.select("vec_id", F.posexplode("part").alias("idx", "v"))


@query("str_prefix_code", f"""
SELECT word, CAST({CODE_SQL} AS INT) AS code FROM (SELECT word, {code_sql('word')} AS u
FROM (SELECT DISTINCT unnest({words_sql('text')}) AS word FROM conversations))""")
def str_prefix_code(spark, sf):
    keys = textjobs.words(conversations(spark, sf), "text").distinct()
    return keys.select("word", hashing.str_prefix_code(F.col("word")).alias("code"))


@query("session_duration", """
SELECT user_id, epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000 AS duration_ms FROM events GROUP BY user_id""")
def session_duration(spark, sf):
    bounds = load(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"))
    return bounds.select("user_id", duration_ms(F.col("first"), F.col("last")).alias("duration_ms"))


@query("kv_line", "SELECT n_name || ': ' || c_name AS line FROM customer JOIN nation ON c_nationkey = n_nationkey")
def kv_line(spark, sf):
    customer, nation = load(spark, sf, "customer", "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text.kv_line(F.col("n_name"), F.col("c_name")).alias("line"))


@query("binary_to_string", "SELECT page_id, url AS value FROM pages")
def binary_to_string(spark, sf):
    raw = load(spark, sf, "pages").selectExpr("page_id", "CAST(url AS BINARY) AS raw")
    return raw.select("page_id", text.binary_to_string(F.col("raw")).alias("value"))


@query("message_gen", "SELECT event_id AS key, 'Message_' || event_id AS value FROM events")
def message_gen(spark, sf):
    return load(spark, sf, "events").select(
        F.col("event_id").alias("key"), text.message(F.col("event_id")).alias("value"))


@query("array_at", "SELECT vec_id, CAST(embedding[label + 1] AS DOUBLE) AS v FROM embeddings")
def array_at(spark, sf):
    return load(spark, sf, "embeddings").select(
        "vec_id", arrays.array_at(F.col("embedding"), F.col("label")).cast("double").alias("v"))


@query("label_at", "SELECT vec_id, label FROM embeddings")
def label_at(spark, sf):
    rows = load(spark, sf, "embeddings").select(
        "vec_id", F.struct("label", F.col("embedding").alias("features")).alias("row"))
    return rows.select("vec_id", arrays.label_at(F.col("row")).alias("label"))
