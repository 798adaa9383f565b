"""Push and pull on keyed numbers and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import ASSIGN_OPS
from ..operators import kv
from ..session import load
from .registry import query

# Money and values carry two decimals; as whole cents their sums are exact.
_CENTS = "cast(round({c} * 100) AS bigint)"
_PUSHES = "SELECT user_id AS key, CAST(round(value * 100) AS BIGINT) AS val, event_id AS seq FROM events"
_STORE = f"SELECT key, CAST(sum(val) AS BIGINT) AS val FROM ({_PUSHES}) GROUP BY key"


def pushes(spark, sf):
    return load(spark, sf, "events").selectExpr(
        "user_id AS key", f"{_CENTS.format(c='value')} AS val", "event_id AS seq")


@query("kv_push_sum", _STORE)
def kv_push_sum(spark, sf):
    return kv.push_sum(pushes(spark, sf))


@query("kv_push_vectors", """
SELECT label, idx, round(sum(CAST(v AS DOUBLE)), 4) AS val, count(*) AS pushes
FROM (SELECT label, unnest(embedding) AS v, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS idx FROM embeddings)
GROUP BY label, idx""")
def kv_push_vectors(spark, sf):
    sums = kv.push_vectors(load(spark, sf, "embeddings"), ["label"], "embedding")
    return sums.select("label", "idx", F.round("val", 4).alias("val"), "pushes")


@query("kv_pull", f"""
SELECT c_custkey AS key, coalesce(val, 0) AS val FROM customer LEFT JOIN ({_STORE}) ON c_custkey = key""")
def kv_pull(spark, sf):
    keys = load(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    return kv.pull(keys, kv.push_sum(pushes(spark, sf)))


@query("kv_pull_strict", f"""
SELECT e.event_id, s.key, s.val FROM events e JOIN ({_STORE}) s ON e.user_id = s.key""")
def kv_pull_strict(spark, sf):
    keys = load(spark, sf, "events").select("event_id", F.col("user_id").alias("key"))
    return kv.pull_strict(keys, kv.push_sum(pushes(spark, sf)))


@query("kv_match_assign", f"""
WITH dst AS (SELECT c_custkey AS key, CAST(round(c_acctbal * 100) AS BIGINT) AS val FROM customer)
SELECT dst.key, dst.val + coalesce(s.val, 0) AS val, s.key IS NOT NULL AS matched
FROM dst LEFT JOIN ({_STORE}) s ON dst.key = s.key""")
def kv_match_assign(spark, sf):
    dst = load(spark, sf, "customer").selectExpr(
        "c_custkey AS key", f"{_CENTS.format(c='c_acctbal')} AS val")
    return kv.match_assign(dst, kv.push_sum(pushes(spark, sf)), "PLUS")


@query("assign_ops", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey + 1 AS incoming, l_suppkey + 1 AS assign,
       l_partkey + l_suppkey + 1 AS plus, l_partkey - l_suppkey - 1 AS minus,
       l_partkey * (l_suppkey + 1) AS times, l_partkey // (l_suppkey + 1) AS divide,
       l_partkey & (l_suppkey + 1) AS "and", l_partkey | (l_suppkey + 1) AS "or",
       xor(l_partkey, l_suppkey + 1) AS xor FROM lineitem""")
def assign_ops(spark, sf):
    pairs = load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey + 1 AS incoming")
    return kv.assign_all(pairs, "l_partkey", "incoming", ASSIGN_OPS)


@query("push_handler", f"""
SELECT key, CAST(max(val) AS DOUBLE) AS val FROM ({_PUSHES}) GROUP BY key""")
def push_handler(spark, sf):
    """A user handler that keeps the largest value pushed."""
    return kv.push_handled(pushes(spark, sf), max, max)


@query("fold_vectors", """
WITH cells AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  sums AS (SELECT label, i, CAST(sum(floor(1024 * x::DOUBLE)) AS BIGINT) AS total FROM cells GROUP BY ALL)
SELECT label, string_agg(total::VARCHAR, ',' ORDER BY i) AS sums FROM sums GROUP BY label""")
def fold_vectors(spark, sf):
    """Vectors pushed under their label, added up by position and put together again."""
    vectors = load(spark, sf, "embeddings").select("label", F.transform(
        "embedding", lambda x: F.floor(x.cast("double") * 1024).cast("double")).alias("vec"))
    whole = kv.fold_vectors(kv.push_vectors(vectors, ["label"], "vec"), ["label"])
    return whole.select("label", F.array_join(F.transform("vals", lambda v: v.cast("long")), ",").alias("sums"))
