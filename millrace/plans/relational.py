"""Scans, filters, projections, joins and bags over the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bags, joins, kv
from ..operators.positions import PositionedTable
from ..operators.predicates import Op, predicate
from ..operators.relational import (
    delete_where, filter_rows, insert_into, merge_schemas, scan, scan_rows)
from ..session import load, scratch_path
from .registry import query


@query("scan_table", """
SELECT s_suppkey AS s_s_suppkey, s_name AS s_s_name, s_nationkey AS s_s_nationkey,
       s_acctbal AS s_s_acctbal FROM supplier""")
def scan_table(spark, sf):
    return scan(load(spark, sf, "supplier"), "s")


@query("scan_rows", "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer")
def declared_rows(spark, sf):
    rows = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    declared = T.StructType().add("id", "long").add("name", "string").add("nation", "integer")
    return scan_rows(spark, declared, rows)


@query("filter", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def filtered(spark, sf):
    orders = load(spark, sf, "orders")
    return filter_rows(orders, "o_orderstatus", "=", "F").select(
        "o_orderkey", "o_custkey", "o_totalprice")


def _part_predicate(name: str, field: str, op: str, value, where: str) -> None:
    @query(name, f"SELECT p_partkey, p_name, p_size FROM part WHERE {where}")
    def run(spark, sf):
        part = load(spark, sf, "part")
        return part.filter(predicate(part, field, op, value)).select("p_partkey", "p_name", "p_size")


_part_predicate("pred_eq", "p_size", "=", 25, "p_size = 25")
_part_predicate("pred_ne", "p_size", "<>", 25, "p_size <> 25")
_part_predicate("pred_gt", "p_size", ">", 25, "p_size > 25")
_part_predicate("pred_ge", "p_size", ">=", 25, "p_size >= 25")
_part_predicate("pred_lt", "p_size", "<", 25, "p_size < 25")
_part_predicate("pred_le", "p_name", "<=", "cold gear", "p_name <= 'cold gear'")
_part_predicate("pred_like_str", "p_name", "LIKE", "in", "contains(p_name, 'in')")
_part_predicate("pred_like_int", "p_size", "LIKE", 7, "p_size = 7")


@query("pred_by_ordinal", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber >= 6""")
def by_ordinal(spark, sf):
    lines = load(spark, sf, "lineitem")
    return lines.filter(predicate(lines, 3, 4, 6)).select("l_orderkey", "l_linenumber", "l_quantity")


@query("key_range_slice", """
WITH top AS (SELECT max(o_orderkey) AS m FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, top WHERE o_orderkey >= m // 4 AND o_orderkey < 3 * m // 4""")
def key_range_slice(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    return kv.key_range(orders, "o_orderkey", top // 4, 3 * top // 4)


@query("sql_filter_order", """
SELECT c_custkey AS key, c_name AS value FROM customer WHERE c_custkey < 10 ORDER BY c_custkey""")
def sql_filter_order(spark, sf):
    load(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_name AS value").createOrReplaceTempView("src_customer")
    return spark.sql("SELECT key, value FROM src_customer WHERE key < 10 ORDER BY key")


@query("project_cast", """
SELECT CAST(props AS VARCHAR) AS value, ts AS timestamp FROM events""")
def project_cast(spark, sf):
    raw = load(spark, sf, "events").selectExpr("CAST(props AS BINARY) AS value", "ts AS timestamp")
    return raw.selectExpr("CAST(value AS STRING) AS value", "timestamp")


@query("select_star_join", """
SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def select_star_join(spark, sf):
    supplier, nation = load(spark, sf, "supplier", "nation")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("*")


@query("row_format_map", """
SELECT 'Key: ' || c_custkey || ', Value: ' || c_name AS line FROM customer""")
def row_format_map(spark, sf):
    return load(spark, sf, "customer").select(
        F.format_string("Key: %d, Value: %s", "c_custkey", "c_name").alias("line"))


@query("schema_merge", """
SELECT o_orderkey, o_orderstatus, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def schema_merge(spark, sf):
    orders, customer = load(spark, sf, "orders", "customer")
    left = orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    right = customer.select("c_custkey", "c_name")
    joined = joins.join(left, "o_custkey", "=", right, "c_custkey")
    return scan_rows(spark, merge_schemas(left.schema, right.schema), joined).drop("o_custkey")


@query("join_eq", """
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_eq(spark, sf):
    orders, customer = load(spark, sf, "orders", "customer")
    return joins.join(orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey",
                      Op.EQUALS, customer.select("c_custkey", "c_name", "c_mktsegment"), "c_custkey")


def _theta(name: str, table: str, key: str, field: str, op: str, dim: str, dim_key: str) -> None:
    @query(name, f"SELECT {key}, {field}, {dim_key} FROM {table} JOIN {dim} ON {field} {op} {dim_key}")
    def run(spark, sf):
        left, right = load(spark, sf, table, dim)
        return joins.join(left.select(key, field), field, op, right.select(dim_key), dim_key)


_theta("join_gt", "customer", "c_custkey", "c_nationkey", ">", "region", "r_regionkey")
_theta("join_ge", "supplier", "s_suppkey", "s_nationkey", ">=", "nation", "n_nationkey")
_theta("join_lt", "customer", "c_custkey", "c_nationkey", "<", "region", "r_regionkey")
_theta("join_le", "supplier", "s_suppkey", "s_nationkey", "<=", "nation", "n_nationkey")
_theta("join_ne", "part", "p_partkey", "p_size", "<>", "region", "r_regionkey")


@query("join_ne_counts", """
SELECT p_partkey, p_size, (SELECT count(*) FROM region) - (SELECT count(*) FROM region WHERE r_regionkey = p_size) AS partners
FROM part""")
def join_ne_counts(spark, sf):
    """How many partners ``<>`` gives each row, without the pairs."""
    part, region = load(spark, sf, "part", "region")
    return joins.count_unequal(part.select("p_partkey", "p_size"), "p_size", region, "r_regionkey")


@query("join_like_grams", """
WITH w AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM benchmark)
SELECT conv_id, turn, word FROM conversations JOIN w ON contains(text, word)""")
def join_like_grams(spark, sf):
    """Thousands of patterns of any length, looked for by one automaton."""
    talks, items = load(spark, sf, "conversations", "benchmark")
    words = items.select(F.explode(F.split("text", " ")).alias("word")).distinct()
    hits = joins.join_containing(talks.select("conv_id", "turn", "text"), "text", words, "word")
    return hits.select("conv_id", "turn", "word")


@query("join_like", """
WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT conv_id, turn, word FROM conversations JOIN w ON contains(text, word)""")
def join_like(spark, sf):
    talks, part = load(spark, sf, "conversations", "part")
    wanted = part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    hits = joins.join(talks.select("conv_id", "turn", "text"), "text", "LIKE", wanted, "word")
    return hits.select("conv_id", "turn", "word")


@query("insert_into", "SELECT CAST(count(*) AS BIGINT) AS count FROM customer")
def insert(spark, sf):
    supplier, customer = load(spark, sf, "supplier", "customer")
    path = scratch_path(spark, "supplier")
    supplier.write.parquet(path)
    return insert_into(customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), path)


@query("insert_row_count_once", """
SELECT (SELECT count(*) FROM customer) AS inserted,
       (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer) AS n_rows""")
def insert_once(spark, sf):
    supplier, customer = load(spark, sf, "supplier", "customer")
    path = scratch_path(spark, "supplier")
    supplier.write.parquet(path)
    result = insert_into(customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), path)
    first, again = result.first()["count"], result.first()["count"]
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(max(first, again)).cast("long").alias("inserted"), "n_rows")


@query("delete_where", """
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS deleted,
       (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS n_rows""")
def delete(spark, sf):
    new = scratch_path(spark, "orders")
    gone = delete_where(spark, f"{sf}/orders.parquet", F.col("o_orderstatus") == "F", new)
    return spark.read.parquet(new).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(gone.first()["count"]).cast("long").alias("deleted"), "n_rows")


@query("bag_union", """
SELECT s_nationkey AS nation FROM supplier UNION ALL SELECT c_nationkey FROM customer""")
def bag_union(spark, sf):
    supplier, customer = load(spark, sf, "supplier", "customer")
    return bags.bag_union(supplier.select(F.col("s_nationkey").alias("nation")),
                          customer.select("c_nationkey"))


@query("bag_equal", """
WITH net AS (
  SELECT k, sum(n) AS n FROM (
    SELECT c_nationkey AS k, 1 AS n FROM customer
    UNION ALL SELECT s_nationkey, -1 FROM supplier) GROUP BY k)
SELECT k AS nation, CASE WHEN n > 0 THEN 'unexpected' ELSE 'missing' END AS status,
       CAST(abs(n) AS BIGINT) AS copies FROM net WHERE n <> 0""")
def bag_equal(spark, sf):
    supplier, customer = load(spark, sf, "supplier", "customer")
    return bags.bag_difference(customer.select(F.col("c_nationkey").alias("nation")),
                               supplier.select("s_nationkey"))


@query("contains_all", """
SELECT DISTINCT p_partkey AS partkey FROM part
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-03-01')""")
def contains_all(spark, sf):
    """Parts that were not shipped before a date."""
    lines, part = load(spark, sf, "lineitem", "part")
    early = lines.where("l_shipdate < TIMESTAMP_NTZ '1995-03-01 00:00:00'")
    return bags.contains_all(early.select(F.col("l_partkey").alias("partkey")), part.select("p_partkey"))


@query("count_star", "SELECT count(*) AS n FROM lineitem")
def count_star(spark, sf):
    load(spark, sf, "lineitem").createOrReplaceTempView("src_lineitem")
    return spark.sql("SELECT COUNT(*) AS n FROM src_lineitem")


@query("sort_custom", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey""")
def sort_custom(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.desc("o_orderpriority"), F.asc("o_totalprice"), F.asc("o_orderkey"))


@query("delete_by_position", """
WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS part, o_orderpriority, o_totalprice FROM orders)
SELECT count(*) FILTER (part = 1 AND o_orderpriority < '3') AS deleted, 0 AS deleted_again,
  count(*) FILTER (NOT (part = 1 AND o_orderpriority < '3')) AS left_over,
  count(DISTINCT part) FILTER (part = 1 AND o_orderpriority < '3') AS files_rewritten, 0 AS rewritten_again,
  count(*) FILTER (NOT (part = 1 AND o_orderpriority < '3')) AS left_after_rewrite,
  CAST(sum(o_orderkey) FILTER (NOT (part = 1 AND o_orderpriority < '3')) AS BIGINT) AS keys
FROM o""")
def delete_by_position(spark, sf):
    """A table of four files: a delete by places, the same again, and a rewrite of the file it touched."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    table = PositionedTable(spark, orders.schema)
    table.append(orders.repartitionById(4, (F.col("o_orderkey") % 4).cast("int")))
    doomed = (F.col("o_orderkey") % 4 == 1) & (F.col("o_orderpriority") < "3")
    deleted, again, left = table.delete(doomed), table.delete(doomed), table.scan().count()
    files, more = table.rewrite(), table.rewrite()
    counted = table.scan().agg(F.count(F.lit(1)).alias("left_after_rewrite"), F.sum("o_orderkey").alias("keys"))
    told = [F.lit(n).cast("long").alias(c) for c, n in (("deleted", deleted), ("deleted_again", again), ("left_over", left),
                                                        ("files_rewritten", files), ("rewritten_again", more))]
    return counted.select(*told, "left_after_rewrite", "keys")
