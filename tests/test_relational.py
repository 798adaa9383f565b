"""Predicates, joins, bags, catalog, insert and delete."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import bags, joins, kv, regions
from millrace.operators.predicates import Op, predicate
from millrace.operators.relational import (
    delete_where, field_index, filter_rows, insert_into, merge_schemas, same_types, scan, scan_rows)
from millrace.session import scratch_path
from millrace.sources.catalog import Catalog, parse_schema

TESTS = {"=": lambda a, b: a == b, ">": lambda a, b: a > b, "<": lambda a, b: a < b,
         "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "<>": lambda a, b: a != b}


@pytest.mark.parametrize("op", list(TESTS))
def test_comparisons_around_the_constant(spark, op):
    df = spark.createDataFrame([(n, n, n) for n in range(-5, 5)], "a int, b int, c int")
    for v in (-1, 0, 1):
        got = rows(filter_rows(df, 0, op, v))
        assert got == [(n, n, n) for n in range(-5, 5) if TESTS[op](n, v)]


def test_operator_codes():
    assert [Op.of(i).value for i in range(7)] == ["=", ">", "<", "<=", ">=", "LIKE", "<>"]


def test_like_is_containment_or_equality(spark):
    df = spark.createDataFrame([("a%b", 7), ("ab", 17)], "s string, n int")
    assert [r.s for r in df.filter(predicate(df, "s", "LIKE", "%")).collect()] == ["a%b"]
    assert [r.n for r in df.filter(predicate(df, "n", "LIKE", 7)).collect()] == [7]


def test_mixed_types_are_rejected(spark):
    df = spark.createDataFrame([("1", 1)], "s string, n int")
    with pytest.raises(TypeError):
        predicate(df, "s", "=", 1)
    with pytest.raises(TypeError):
        predicate(df, "n", "=", "1")
    with pytest.raises(TypeError):
        joins.join(df, "s", "=", df.toDF("s2", "n2"), "n2")
    with pytest.raises(KeyError):
        predicate(df, "zz", "=", 1)
    with pytest.raises(IndexError):
        predicate(df, 2, "=", 1)


LEFT = [(1, 2), (3, 4), (5, 6), (7, 8)]
RIGHT = [(1, 2, 3), (2, 3, 4), (3, 4, 5), (4, 5, 6), (5, 6, 7)]


@pytest.mark.parametrize("op, size", [("=", 3), (">", 11)])
def test_join_fixture_sizes(spark, op, size):
    a = spark.createDataFrame(LEFT, "l0 int, l1 int")
    b = spark.createDataFrame(RIGHT, "r0 int, r1 int, r2 int")
    assert joins.join(a, 0, op, b, 0).count() == size


@pytest.mark.parametrize("op", list(TESTS))
@pytest.mark.parametrize("bucket_rows, least_pairs", [(3, 1), (9, 40), (20_000, 100)])
def test_joins_match_brute_force_with_a_hot_value(spark, op, bucket_rows, least_pairs):
    rnd = random.Random(bucket_rows)
    left = [(i, 5 if i % 3 == 0 else rnd.randint(0, 20)) for i in range(60)] + [(99, None)]
    right = [(i, rnd.randint(-2, 22)) for i in range(25)] + [(98, None)]
    a = spark.createDataFrame(left, "lid int, lv int")
    b = spark.createDataFrame(right, "rid int, rv int")
    want = sorted((x, v, y, w) for x, v in left for y, w in right
                  if v is not None and w is not None and TESTS[op](v, w))
    assert rows(joins.join(a, "lv", op, b, "rv", bucket_rows=bucket_rows, least_pairs=least_pairs)) == want


@pytest.mark.parametrize("op", ["<", ">=", "<>"])
def test_string_joins_match_brute_force(spark, op):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 9)))
    left = [(i, word()) for i in range(40)]
    right = [(i, word()) for i in range(20)]
    a, b = spark.createDataFrame(left, "lid int, lv string"), spark.createDataFrame(right, "rid int, rv string")
    want = sorted((x, v, y, w) for x, v in left for y, w in right
                  if TESTS[op](v.encode(), w.encode()))
    assert rows(joins.join(a, "lv", op, b, "rv", bucket_rows=5, least_pairs=7)) == want


@pytest.mark.parametrize("op", list(TESTS))
def test_joins_of_other_types_match_brute_force(spark, op):
    big = 2**53
    left = [(i, v) for i, v in enumerate([big + 1, big, -3, 0, 7, None, big - 1] * 2)]
    right = [(i, v) for i, v in enumerate([float(big), -3.0, -0.0, float("nan"), float("inf"), None, 6.5] * 2)]
    a, b = spark.createDataFrame(left, "lid int, lv long"), spark.createDataFrame(right, "rid int, rv double")
    want = a.crossJoin(b).where(F.expr(f"lv {op} rv"))
    found = joins.join(a, "lv", op, b, "rv", bucket_rows=3, least_pairs=2)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def _buckets(sizes, bounds):
    return [regions.Bucket(i, n, (0, low), (0, high)) for i, (n, (low, high)) in enumerate(zip(sizes, bounds))]


def test_regions_have_about_equal_output():
    """A hot value in several buckets, and one bucket that no partner reaches."""
    left = _buckets([100] * 20, [(i, i + 1) if i > 8 else (4, 4) for i in range(20)])
    right = _buckets([100] * 30, [(i - 10, i - 9) for i in range(30)])
    for op in (Op.LESS_THAN, Op.GREATER_THAN_OR_EQ, Op.NOT_EQUALS):
        _, rights, sizes = regions.cover(left, right, op, 10_000)
        median = sorted(sizes)[len(sizes) // 2]
        assert max(sizes) <= 2 * median and sum(sizes) > 500_000
        assert len(sizes) == 1 + max(first + parts - 1 for _, first, parts in rights)
    assert min(b for b, *_ in regions.cover(left, right, Op.LESS_THAN, 10_000)[1]) > 10


def test_strings_with_a_common_prefix_are_pruned(spark):
    a = spark.range(400).selectExpr("format_string('Customer#%09d', id) AS lv")
    _, buckets = regions.bucketed_side(a, F.col("lv"), "b", "c", 50)
    assert len(buckets) == 8 and all(x.high < y.low for x, y in zip(buckets, buckets[1:]))
    lefts, rights, _ = regions.cover(buckets, buckets, Op.LESS_THAN, 2500)
    assert len(rights) == 8 * 9 // 2
    found = joins.join(a, "lv", "<", a.withColumnRenamed("lv", "rv"), "rv", bucket_rows=50, least_pairs=100)
    assert found.count() == 400 * 399 // 2


def test_a_skewed_join_has_even_tasks(spark):
    a = spark.range(3000).selectExpr("if(id % 3 = 0, 500, id) AS lv")
    b = spark.range(2000).selectExpr("if(id % 2 = 0, 700, id) AS rv")
    plan = joins.join(a, "lv", "<", b, "rv", bucket_rows=100, least_pairs=1)
    assert plan.count() == sum((500 if i % 3 == 0 else i) < (700 if j % 2 == 0 else j) for i in range(3000) for j in range(2000))
    out = plan.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    sizes = sorted(r["count"] for r in out)
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_inequality_join_has_no_nested_loop(spark):
    a = spark.range(1000).select(F.col("id").alias("a"))
    b = spark.range(1000).select(F.col("id").alias("b"))
    plan = joins.join(a, "a", "<", b, "b")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("pack_bytes, text_bytes", [(1 << 20, 1 << 20), (10, 50), (1, 1 << 20)])
def test_containing_join_both_ways(spark, monkeypatch, pack_bytes, text_bytes):
    monkeypatch.setattr(joins, "HITS", 7)
    rnd = random.Random(1)
    word = lambda lo, hi: "".join(rnd.choice("ab") for _ in range(rnd.randint(lo, hi)))
    left = [(i, word(0, 12)) for i in range(40)] + [(100, "ab"), (100, "ab")]
    right = [(i, word(0, 6)) for i in range(30)] + [(50, ""), (51, None)]
    a = spark.createDataFrame(left, "lid int, lv string")
    b = spark.createDataFrame(right, "rid int, rv string")
    want = sorted((x, v, y, w) for x, v in left for y, w in right if w is not None and w in v)
    assert rows(joins.join_containing(a, "lv", b, "rv", pack_bytes, text_bytes)) == want
    plan = joins.join_containing(a, "lv", b, "rv")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan


def test_join_hot_matches_plain_join(spark):
    left = spark.createDataFrame([(1 if i % 2 else i, i) for i in range(300)], "k long, v long")
    right = spark.createDataFrame([(i, i * 10) for i in range(0, 300, 3)] + [(1, 7), (1, 8)], "k2 long, w long")
    for how in ("inner", "left"):
        assert sorted(map(str, joins.join_hot(left, right, "k", "k2", how).collect())) == sorted(
            map(str, left.join(right, left.k == right.k2, how).collect()))


def test_scan_and_schema(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert scan(df, "t").columns == ["t_a", "t_b"]
    other = T.StructType().add("c", "integer").add("d", "string")
    assert same_types(df.schema, other)
    assert not same_types(df.schema, T.StructType().add("c", "integer"))
    merged = merge_schemas(df.schema, other)
    assert merged.names == ["a", "b", "c", "d"]
    assert field_index(merge_schemas(df.schema, df.schema), "b") == 1
    with pytest.raises(KeyError):
        field_index(merged, "zz")
    assert scan_rows(spark, other, df).columns == ["c", "d"]
    assert rows(scan_rows(spark, other, [(1, "y")])) == [(1, "y")]
    with pytest.raises(Exception):
        scan_rows(spark, other, [("no", "y")])
    with pytest.raises(TypeError):
        scan_rows(spark, other, df.select("b", "a"))


def test_insert_counts_and_appends(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([(9, 9)], "a int, b int").write.parquet(path)
    source = [(1, 2), (1, 4), (1, 6), (3, 2), (3, 4), (3, 6), (5, 7)]
    result = insert_into(spark.createDataFrame(source, "x int, y int"), path)
    assert rows(result) == [(7,)] and rows(result) == [(7,)]
    assert rows(spark.read.parquet(path)) == sorted([*source, (9, 9)])
    with pytest.raises(TypeError):
        insert_into(spark.createDataFrame([("a", 1)], "x string, y int"), path)


@pytest.mark.parametrize("source, dest", [(0, 0), (0, 1), (1, 0), (1, 1)])
def test_insert_sizes(spark, source, dest):
    path = scratch_path(spark, "t")
    spark.createDataFrame([(1,)] * dest, "a int").write.parquet(path)
    assert rows(insert_into(spark.createDataFrame([(2,)] * source, "a int"), path)) == [(source,)]
    assert spark.read.parquet(path).count() == source + dest


def test_delete_keeps_rows_with_a_null_condition(spark):
    path, new = scratch_path(spark, "t"), scratch_path(spark, "t")
    spark.createDataFrame([(1,), (2,), (None,)], "a int").write.parquet(path)
    assert rows(delete_where(spark, path, F.col("a") > 1, new)) == [(1,)]
    assert spark.read.parquet(new).count() == 2
    assert spark.read.parquet(path).count() == 3


def test_bags(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    b = spark.createDataFrame([(1,), (3,)], "b int")
    assert rows(bags.bag_union(a, b)) == [(1,), (1,), (1,), (2,), (3,)]
    assert rows(bags.bag_difference(a, b)) == [(1, "unexpected", 1), (2, "unexpected", 1), (3, "missing", 1)]
    assert bags.bag_difference(a, a).count() == 0
    assert rows(bags.contains_all(a, b)) == [(3,)]
    with pytest.raises(TypeError):
        bags.bag_union(a, spark.createDataFrame([("x",)], "b string"))


def test_key_range(spark):
    df = spark.createDataFrame([(k,) for k in (1, 3, 5, 7, 9)], "k int")
    assert rows(kv.key_range(df, "k", 2, 7)) == [(3,), (5,)]
    assert rows(kv.key_range(df, "k", 7, 2)) == []


def test_catalog(spark):
    catalog = Catalog(spark, "test_")
    first = catalog.add_table(spark.range(1).toDF("a"), "t", "a")
    second = catalog.add_table(spark.range(2).toDF("b"), "t")
    assert catalog.table_id("t") == second and catalog.table_name(first) == "t"
    assert catalog.primary_key(first) == "a" and catalog.primary_key(second) == ""
    assert catalog.schema(first).fields[0].metadata == {"pk": True}
    assert catalog.table("t").count() == 2 and catalog.table_ids() == [first, second]
    with pytest.raises(KeyError):
        catalog.table_id("missing")
    catalog.clear()
    with pytest.raises(KeyError):
        catalog.table("t")


def test_parse_schema():
    entry = parse_schema("people (id int pk, name string)")
    assert (entry.name, entry.pk, entry.schema.names) == ("people", "id", ["id", "name"])
    for bad in ("people id int", "p (id float)", "p (id int key)", "p (id)"):
        with pytest.raises(ValueError):
            parse_schema(bad)
