"""Sorting by a comparison, and partitions that a slicer decides."""

import functools
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from millrace.operators import comparator, partitioning

from conftest import rows

# The comparisons travel to the workers, which don't know this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def together(a, b):
    return (a[0] + b[0] < b[0] + a[0]) - (a[0] + b[0] > b[0] + a[0])


def nulls_last_by_length(a, b):
    """None after all, then the longer text, then the smaller number; an order over two columns."""
    key = lambda r: (r[0] is None, -len(r[0] or ""), -1 if r[1] is None else r[1])
    return (key(a) > key(b)) - (key(a) < key(b))


def ranks(items, compare):
    order = functools.cmp_to_key(compare)
    ordered = sorted(items, key=order)
    first = {}
    for i, item in enumerate(ordered):
        if not i or order(ordered[i - 1]) < order(item):
            head = i + 1
        first[item] = head
    return ordered, first


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_ranks_with_a_hot_value(spark, parts):
    rng = random.Random(4)
    words = [str(rng.randint(1, 300)) for _ in range(2000)] + ["12"] * 700 + ["1212"] * 300
    rng.shuffle(words)
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id int, word string").repartition(5)
    got = comparator.sort_by(df, ["word"], together, parts).collect()
    _, want = ranks([(w,) for w in words], together)
    assert sorted(r["position"] for r in got) == list(range(len(words)))
    assert all(r["rank"] == want[r["word"],] for r in got)
    ordered = sorted(got, key=lambda r: r["position"])
    assert all(together((a["word"],), (b["word"],)) <= 0 for a, b in zip(ordered, ordered[1:]))
    assert sorted(r["id"] for r in got) == list(range(len(words)))


def test_a_hot_value_is_dealt_over_parts(spark):
    df = spark.range(4000).selectExpr("id", "if(id % 4 = 0, cast(id AS string), '5') AS word").repartition(4)
    cuts = comparator.splitters(df, ["word"], together, 8)
    dealt = df.mapInArrow(comparator._dealt(["word"], together, cuts, "part", "run"), "id long, word string, part int, run long")
    hot = dealt.where("word = '5'").groupBy("part").count().collect()
    assert len(hot) >= 5 and max(r["count"] for r in hot) < 1000


def test_two_columns_nulls_and_names(spark):
    data = [(1, None, 2, 7), (2, "ab", None, 7), (3, "abc", 1, 7), (4, "abd", 1, 7), (5, None, 1, 7), (6, "", 0, 7), (6, "", 0, 7)]
    df = spark.createDataFrame(data, "id int, __part string, rank int, __run int")
    got = comparator.sort_by(df.withColumnRenamed("rank", "n"), ["__part", "n"], nulls_last_by_length, 3).collect()
    ordered, want = ranks([(r[1], r[2]) for r in data], nulls_last_by_length)
    assert sorted((r["position"], r["rank"]) for r in got) == sorted((i, want[k]) for i, k in enumerate(ordered))
    assert all(r["rank"] == want[r["__part"], r["n"]] and r["__run"] == 7 for r in got)


def test_empty(spark):
    df = spark.createDataFrame([], "id int, word string")
    assert comparator.sort_by(df, ["word"], together, 3).collect() == []


def test_layout():
    assert partitioning.slice_layout({2: 10, 0: 900, 5: 90}, 10) == {0: (0, 9), 2: (9, 1), 5: (10, 1)}


def test_the_slicer_decides_the_partition(spark):
    df = spark.range(3000).selectExpr("id", "if(id % 10 < 7, 7L, id) AS hot").repartition(3)
    dealt = partitioning.repartition_sliced(df, F.when(F.col("hot") == 7, 3).otherwise(F.col("id") % 3), 12)
    got = dealt.select("id", "slice", "part", F.spark_partition_id().alias("at")).collect()
    assert sorted(r["id"] for r in got) == list(range(3000))
    assert all(r["part"] == r["at"] for r in got)
    own = {}
    for r in got:
        own.setdefault(r["slice"], set()).add(r["part"])
    assert sum(map(len, own.values())) == len(set().union(*own.values()))
    assert len(own[3]) == 9
    sizes = dealt.where("slice = 3").groupBy("part").count().collect()
    assert max(r["count"] for r in sizes) < 2 * 2100 / 9


def test_slices_of_equal_rows_null_slices_and_empty_tables(spark):
    same = spark.range(4000).selectExpr("1 AS x").repartition(8)
    parts = partitioning.repartition_sliced(same, F.lit(2), 6).groupBy("part").count().collect()
    assert len(parts) > 1 and sum(r["count"] for r in parts) == 4000
    with pytest.raises(Exception, match="gave no slice"):
        partitioning.repartition_sliced(same, F.lit(None).cast("int"), 6)
    assert rows(partitioning.repartition_sliced(spark.createDataFrame([], "x int"), F.lit(0), 4)) == []
