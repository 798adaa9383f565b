"""Sketches that are merged, a table with deletes by place, and a load that reports."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import statistics
from millrace.operators.positions import PositionedTable
from millrace.sources import delimited


def test_merged_estimates_are_within_their_bounds(spark):
    rng = random.Random(2)
    values = [rng.choice([7, rng.randint(0, 10**6)]) for _ in range(20_000)]
    df = spark.createDataFrame([(i % 6, v, None if i % 2 else 1) for i, v in enumerate(values)], "part int, a int, b long")
    sketches, counts = statistics.file_statistics(df, ["a", "b"], F.col("part"))
    assert sketches.count() == 9  # the odd files have no b
    whole, cells = statistics.merged(sketches.where("part < 5").union(sketches.where("part = 5")), counts)
    bound = statistics.errors(len(values))
    for v in (0, 7, 1000, 500_000, 10**6):
        got = statistics.share_at_most(whole, "a", v).first()
        assert got["rows"] == len(values) and abs(got["share"] - sum(x <= v for x in values) / len(values)) <= bound["rank"]
    distinct = {r["column"]: r["n"] for r in statistics.distinct_values(whole).collect()}
    assert distinct["b"] == 1 and abs(distinct["a"] / len(set(values)) - 1) <= bound["distinct"]
    asked = spark.createDataFrame([(7,), (-5,)], "v int")
    often = {r["v"]: r["estimate"] for r in statistics.occurrences(cells, "a", asked, "v").collect()}
    assert values.count(7) <= often[7] <= values.count(7) + bound["count"] and 0 <= often[-5] <= bound["count"]
    uppers = [r["upper"] for r in statistics.equi_depth(whole, 4).where("column = 'a'").orderBy("bucket").collect()]
    assert len(uppers) == 4 and all(sum(x <= u for x in values) / len(values) >= (i + 1) / 4 - bound["rank"] for i, u in enumerate(uppers))


SCHEMA = T.StructType().add("id", "long").add("v", "string")


def some(spark, low, high, files=2):
    return spark.range(low, high, 1, files).selectExpr("id", "if(id % 7 = 0, null, concat('v', id)) AS v")


def ids(table):
    return sorted(r["id"] for r in table.scan().collect())


def test_deletes_and_rewrites(spark):
    table = PositionedTable(spark, SCHEMA)
    assert ids(table) == [] and table.rewrite() == 0 and table.delete(F.lit(True)) == 0
    table.append(some(spark, 0, 100))
    table.append(some(spark, 100, 150, 1))
    assert table.delete(F.col("id") % 10 == 3) == 15
    assert table.delete(F.col("id") % 10 == 3) == 0
    assert table.delete(F.col("v") == "v7") == 0  # null there, and a null condition deletes nothing
    assert table.delete((F.col("id") < 20) & (F.col("id") % 10 < 5)) == 8
    want = [i for i in range(150) if i % 10 != 3 and not (i < 20 and i % 10 < 5)]
    assert ids(table) == want
    assert table.rewrite(0.2) == 1  # 13 of the 50 rows of the first file
    assert ids(table) == want
    assert table.rewrite() == 2 and table.rewrite() == 0
    table.append(some(spark, 200, 203))
    assert ids(table) == [*want, 200, 201, 202]
    assert table.delete(F.col("id") >= 149) == 4
    assert ids(table) == want[:-1]


def test_a_rewrite_that_stops_changes_nothing(spark, monkeypatch):
    table = PositionedTable(spark, SCHEMA)
    table.append(some(spark, 0, 40))
    table.delete(F.col("id") < 5)
    before, real = ids(table), table._live
    calls = []

    def fail():
        calls.append(1)
        return real().select("*", F.raise_error(F.lit("stopped")).alias("x")).where("x IS NULL").drop("x")

    monkeypatch.setattr(table, "_live", fail)
    with pytest.raises(Exception, match="stopped"):
        table.rewrite()
    monkeypatch.undo()
    assert calls and ids(table) == before
    table.append(some(spark, 50, 52))
    assert ids(table) == [*before, 50, 51]
    assert table.rewrite() == 1 and ids(table) == [*before, 50, 51]


def test_a_load_reports_in_one_pass(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1,x\n2,y\r\n\nbad\n")
    (tmp_path / "in" / "b.txt").write_text("x,worse\n3,z\n1,2,3")
    schema = T.StructType().add("line", "integer").add("fits", "string")
    report = delimited.load_delimited(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"))
    assert rows(report) == [(3, 3, 24, "bad")]
    good, bad = delimited.loaded(spark, schema, str(tmp_path / "out"))
    assert rows(good) == [(1, "x"), (2, "y"), (3, "z")] and good.columns == ["line", "fits"]
    assert rows(bad) == [("1,2,3",), ("bad",), ("x,worse",)]


def test_a_load_of_nothing(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n")
    schema = T.StructType().add("a", "integer")
    report = delimited.load_delimited(spark, str(tmp_path / "in.txt"), schema, str(tmp_path / "out"))
    assert rows(report) == [(0, 0, 0, None)]
    good, bad = delimited.loaded(spark, schema, str(tmp_path / "out"))
    assert good.collect() == [] and bad.collect() == []
