"""Bag operations: union and comparison with duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import same_types


def bag_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both sides, duplicates kept; columns match by position."""
    if not same_types(a.schema, b.schema):
        raise TypeError("schemas differ")
    return a.union(b)


def bag_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows whose multiplicities differ: ``status`` is missing or unexpected, ``copies`` how often.

    Both sides are counted before the shuffle, so many equal rows cost one
    partial row per task.
    """
    names = actual.columns
    tagged = actual.select(*names, F.lit(1).alias("copies")).union(
        expected.toDF(*names).select(*names, F.lit(-1).alias("copies")))
    net = tagged.groupBy(*names).agg(F.sum("copies").alias("copies")).where("copies <> 0")
    return net.select(
        *names,
        F.when(F.col("copies") > 0, "unexpected").otherwise("missing").alias("status"),
        F.abs("copies").alias("copies"),
    )


def contains_all(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct expected rows that are absent; empty means all were found."""
    names = actual.columns
    have = actual.distinct().toDF(*[f"{n}_a" for n in names])
    match = F.lit(True)
    for n in names:
        match = match & F.col(n).eqNullSafe(F.col(f"{n}_a"))
    return expected.toDF(*names).distinct().join(have, match, "left_anti")
