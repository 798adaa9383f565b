"""Numeric CSV with one label column, and mini-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import lenient_float
from ..operators.ordered import with_rank
from .delimited import read_lines


def parse_labelled(lines: DataFrame, label_col: int, width: int | None = None) -> DataFrame:
    """(label, features) of each line; an empty inner field is 0, a wrong width fails."""
    fields = F.split(F.regexp_replace("line", ",$", ""), ",", -1)
    row = lines.select(F.transform(fields, lenient_float).alias("v"))
    if width is not None:
        row = row.select(F.when(F.size("v") == width, F.col("v")).otherwise(
            F.raise_error(F.lit("wrong number of fields")).cast("array<float>")).alias("v"))
    features = F.concat(F.slice("v", 1, label_col), F.slice(
        "v", F.lit(label_col + 2), F.greatest(F.size("v") - label_col - 1, F.lit(0))))
    return row.select(F.get("v", F.lit(label_col)).alias("label"), features.alias("features"))


def scan_labelled(spark: SparkSession, path: str, label_col: int,
                  width: int | None = None) -> DataFrame:
    return parse_labelled(read_lines(spark, path), label_col, width)


def minibatch(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Add ``batch_id``: consecutive runs of ``size`` rows along a unique int column."""
    ranked = with_rank(rows.select(order), order, "rank_b").select(
        F.col(order).alias("order_b"), F.floor((F.col("rank_b") - 1) / size).alias("batch_id"))
    return rows.join(ranked, F.col(order) == F.col("order_b")).select(*rows.columns, "batch_id")
