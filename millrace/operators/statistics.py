"""Statistics of a table that grow by files: sketches of each file, merged without reading its rows again.

An int column has a KLL sketch (ranks and quantiles, so equi-depth bounds too), a theta sketch (different values) and a count-min
table (how often a value occurs). ``errors`` states how far estimates may be off.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accuracy of the KLL sketch; twice the logarithm of the entries of a theta sketch; rows and cells of a count-min table.
KLL_K, THETA_LOG, DEPTH, WIDTH = 400, 14, 5, 2048


def errors(rows: int) -> dict[str, float]:
    """Bounds on the errors: of a rank's share, of the number of different values as a share, of a value's count."""
    return {"rank": 2.5 / KLL_K**0.9, "distinct": 4 / math.sqrt(2**THETA_LOG), "count": math.e / WIDTH * rows * 2}


def _cell(value: Column, depth: Column) -> Column:
    return F.pmod(F.xxhash64(depth, value.cast("long")), F.lit(WIDTH)).cast("int")


def file_statistics(df: DataFrame, columns: list[str], part: Column) -> tuple[DataFrame, DataFrame]:
    """(sketches, counts) per ``part``, as a file's name, and column: part, column, rows, low, high, kll, theta; and part, column, depth, cell, n.

    A file is read once for each of the two; both are combined in the tasks before rows are moved. Nulls count nowhere.
    """
    named = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("long").alias("value")) for c in columns]
    values = df.select(part.alias("part"), F.explode(F.array(*named)).alias("v")).select("part", "v.*").where("value IS NOT NULL")
    sketches = values.groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.kll_sketch_agg_bigint("value", KLL_K).alias("kll"), F.theta_sketch_agg("value", THETA_LOG).alias("theta"))
    cells = values.groupBy("part", "column", "value").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "column", "n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(DEPTH - 1)), lambda d: F.struct(
            d.alias("depth"), _cell(F.col("value"), d).alias("cell")))).alias("c"))
    counts = cells.groupBy("part", "column", "c.depth", "c.cell").agg(F.sum("n").alias("n"))
    return sketches, counts


def merged(sketches: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The statistics of all files together: column, rows, low, high, kll, theta; and column, depth, cell, n."""
    whole = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_bigint("kll").alias("kll"), F.theta_union_agg("theta", THETA_LOG).alias("theta"))
    return whole, counts.groupBy("column", "depth", "cell").agg(F.sum("n").alias("n"))


def share_at_most(whole: DataFrame, column: str, value: int) -> DataFrame:
    """One row: rows, and the estimated share with a value of at most ``value``."""
    return whole.where(F.col("column") == column).select(
        "rows", F.kll_sketch_get_rank_bigint("kll", F.lit(value).cast("long")).alias("share"))


def equi_depth(whole: DataFrame, buckets: int) -> DataFrame:
    """(column, bucket, upper): bounds of ``buckets`` buckets of about equally many rows."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets + 1)])
    bounds = whole.select("column", F.kll_sketch_get_quantile_bigint("kll", shares).alias("uppers"))
    return bounds.select("column", F.posexplode("uppers").alias("bucket", "upper"))


def distinct_values(whole: DataFrame) -> DataFrame:
    """(column, n): the estimated number of different values."""
    return whole.select("column", F.theta_sketch_estimate("theta").alias("n"))


def occurrences(counts: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """``values`` with estimate: how often each occurs in ``column``, never too low."""
    asked = values.withColumn("__at", F.explode(F.transform(F.sequence(F.lit(0), F.lit(DEPTH - 1)), lambda d: F.struct(
        d.alias("depth"), _cell(F.col(value), d).alias("cell")))))
    mine = counts.where(F.col("column") == column).select(F.struct("depth", "cell").alias("__at"), F.col("n").alias("__n"))
    return asked.join(mine, "__at", "left").groupBy(*values.columns).agg(F.min(F.coalesce("__n", F.lit(0))).alias("estimate"))
