"""Inequality joins over regions of the matrix of both sides.

Each side is cut into buckets along its order by Spark's range partitioning, with a hash behind the value, so that a value with many
rows fills several buckets. The bounds and sizes of the buckets are a histogram of the matrix: a cell, one bucket of
each side, holds no pair, some, or all. Cells that can hold pairs are put together, or split by hash of the left rows, to
regions of about equal estimated output, and rows travel only to the regions of their bucket. Values of any length are
compared whole.
"""

from __future__ import annotations

import bisect
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .predicates import Op

# Rows of a bucket, and buckets of a side at most: the driver sees a row for each. Pairs of a region at least.
BUCKET_ROWS, MOST_BUCKETS, LEAST_PAIRS = 20_000, 1000, 100_000


@dataclass
class Bucket:
    number: int
    rows: int
    low: object
    high: object


def _total(value):
    """A key that orders as Spark does: NaN is above all numbers."""
    return (1, 0) if isinstance(value, float) and math.isnan(value) else (0, value)


def bucketed_side(df: DataFrame, value: Column, bucket: str, code: str, bucket_rows: int) -> tuple[DataFrame, list[Bucket]]:
    """``df`` without null values, with its bucket and the value, and the buckets in order."""
    known = df.withColumn(code, value).where(F.col(code).isNotNull())
    sizes = known.agg(F.count(F.lit(1)).alias("n"), F.min(code).alias("low"), F.max(code).alias("high")).first()
    count = min(MOST_BUCKETS, -(-sizes["n"] // bucket_rows))
    if count <= 1:
        # Always 0, but no constant, over which Spark would plan a nested loop.
        return known.withColumn(bucket, F.pmod(F.hash(code), F.lit(1))), [Bucket(0, sizes["n"], _total(sizes["low"]), _total(sizes["high"]))] if sizes["n"] else []
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    dealt = cut_lineage(known.withColumn("__spread", spread).repartitionByRange(count, code, "__spread").drop("__spread")
                        .withColumn(bucket, F.spark_partition_id()), "buckets")
    found = dealt.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"), F.min(code).alias("low"), F.max(code).alias("high")).collect()
    return dealt, [Bucket(r[bucket], r["n"], _total(r["low"]), _total(r["high"])) for r in sorted(found, key=lambda r: r[bucket])]


def candidates(left: Bucket, right: list[Bucket], lows: list, highs: list, op: Op) -> list[tuple[Bucket, int]]:
    """The right buckets that can hold partners, with the estimated number of pairs. ``lows`` and ``highs`` are theirs, in order."""
    n = len(right)
    if op is Op.LESS_THAN:
        some, full = range(bisect.bisect_right(highs, left.low), n), lambda b: left.high < b.low
    elif op is Op.LESS_THAN_OR_EQ:
        some, full = range(bisect.bisect_left(highs, left.low), n), lambda b: left.high <= b.low
    elif op is Op.GREATER_THAN:
        some, full = range(0, bisect.bisect_left(lows, left.high)), lambda b: left.low > b.high
    elif op is Op.GREATER_THAN_OR_EQ:
        some, full = range(0, bisect.bisect_right(lows, left.high)), lambda b: left.low >= b.high
    else:
        one = left.low == left.high
        some, full = [j for j in range(n) if not (one and lows[j] == highs[j] == left.low)], lambda b: True
    return [(right[j], left.rows * right[j].rows // (1 if full(right[j]) else 2)) for j in some]


def cover(left: list[Bucket], right: list[Bucket], op: Op, pairs: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], list[int]]:
    """Regions of at most about ``pairs`` estimated pairs.

    Returns (left bucket, first region, number of regions a row chooses from by hash), (right bucket, first region, number of regions
    it goes to all of), and the estimate of each region.
    """
    lows, highs = [b.low for b in right], [b.high for b in right]
    lefts, rights, sizes = [], [], []
    for b in left:
        held = None  # the estimate of the open region of this bucket
        for other, estimate in candidates(b, right, lows, highs, op):
            if estimate > pairs:
                parts = min(b.rows, -(-estimate // pairs))
                lefts.append((b.number, len(sizes), parts))
                rights.append((other.number, len(sizes), parts))
                sizes += [estimate // parts] * parts
                held = None
                continue
            if held is None or held + estimate > pairs:
                held = 0
                lefts.append((b.number, len(sizes), 1))
                sizes.append(0)
            held += estimate
            sizes[-1] = held
            rights.append((other.number, len(sizes) - 1, 1))
    return lefts, rights, sizes


def join_regions(left: DataFrame, lvalue: Column, op: Op, right: DataFrame, rvalue: Column, test: Column,
                 bucket_rows: int = BUCKET_ROWS, least_pairs: int = LEAST_PAIRS) -> DataFrame:
    """All pairs for which ``test`` holds, which implies ``lvalue op rvalue`` for one of the inequalities. Null values have no partner."""
    spark = left.sparkSession
    ldata, lbuckets = bucketed_side(left, lvalue, "__bucket_l", "__code_l", bucket_rows)
    rdata, rbuckets = bucketed_side(right, rvalue, "__bucket_r", "__code_r", bucket_rows)
    lows, highs = [b.low for b in rbuckets], [b.high for b in rbuckets]
    total = sum(e for b in lbuckets for _, e in candidates(b, rbuckets, lows, highs, op))
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = max(least_pairs, min(bucket_rows**2, total // (4 * parallel)))
    lefts, rights, _ = cover(lbuckets, rbuckets, op, pairs)
    table = lambda rows, at: spark.createDataFrame(rows, f"{at} int, __first long, __parts long")
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id())
    lside = ldata.withColumn("__hash", row_hash).join(table(lefts, "__bucket_l"), "__bucket_l").select(
        *[F.col(f"`{c}`") for c in left.columns], (F.col("__first") + F.pmod(F.col("__hash"), F.col("__parts"))).alias("__region_l"))
    every = F.sequence(F.col("__first"), F.col("__first") + F.col("__parts") - 1)
    rside = rdata.join(table(rights, "__bucket_r"), "__bucket_r").select(
        *[F.col(f"`{c}`") for c in right.columns], F.explode(every).alias("__region_r"))
    return lside.join(rside, (F.col("__region_l") == F.col("__region_r")) & test).drop("__region_l", "__region_r")
