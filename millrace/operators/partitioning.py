"""Buckets, shards, key ranges and user-defined slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the largest unsigned 64-bit key.
MAX_KEY = (1 << 64) - 1


def key_ranges(n: int, top: int = MAX_KEY) -> list[tuple[int, int]]:
    """n contiguous ranges [begin, end) of equal width; the last one is closed at ``top``."""
    width = top // n
    return [(width * i, top + 1 if i == n - 1 else width * (i + 1)) for i in range(n)]


def range_slice(key: Column, n: int, top: int = MAX_KEY) -> Column:
    """Number of the range that holds ``key``."""
    width = F.lit(str(top // n)).cast("decimal(20,0)")
    whole = key.cast("decimal(20,0)")
    return F.least(((whole - whole % width) / width).cast("int"), F.lit(n - 1))


def slice_summary(df: DataFrame, key: str, n: int, top: int = MAX_KEY) -> DataFrame:
    """Size and bounds of every non-empty slice."""
    return df.groupBy(range_slice(F.col(key), n, top).alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def repartition_balanced(df: DataFrame, key: str, n: int) -> DataFrame:
    """n ranges of about equal row counts, sorted inside."""
    return df.repartitionByRange(n, key).sortWithinPartitions(key)


def sliced(df: DataFrame, slicer: Column) -> DataFrame:
    """Rows with the slice a user expression picks for them."""
    return df.withColumn("slice", slicer)


def slice_layout(counts: dict[int, int], parts: int) -> dict[int, tuple[int, int]]:
    """First partition and number of partitions of each slice: one at least, and of ``parts`` its share of the rows, rounded up."""
    total, layout, first = sum(counts.values()), {}, 0
    for number in sorted(counts):
        layout[number] = first, max(1, -(-counts[number] * parts // total))
        first += layout[number][1]
    return layout


def repartition_sliced(df: DataFrame, slicer: Column, parts: int | None = None, spread: Column | None = None) -> DataFrame:
    """``df`` with slice and part, dealt so that a partition holds rows of one slice only and its number is ``part``.

    The user's ``slicer`` decides: a slice has consecutive partitions, in order of slice. One that holds more than a
    partition's share of the rows has several, among which the second number, ``spread``, deals; by default a hash of the row
    and the task that read it. ``parts`` is about the number of partitions, the session's number of shuffle
    partitions if it is not given. A null slice is an error. The driver sees one row per slice.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = F.coalesce(slicer, F.raise_error(F.lit("the slicer gave no slice")).cast("int"))
    rows = sliced(df, named.cast("int"))
    layout = slice_layout({r["slice"]: r["n"] for r in rows.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).collect()}, parts)
    if not layout:
        return rows.withColumn("part", F.lit(0))
    table = df.sparkSession.createDataFrame([(s, f, n) for s, (f, n) in layout.items()], "slice int, __first int, __number int")
    second = spread if spread is not None else F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())
    # One row per slice.
    placed = rows.withColumn("__second", second).join(F.broadcast(table), "slice").select(
        *[F.col(f"`{c}`") for c in df.columns], "slice",
        (F.col("__first") + F.pmod(F.col("__second"), F.col("__number"))).cast("int").alias("part"))
    return placed.repartitionById(sum(n for _, n in layout.values()), F.col("part"))
