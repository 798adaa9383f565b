"""Column histograms, selectivity and table profiles, as reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import PREFIX_MAX, prefix_code_of, str_prefix_code
from .predicates import Op

# Fixed value: buckets per column of a table profile.
BUCKETS = 100


def bucket_of(value: Column, buckets: int, low: int, high: int) -> Column:
    """Bucket 0..buckets-1 of an integer in [low, high], exact at the edges; a value outside is an error."""
    wide = (high - low + 1) * buckets >= 1 << 63
    kind = "decimal(38,0)" if wide else "long"
    scaled = (value.cast(kind) - F.lit(low).cast(kind)) * F.lit(buckets)
    bucket = F.call_function("div", scaled.cast(kind), F.lit(high - low + 1).cast(kind)).cast("int")
    outside = F.raise_error(F.concat(F.lit(f"not within {low} and {high}: "), value.cast("string"))).cast("int")
    return F.when(value.isNull() | value.between(low, high), bucket).otherwise(outside)


def bounds_of(df: DataFrame, column: str) -> tuple[int, int]:
    """The lowest and highest value of an int column; (0, 0) without values."""
    row = df.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    return (0, 0) if row["low"] is None else (row["low"], row["high"])


def histogram(df: DataFrame, column: str, buckets: int, low: int, high: int) -> DataFrame:
    """(bucket, count) of an int column; empty buckets are absent and nulls count nowhere."""
    return df.where(F.col(column).isNotNull()).groupBy(
        bucket_of(F.col(column), buckets, low, high).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("count"))


def _first_value(bucket: Column, buckets: int, low: int, high: int) -> Column:
    """Lowest integer that falls into ``bucket``."""
    width = high - low + 1
    kind = "decimal(38,0)" if width * buckets >= 1 << 63 else "long"
    scaled = bucket.cast(kind) * F.lit(width).cast(kind) + F.lit(buckets - 1).cast(kind)
    return F.call_function("div", scaled.cast(kind), F.lit(buckets).cast(kind)).cast("decimal(38,0)") + F.lit(low).cast("decimal(38,0)")


def selectivity(hist: DataFrame, op: Op | str | int, value: int, buckets: int, low: int,
                high: int) -> DataFrame:
    """Estimated share of rows with ``op value``: one row, column ``selectivity``.

    Values are taken as even within a bucket.
    """
    share = _share(Op.of(op), value, F.col("bucket"), buckets, low, high)
    return hist.agg(F.coalesce(
        F.sum(F.col("count") * share) / F.sum("count"), F.lit(0.0)).alias("selectivity"))


def _share(op: Op, value: int, bucket: Column, buckets: int, low: int, high: int) -> Column:
    """Share of a bucket's rows with ``op value``."""
    first = _first_value(bucket, buckets, low, high)
    after = _first_value(bucket + 1, buckets, low, high)
    sought = F.lit(value).cast("decimal(38,0)")
    size = (after - first).cast("double")
    below = F.least(F.greatest(sought - first, F.lit(0)), after - first).cast("double") / size
    equal = F.when((sought >= first) & (sought < after), 1.0 / size).otherwise(0.0)
    return {
        Op.EQUALS: equal,
        Op.LIKE: equal,
        Op.NOT_EQUALS: 1.0 - equal,
        Op.LESS_THAN: below,
        Op.LESS_THAN_OR_EQ: below + equal,
        Op.GREATER_THAN: 1.0 - below - equal,
        Op.GREATER_THAN_OR_EQ: 1.0 - below,
    }[op]


def string_histogram(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Histogram over the four-character code of a string column."""
    coded = df.select(str_prefix_code(F.col(column)).alias("code"))
    return histogram(coded, "code", buckets, 0, PREFIX_MAX)


def string_selectivity(df: DataFrame, column: str, op: Op | str | int, value: str,
                       buckets: int = BUCKETS) -> DataFrame:
    code = min(max(prefix_code_of(value), 0), PREFIX_MAX)
    return selectivity(string_histogram(df, column, buckets), op, code, buckets, 0, PREFIX_MAX)


def table_stats(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(column, low, high, bucket, count) of every int and string column, in two passes.

    A string counts by the code of its first four characters. The first pass finds all bounds; the second turns
    each row into one bucket number per column and counts them before the shuffle. Nulls count nowhere.
    """
    coded = {f.name: F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)}
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not coded and not texts:
        raise ValueError("no int or string column")
    bounds = df.agg(F.lit(0).alias("none"), *[F.min(c).alias(f"{n}_lo") for n, c in coded.items()],
                    *[F.max(c).alias(f"{n}_hi") for n, c in coded.items()]).first()
    ends = {n: (bounds[f"{n}_lo"], bounds[f"{n}_hi"]) for n in coded if bounds[f"{n}_lo"] is not None}
    ends |= {n: (0, PREFIX_MAX) for n in texts}
    coded |= {n: F.when(F.col(f"`{n}`").isNotNull(), str_prefix_code(F.col(f"`{n}`"))) for n in texts}
    cells = F.array(*[
        F.struct(F.lit(n).alias("column"), F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"),
                 bucket_of(coded[n], buckets, low, high).alias("bucket"))
        for n, (low, high) in ends.items()])
    if not ends:
        cells = F.array().cast("array<struct<column:string,low:bigint,high:bigint,bucket:int>>")
    return df.select(F.explode(cells).alias("c")).select("c.*").where("bucket is not null").groupBy(
        "column", "low", "high", "bucket").agg(F.count(F.lit(1)).alias("count"))


def stats_cardinality(stats: DataFrame, column: str, op: Op | str | int, value: int | str,
                      buckets: int = BUCKETS) -> DataFrame:
    """From :func:`table_stats`, one row: rows that have a value, the share with ``op value``, and how many that is.

    Only the column's bounds and its buckets, at most ``buckets``, are read.
    """
    mine = stats.where(F.col("column") == column)
    ends = mine.select("low", "high").first()
    low, high = (ends["low"], ends["high"]) if ends else (0, 0)
    if isinstance(value, str):
        value = min(max(prefix_code_of(value), 0), PREFIX_MAX)
    share = selectivity(mine, op, value, buckets, low, high)
    total = mine.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
    return total.join(F.broadcast(share)).select(
        "rows", "selectivity", F.floor(F.col("rows") * F.col("selectivity") + 1e-9).alias("cardinality"))
