"""Push and pull of numbers and vectors by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce as fold

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import assign


def push_sum(pushes: DataFrame, key: str = "key", value: str = "val") -> DataFrame:
    """Pushed values add up per key."""
    return pushes.groupBy(F.col(key).alias("key")).agg(F.sum(value).alias("val"))


def push_vectors(pushes: DataFrame, keys: list[str], vector: str,
                 length: int | None = None, how: str = "sum") -> DataFrame:
    """Vectors add up (or average) per key and position: (*keys, idx, val, pushes).

    Positions are unfolded and added per task before the shuffle, which was
    measured faster than one sum per position. Each key may have its own
    length; with a common ``length`` any other size is an error.
    """
    agg = {"sum": F.sum, "mean": F.avg}[how]
    cells = F.col(vector)
    if length is not None:
        cells = F.when(F.size(cells) == length, cells).otherwise(
            F.raise_error(F.lit("vector sizes differ")).cast(pushes.schema[vector].dataType))
    return pushes.select(*keys, F.posexplode(cells).alias("idx", "v")).groupBy(*keys, "idx").agg(
        agg(F.col("v").cast("double")).alias("val"), F.count(F.lit(1)).alias("pushes"))


def fold_vectors(sums: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, idx, val) back to one array per key; a vector is bounded by its length."""
    return sums.groupBy(*keys).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("idx", "val"))), lambda e: e["val"]).alias("vals"))


def pull(keys: DataFrame, store: DataFrame, default=0) -> DataFrame:
    """Value of every requested key; a key never pushed reads as ``default``."""
    have = store.select(F.col("key").alias("k_s"), F.col("val").alias("v_s"))
    return keys.join(have, F.col("key") == F.col("k_s"), "left").select(
        *keys.columns, F.coalesce(F.col("v_s"), F.lit(default)).alias("val"))


def pull_strict(keys: DataFrame, store: DataFrame) -> DataFrame:
    """As ``pull``, but a key that was never initialised fails the query."""
    have = store.select(F.col("key").alias("k_s"), F.col("val").alias("v_s"), F.lit(True).alias("h"))
    missing = F.raise_error(F.concat(F.lit("no value was pushed for key "), F.col("key").cast("string")))
    return keys.join(have, F.col("key") == F.col("k_s"), "left").select(
        *keys.columns,
        F.when(F.col("h").isNull(), missing.cast(store.schema["val"].dataType))
        .otherwise(F.col("v_s")).alias("val"))


def match_assign(dst: DataFrame, src: DataFrame, op: str = "ASSIGN", k: int = 1) -> DataFrame:
    """``dst op= src`` where keys match; other rows keep their value, or 0 if null.

    Values are numbers, or arrays of ``k`` numbers. ``matched`` tells which
    rows took part; its count times ``k`` is the number of matched values.
    """
    vectors = isinstance(dst.schema["val"].dataType, T.ArrayType)
    zero = F.array_repeat(F.lit(0), k) if vectors else F.lit(0)
    new = src.select(F.col("key").alias("k_s"), F.col("val").alias("v_s"), F.lit(True).alias("h"))
    kinds = [df.schema["val"].dataType for df in (dst, src)]
    whole = all(isinstance(k.elementType if vectors else k, T.IntegralType) for k in kinds)
    joined = dst.join(new, F.col("key") == F.col("k_s"), "left")
    matched = F.col("h").isNotNull()
    old = F.coalesce(F.col("val"), zero.cast(dst.schema["val"].dataType))
    merged = F.zip_with(old, F.col("v_s"), lambda a, b: assign(op, a, b, whole)) if vectors else assign(
        op, old, F.col("v_s"), whole)
    return joined.select("key", F.when(matched, merged).otherwise(old).alias("val"),
                         matched.alias("matched"))


def key_range(df: DataFrame, key: str, low, high) -> DataFrame:
    """Entries with key in [low, high)."""
    return df.where((F.col(key) >= low) & (F.col(key) < high))


def push_handled(pushes: DataFrame, update: Callable[[list[float]], float],
                 merge: Callable[[list[float]], float], bits: int = 14) -> DataFrame:
    """Merge pushed values with a user handler, in ``seq`` order.

    ``update`` handles a run of consecutive values of one key and ``merge``
    joins the results of neighbouring runs, so it must be associative but may
    depend on order. A run covers ``2**bits`` sequence numbers; runs are merged
    level by level, never a whole key at once.
    """
    def handler(fn):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            current, held = None, []
            for batch in batches:
                out = []
                for key, seq, val in zip(batch["key"], batch["run"], batch["val"]):
                    if (key, seq) != current:
                        if current is not None:
                            out.append((*current, fn(held)))
                        current, held = (key, seq), []
                    held.append(val)
                yield pd.DataFrame(out, columns=["key", "seq", "val"])
            if current is not None:
                yield pd.DataFrame([(*current, fn(held))], columns=["key", "seq", "val"])
        return run

    def level(df: DataFrame, fn) -> DataFrame:
        runs = df.withColumn("run", F.shiftright("seq", bits))
        return runs.repartition("key", "run").sortWithinPartitions("key", "run", "seq").select(
            "key", "run", "val").mapInPandas(handler(fn), "key long, seq long, val double")

    top = pushes.agg(F.max("seq")).first()[0] or 0
    out = level(pushes.select("key", "seq", F.col("val").cast("double").alias("val")), update)
    top >>= bits
    while top > 0:
        out = level(out, merge)
        top >>= bits
    return out.select("key", "val")


def assign_all(df: DataFrame, current: str, incoming: str, ops) -> DataFrame:
    """One column per assignment operator."""
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for c in (current, incoming))
    return fold(lambda d, op: d.withColumn(
        op.lower(), assign(op, F.col(current), F.col(incoming), whole)), ops, df)
