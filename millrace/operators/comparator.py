"""Sort by a user's comparison of two rows, for orders that no expression states: a sample sort.

Splitters are taken from a bounded sample. Each Arrow batch is sorted by the comparison and its rows dealt to parts by
binary search among the splitters; a part is one partition, in which the sorted runs are merged k ways. Rows equal to several
splitters may go to any part between them, so a value that holds many parts' worth of rows is spread over them.
"""

from __future__ import annotations

import bisect
import functools
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

# Sampled keys per part; they decide how even the parts are, not the result.
SAMPLED = 64

Compare = Callable[[tuple, tuple], int]


def splitters(df: DataFrame, columns: list[str], compare: Compare, parts: int, seed: int = 11) -> list[tuple]:
    """``parts`` - 1 keys in order that cut a sample into even parts; repeated where a key fills several."""
    most = SAMPLED * parts
    total = df.count()
    share = min(1.0, 1.2 * most / max(total, 1))
    keys = [tuple(r) for r in df.select(*columns).sample(share, seed).limit(2 * most).collect()]
    keys.sort(key=functools.cmp_to_key(compare))
    return [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name = "_" + name
    return name


def _keys(batch: pa.RecordBatch | pa.Table, columns: list[str], order: Callable) -> tuple[list, np.ndarray]:
    """The different keys of a batch in order, and each row's place among them. Equal by comparison is one place."""
    rows = list(zip(*(batch.column(c).to_pylist() for c in columns)))
    known = sorted(dict.fromkeys(rows), key=order)
    ordered, place = [], {}
    for key in known:
        if not ordered or order(ordered[-1]) < order(key):
            ordered.append(key)
        place[key] = len(ordered) - 1
    return ordered, np.fromiter((place[r] for r in rows), np.int64, len(rows))


def _dealt(columns: list[str], compare: Compare, cuts: list[tuple], part: str, run: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = functools.cmp_to_key(compare)
        marks, number, turn = [order(c) for c in cuts], TaskContext.get().partitionId() << 32, TaskContext.get().partitionId()
        for batch in batches:
            keys, place = _keys(batch, columns, order)
            low = np.array([bisect.bisect_left(marks, order(k)) for k in keys], np.int64)
            high = np.array([bisect.bisect_right(marks, order(k)) for k in keys], np.int64)
            parts = low[place] + (turn + np.arange(len(place))) % (high - low + 1)[place]
            turn += len(place)
            rows = np.lexsort((place, parts))
            out = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(parts[rows].astype(np.int32)), pa.array(np.full(len(rows), number))],
                [*out.schema.names, part, run])
            number += 1

    return work


def _merged(columns: list[str], compare: Compare, kept: list[str], part: str, run: str, names: list[str]):
    """The rows of a partition in order, each with its place and the place of the first row equal to it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        order = functools.cmp_to_key(compare)
        table = pa.Table.from_batches(held)
        keys = [order(k) for k in zip(*(table.column(c).to_pylist() for c in columns))]
        number = table.column(run).to_numpy()
        by_run = np.argsort(number, kind="stable")
        runs = np.split(by_run, np.flatnonzero(np.diff(number[by_run])) + 1)
        rows = list(heapq.merge(*(r.tolist() for r in runs), key=keys.__getitem__))
        first, start = np.zeros(len(rows), np.int64), 0
        for i in range(1, len(rows)):
            if keys[rows[i - 1]] < keys[rows[i]]:
                start = i
            first[i] = start
        done = table.select([*kept, part]).take(pa.array(rows))
        done = done.append_column(names[0], pa.array(np.arange(len(rows)))).append_column(names[1], pa.array(first))
        yield from done.to_batches(max_chunksize=10_000)

    return work


def sort_by(df: DataFrame, columns: list[str], compare: Compare, parts: int | None = None) -> DataFrame:
    """``df`` with its place in the order of ``compare``: position long, from 0 and unique, and rank long, from 1, equal rows alike.

    ``compare`` takes the ``columns`` of two rows as tuples and returns a number below, at or above zero; nulls are given to it
    as None. It must be a weak order. ``parts`` is the number of partitions, the session's number of shuffle partitions
    if it is not given; a part is merged in memory. Rows of a position lie in partitions and files in order. The driver sees the sample
    and two rows per part. Equal rows take their positions in no particular order.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = splitters(df, columns, compare, parts)
    kept = [c for c in df.columns if c not in ("position", "rank")]
    part, run, place, first = (_free(n, df.columns) for n in ("__part", "__run", "__place", "__first"))
    schema = T.StructType([df.schema[c] for c in kept])
    names = [f for f in schema.fields]
    dealt = df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(
        _dealt(columns, compare, cuts, part, run),
        T.StructType([*names, T.StructField(part, T.IntegerType()), T.StructField(run, T.LongType())]))
    merged = cut_lineage(dealt.repartitionById(len(cuts) + 1, F.col(f"`{part}`")).mapInArrow(
        _merged(columns, compare, kept, part, run, [place, first]),
        T.StructType([*names, T.StructField(part, T.IntegerType()), T.StructField(place, T.LongType()), T.StructField(first, T.LongType())])), "sorted")

    # Equal rows at the end of a part and the start of the next share their rank.
    ends = merged.groupBy(F.col(f"`{part}`").alias("part")).agg(
        F.count("*").alias("n"), F.max(first).alias("last"), F.min_by(F.struct(*columns), place).alias("head"),
        F.max_by(F.struct(*columns), place).alias("tail")).collect()
    starts, start, rank, before = [], 0, 1, None
    for r in sorted(ends, key=lambda r: r["part"]):
        if before is None or compare(before, tuple(r["head"])) != 0:
            rank = start + 1
        starts.append((r["part"], start, rank))
        if r["last"]:
            rank = start + r["last"] + 1
        start, before = start + r["n"], tuple(r["tail"])
    told = spark.createDataFrame(starts, "part int, start long, rank long").toDF(part, "__start", "__rank")
    return merged.join(told, part).select(
        *[F.col(f"`{c}`") for c in kept], (F.col("__start") + F.col(place)).alias("position"),
        F.when(F.col(first) == 0, F.col("__rank")).otherwise(F.col("__start") + F.col(first) + 1).alias("rank"))
