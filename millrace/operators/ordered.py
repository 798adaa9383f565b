"""Running values in log order that stay parallel when one key is hot.

A plain window puts a whole key into one task. Here the order column is a
unique integer (a log index, an id), so its high bits cut every key into
buckets that hold a bounded number of rows whatever the key's size:

1. per (key, bucket), a window over at most ``2**bits`` rows;
2. bucket totals, aggregated before they are shuffled;
3. the same scan over the totals, which is ``2**bits`` times smaller;
4. each bucket's offset put in front of its rows, where the window of step 1
   takes it up.

Step 3 repeats until the order fits one bucket, so small inputs get the plain
window and no input gets an unbounded group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BITS = 20
ROW_BITS = 16


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is sum, count, max, min or last (non-null).

    ``exclusive`` leaves the current row out; the first row of a key is then
    null (0 for sum and count).
    """

    kind: str
    column: str | None = None
    exclusive: bool = False


def _window_value(kind: str, column: Column, window) -> Column:
    if kind == "last":
        return F.last(column, ignorenulls=True).over(window)
    fn = {"sum": F.sum, "max": F.max, "min": F.min}[kind]
    return fn(column).over(window)


def _total(kind: str, column: str, pos: str) -> Column:
    if kind == "last":
        seen = F.col(column).isNotNull()
        return F.max_by(F.col(column), F.when(seen, F.col(pos)))
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](column)


def _scan(df: DataFrame, keys: list[str], pos: str, specs: dict, bits: int, top: int,
          next_bits: int) -> DataFrame:
    """Add ``specs`` (name -> (kind, input column, exclusive)) along ``pos`` in [0, top]."""

    def frame(window, exclusive):
        return window.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)

    if top >> bits == 0:
        window = Window.partitionBy(*keys).orderBy(pos)
        return df.select("*", *[
            _window_value(kind, F.col(col), frame(window, excl)).alias(name)
            for name, (kind, col, excl) in specs.items()
        ])

    bucket = f"{pos}_b"
    df = df.withColumn(bucket, F.shiftright(F.col(pos), bits))
    totals = df.groupBy(*keys, bucket).agg(
        *[_total(kind, col, pos).alias(f"{name}_t") for name, (kind, col, _) in specs.items()]
    )
    offsets = _scan(
        totals, keys, bucket,
        {f"{name}_o": (kind, f"{name}_t", True) for name, (kind, _, _) in specs.items()},
        next_bits, top >> bits, next_bits,
    )
    # a bucket's offset is a row before its first; the rows are shuffled once and not joined
    seeds = offsets.select(*keys, bucket, F.lit(-1).cast("long").alias(pos), *[
        F.col(f"{name}_o").alias(col) for name, (_, col, _) in specs.items()])
    window = Window.partitionBy(*keys, bucket).orderBy(pos)
    return df.unionByName(seeds, allowMissingColumns=True).select("*", *[
        _window_value(kind, F.col(col), frame(window, excl)).alias(name)
        for name, (kind, col, excl) in specs.items()
    ]).where(F.col(pos) >= 0).drop(bucket)


def order_span(df: DataFrame, order: str) -> tuple[int, int]:
    """Lowest and highest value of an integer order column (one narrow scan)."""
    row = df.agg(F.min(order), F.max(order)).first()
    return (0, 0) if row[0] is None else (int(row[0]), int(row[1]))


def running(df: DataFrame, keys: list[str], order: str, values: dict[str, Running],
            span: tuple[int, int] | None = None, bits: int | None = None) -> DataFrame:
    """Add running values per key in ``order``, a unique integer per row of a key.

    ``span`` is the (lowest, highest) order value where the caller knows it;
    else one narrow scan finds it.
    """
    low, high = span or order_span(df, order)
    row_bits = bits or (KEY_BITS if keys else ROW_BITS)
    next_bits = bits or KEY_BITS
    pos = "scan_pos"
    df = df.withColumn(pos, F.col(order).cast("long") - F.lit(low).cast("long"))
    specs = {}
    for name, v in values.items():
        source = f"{name}_in"
        if v.kind == "count":
            one = F.lit(1) if v.column is None else F.col(v.column).isNotNull().cast("long")
            df = df.withColumn(source, one.cast("long"))
            specs[name] = ("sum", source, v.exclusive)
        else:
            df = df.withColumn(source, F.col(v.column))
            specs[name] = (v.kind, source, v.exclusive)
    out = _scan(df, keys, pos, specs, row_bits, high - low, next_bits)
    zero = {n for n, v in values.items() if v.kind in ("count", "sum") and v.exclusive}
    drop = {pos, *[f"{n}_in" for n in values]}
    return out.select(*[
        F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero else F.col(c)
        for c in out.columns if c not in drop
    ])


def with_rank(df: DataFrame, order: str, name: str = "rank", keys: list[str] | None = None,
              span: tuple[int, int] | None = None) -> DataFrame:
    """One-based position along ``order``, over the whole table or per key."""
    return running(df, keys or [], order, {name: Running("count")}, span)
