"""Gradient rounds, the online sparse learner and logistic training."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import dot_constant
from ..session import bucketed, cut_lineage, remove_scratch, scratch_path
from .kv import push_vectors
from .ordered import Running, order_span, running

# positions of a key that are folded together, as a power of two
BLOCK_BITS = 3


@dataclass(frozen=True)
class Ftrl:
    """Learner settings; the defaults are fixed values.

    ``variant`` "reference" updates with the accumulated gradient,
    "published" with the new one.
    """

    alpha: float = 0.1
    beta: float = 1.0
    lambda1: float = 0.01
    lambda2: float = 0.0005
    variant: str = "reference"

    def step(self, z: np.ndarray, n: np.ndarray, w: np.ndarray, g: np.ndarray):
        """One update of weights with their gradients, all of one length."""
        base = z if self.variant == "reference" else g
        z1 = z + g - w * (np.sqrt(n + base * base) - np.sqrt(n)) / self.alpha
        n1 = n + (z1 * z1 if self.variant == "reference" else g * g)
        rate = (self.beta + np.sqrt(n1)) / self.alpha + self.lambda2
        w1 = (np.where(z1 > 0, self.lambda1, -self.lambda1) - z1) / rate
        return z1, n1, np.where(np.abs(z1) < self.lambda1, 0.0, w1)


def gradient_rounds(pushes: DataFrame, workers: int, how: str = "mean",
                    length: int | None = None) -> DataFrame:
    """One gradient per (key, round, idx); a round counts once all workers have pushed."""
    sums = push_vectors(pushes, ["key", "round"], "vec", length, how)
    return sums.where(F.col("pushes") == workers).select("key", "round", "idx", "val")


def round_sums(pushes: DataFrame, init: DataFrame, workers: int,
               length: int | None = None) -> DataFrame:
    """Synchronous sums: the stored vector after every complete round."""
    return _accumulate(gradient_rounds(pushes, workers, "sum", length), init, "round", 1.0,
                       order_span(pushes, "round"))


def async_sums(pushes: DataFrame, init: DataFrame) -> DataFrame:
    """Asynchronous sums: the stored vector after every push, in ``seq`` order."""
    return _accumulate(unfold(pushes, "seq"), init, "seq", 1.0, order_span(pushes, "seq"))


def sgd_sync(pushes: DataFrame, init: DataFrame, workers: int, eta: float,
             length: int | None = None) -> DataFrame:
    """Weights after every round of ``w -= eta * sum of gradients``."""
    return _accumulate(gradient_rounds(pushes, workers, "sum", length), init, "round", -eta,
                       order_span(pushes, "round"))


def sgd_async(pushes: DataFrame, init: DataFrame, eta: float) -> DataFrame:
    """Weights after every push."""
    return _accumulate(unfold(pushes, "seq"), init, "seq", -eta, order_span(pushes, "seq"))


def unfold(pushes: DataFrame, order: str) -> DataFrame:
    """(key, order, idx, val) of pushed vectors."""
    return pushes.select("key", order, F.posexplode("vec").alias("idx", "v")).select(
        "key", order, "idx", F.col("v").cast("double").alias("val"))


def _accumulate(steps: DataFrame, init: DataFrame, order: str, scale: float,
                span: tuple[int, int]) -> DataFrame:
    """init + scale * running sum; a plain sum is associative, so no fold is needed."""
    total = running(steps, ["key", "idx"], order, {"total": Running("sum", "val")}, span)
    start = init.select(F.col("key").alias("k_i"), F.col("idx").alias("i_i"), F.col("w").alias("w_i"))
    joined = total.join(start, (F.col("key") == F.col("k_i")) & (F.col("idx") == F.col("i_i")), "left")
    absent = F.raise_error(F.concat(F.lit("no starting weight for key "), F.col("key").cast("string")))
    w = F.when(F.col("w_i").isNull(), absent.cast("double")).otherwise(F.col("w_i"))
    return joined.select("key", order, "idx", (w + scale * F.col("total")).alias("w"))


def ftrl_fold(steps: DataFrame, init: DataFrame, order: str, settings: Ftrl = Ftrl(),
              block_bits: int = BLOCK_BITS) -> DataFrame:
    """Learner state (key, idx, z, n, w) after all gradients in ``order``.

    The update is not associative, so a weight is a chain. Blocks of ``2**block_bits`` positions
    of a key run in parallel; a block's gradients are sorted by order and read as a
    stream that carries the state, so memory is a block whatever the length of the chain. ``init``
    (key, idx, w) starts the weights; a gradient without a start fails the query.
    """
    start = init.select("key", "idx", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("o"),
                        F.col("w").cast("double").alias("val"))
    moves = steps.select("key", "idx", F.lit(1).alias("kind"), F.col(order).cast("long").alias("o"),
                         F.col("val").cast("double").alias("val"))
    both = start.unionByName(moves).withColumn("block", F.shiftright("idx", block_bits))
    # a number of partitions, which adaptive execution does not coalesce into one task
    parts = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chains = both.repartition(parts, "key", "block").sortWithinPartitions("key", "block", "kind", "o", "idx")
    key = init.schema["key"].dataType.simpleString()
    return chains.mapInArrow(_fold_chains(settings), f"key {key}, idx int, z double, n double, w double")


def _fold_chains(settings: Ftrl):
    """Chains of sorted rows, handled in runs of one chain, kind and order value, over the ends of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, at, state, held, key_type = None, None, {}, None, None

        def update() -> None:
            """Apply the gradients of one order value, which are held until it is complete."""
            nonlocal held
            if held is None:
                return
            _, idx, val = held
            held = None
            # Several gradients of one weight at one order value follow each other.
            turn = np.arange(len(idx)) - np.searchsorted(idx, idx)
            for k in range(int(turn.max()) + 1):
                who, g = idx[turn == k], val[turn == k]
                place = np.searchsorted(at, who) if at is not None else who
                if at is None or (place >= len(at)).any() or (at[place] != who).any():
                    raise ValueError(f"no starting weight for key {chain[0]}")
                for c, v in zip("znw", settings.step(*(state[c][place] for c in "znw"), g)):
                    state[c][place] = v

        def result() -> pa.RecordBatch:
            update()
            n = 0 if at is None else len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([chain[0]] * n, key_type), pa.array(at if n else [], pa.int32()),
                 *(pa.array(state[c] if n else [], pa.float64()) for c in "znw")], ["key", "idx", "z", "n", "w"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key_type = batch.schema.field("key").type
            keys = batch.column("key")
            code = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            block, kind, order, idx, val = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "kind", "o", "idx", "val"))
            cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0) | (np.diff(kind) != 0) | (np.diff(order) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(code)]):
                if (keys[a].as_py(), block[a]) != chain:
                    if chain is not None:
                        yield result()
                    chain, at, state = (keys[a].as_py(), block[a]), None, {}
                if kind[a] == 0:
                    at = idx[a:b].copy() if at is None else np.append(at, idx[a:b])
                    zero = np.zeros(b - a)
                    state = {c: np.append(state.get(c, []), v) for c, v in (("z", zero), ("n", zero), ("w", val[a:b]))}
                    continue
                if held is not None and held[0] == order[a]:  # the run went on in this batch
                    held = (order[a], np.append(held[1], idx[a:b]), np.append(held[2], val[a:b]))
                else:
                    update()
                    held = (order[a], idx[a:b], val[a:b])
        if chain is not None:
            yield result()

    return run


# --- logistic training ----------------------------------------------------

def predict(rows: DataFrame, features: str, weights: list[float]) -> DataFrame:
    """Class 1 where the dot product is not negative."""
    return rows.withColumn(
        "predicted", (dot_constant(weights, F.col(features)) >= 0).cast("int"))


def predict_table(rows: DataFrame, row_id: str, features: str, weights: DataFrame) -> DataFrame:
    """As ``predict`` for a model of any width kept as (idx, w)."""
    cells = rows.select(row_id, F.posexplode(features).alias("idx", "x"))
    scores = cells.join(weights, "idx").groupBy(row_id).agg(
        F.sum(F.col("x").cast("double") * F.col("w")).alias("score"))
    return rows.join(scores, row_id).withColumn("predicted", (F.col("score") >= 0).cast("int"))


def train(rows: DataFrame, features: str, label: str, worker: Column, workers: int,
          length: int, epochs: int, settings: Ftrl = Ftrl()) -> DataFrame:
    """Synchronous logistic regression: (idx, z, n, w) after ``epochs`` rounds.

    In a round every worker pulls the weights, sums the gradient over its share and pushes; the
    update takes the sum of all pushes over ``workers``. Rows stay where they are; the weights, ``length``
    numbers, go out as a broadcast in each round, and each task sends one sum per worker back.
    A vector of another length fails the query.
    """
    spark = rows.sparkSession
    z = n = w = np.zeros(length)
    examples = rows.select(worker.cast("long").alias("worker"), F.col(label).cast("double").alias("y"),
                           F.col(features).cast("array<double>").alias("x"))
    for _ in range(epochs):
        sent = spark.sparkContext.broadcast(w)
        pushes = examples.mapInArrow(_task_gradients(sent), "worker long, vec array<double>")
        total = push_vectors(pushes, ["worker"], "vec", length).groupBy("idx").agg(F.sum("val").alias("g"))
        g = np.zeros(length)
        for r in total.collect():  # one number per weight
            g[r["idx"]] = r["g"] / workers
        z, n, w = settings.step(z, n, w, g)
    return spark.createDataFrame([(i, float(z[i]), float(n[i]), float(w[i])) for i in range(length)],
                                 "idx int, z double, n double, w double")


# --- the model dealt by key ------------------------------------------------

def _stepped(settings: Ftrl, g: Column) -> list[Column]:
    """The update of :meth:`Ftrl.step` as columns, from z, n, w and the gradient."""
    z, n, w = F.col("z"), F.col("n"), F.col("w")
    base = z if settings.variant == "reference" else g
    z1 = z + g - w * (F.sqrt(n + base * base) - F.sqrt(n)) / F.lit(settings.alpha)
    n1 = n + (z1 * z1 if settings.variant == "reference" else g * g)
    rate = (F.lit(settings.beta) + F.sqrt(n1)) / F.lit(settings.alpha) + F.lit(settings.lambda2)
    w1 = (F.when(z1 > 0, settings.lambda1).otherwise(-settings.lambda1) - z1) / rate
    return [z1.alias("z"), n1.alias("n"), F.when(F.abs(z1) < settings.lambda1, 0.0).otherwise(w1).alias("w")]


# A key in more than one of so many rows is hot.
HOT_SHARE = 256


def pulled_margins(by_key: DataFrame, hot_by_row: DataFrame, weights: DataFrame, hot: DataFrame) -> DataFrame:
    """(row, margin): each cell pulls its weight where it lies; a row's products are added up, and only they move.

    The weights of the ``hot`` keys, at most ``HOT_SHARE`` times as many as a row has cells, go to the rows instead.
    """
    product = (F.col("x") * F.col("w")).alias("p")
    cold = by_key.join(weights.select("idx", "w").hint("merge"), "idx").select("row", product)
    few = weights.select("idx", "w").join(F.broadcast(hot), "idx")
    return cold.union(hot_by_row.join(F.broadcast(few), "idx").select("row", product)).groupBy("row").agg(F.sum("p").alias("margin"))


def pushed_update(gradients: DataFrame, weights: DataFrame, settings: Ftrl) -> DataFrame:
    """The weights after a push of (idx, g): keys that nobody touched stay as they are."""
    joined = weights.hint("merge").join(gradients, "idx", "left")
    new = joined.select("idx", "z", "n", "w", "g", F.struct(*_stepped(settings, F.col("g"))).alias("new"))
    return new.select("idx", *[F.when(F.col("g").isNull(), F.col(c)).otherwise(F.col(f"new.{c}")).alias(c) for c in ("z", "n", "w")])


def train_sparse(cells: DataFrame, labels: DataFrame, workers: int, epochs: int, settings: Ftrl = Ftrl()) -> DataFrame:
    """Logistic regression over sparse rows, of a model no single machine has to hold: (idx, z, n, w) after ``epochs`` rounds.

    ``cells`` is (row, idx, x), a row's different features; ``labels`` is (row, y). The weights lie in sorted buckets by key, and the cells do
    so twice, by key and, for hot keys alone to pull, by row. In a round the cells pull the weights of their bucket, margins move to their rows, and
    the sums of the gradient of the keys that were touched move to the weights; the weights never move, and the driver sees none of them.
    Keys are those that occur. The sum of gradients is divided by ``workers``.
    """
    counts = cut_lineage(cells.groupBy("idx").agg(F.count(F.lit(1)).alias("n")), "keys")
    rows = labels.count()
    hot = counts.where(F.col("n") * HOT_SHARE > rows).select("idx")
    by_key = bucketed(cells.select("idx", "row", "x").join(F.broadcast(hot), "idx", "left_anti").repartition("idx"), "cells_by_key", ["idx"])
    by_row = bucketed(cells.join(labels, "row").select("row", "idx", "x", F.col("y").cast("double").alias("y")), "cells_by_row", ["row"])
    hot_by_row = by_row.select("row", "idx", "x").join(F.broadcast(hot), "idx", "left_semi")
    zero = F.lit(0.0)
    path = scratch_path(cells.sparkSession, "weights")
    weights = bucketed(counts.select("idx", zero.alias("z"), zero.alias("n"), zero.alias("w")), "weights", ["idx"], path=path)
    for _ in range(epochs):
        margins = pulled_margins(by_key, hot_by_row, weights, hot)
        error = 1 / (1 + F.exp(-F.col("margin"))) - F.col("y")
        pushes = by_row.hint("merge").join(margins, "row").groupBy("idx").agg((F.sum(error * F.col("x")) / workers).alias("g"))
        old, path = path, scratch_path(cells.sparkSession, "weights")
        weights = bucketed(pushed_update(pushes, weights, settings), "weights", ["idx"], path=path)
        remove_scratch(cells.sparkSession, old)
    return weights


def _task_gradients(sent):
    """Gradient of the log loss at the weights that were sent: one vector per worker and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(
                batch.num_rows, len(weights))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            who = batch.column("worker").to_numpy(zero_copy_only=False)
            error = 1.0 / (1.0 + np.exp(-(x @ weights))) - y
            for i in np.unique(who).tolist():
                sums[i] = sums.get(i, 0.0) + error[who == i] @ x[who == i]
        yield pa.RecordBatch.from_pydict({"worker": pa.array(list(sums), pa.int64()),
                                          "vec": pa.array(list(sums.values()), pa.list_(pa.float64()))})

    return run
