"""Centroid clustering by a dimension-sharded Lloyd iteration on integer vectors.

Vectors are cut into groups of rows and blocks of columns; one cell holds a block of a group. A cell's task computes exact
partial squared distances against its slice of the centroids. The parts of a group are added over the blocks and
give the nearest centroid; the labels go back to the cells, where each block sums its own columns and updates its
own slice. Cells are stored in buckets of (block, group), so labels meet them without moving a vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bucketed, cut_lineage, scratch_path

# Rows of a group and columns of a block.
GROUP, COLUMNS = 4096, 16
# The largest integer component: beyond, a squared distance of 64 columns may not fit a long.
LIMIT = 2**27


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64,
                    scale: int = 1024) -> DataFrame:
    """(id, q): the vectors of exactly ``dims`` finite components, each as floor(scale * component).

    A component whose integer is beyond 2**27 ends the query with an error, as distances would not fit a long.
    """
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = (F.size(vec_col) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    inside = F.forall(v, lambda x: F.abs(x * float(scale)) < float(LIMIT))
    q = F.when(inside, F.transform(v, lambda x: F.floor(x * float(scale)).cast("int"))).otherwise(
        F.raise_error(F.lit(f"a vector has a component beyond {LIMIT // scale}")))
    return vectors.where(fine).select(F.col(id_col).alias("id"), q.alias("q"))


def _cells(dims: int, columns: int, group: int):
    """Rows to cells: (block, grp, ids, data), the ids in block 0 only, data as little-endian 32-bit rows."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, group):
                part = batch.slice(first, group)
                rows = part.column("q").flatten().to_numpy().astype("<i4").reshape(-1, dims)
                ids, blocks = part.column("id").to_pylist(), range(-(-dims // columns))
                yield pa.RecordBatch.from_arrays([
                    pa.array(blocks, pa.int32()), pa.array([number] * len(blocks), pa.int64()),
                    pa.array([ids if b == 0 else None for b in blocks], pa.list_(pa.int64())),
                    pa.array([rows[:, b * columns:(b + 1) * columns].tobytes() for b in blocks], pa.binary())],
                    ["block", "grp", "ids", "data"])
                number += 1

    return work


def _rows(cell: bytes, width: int) -> np.ndarray:
    return np.frombuffer(cell, "<i4").reshape(-1, width).astype(np.int64)


def _partial_distances(centroids: np.ndarray, columns: int):
    """Per cell, the squared distances of its rows to each centroid's slice, in 32 bits where they fit."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, grp, cell in zip(*(batch.column(c).to_pylist() for c in ("block", "grp", "data"))):
                own = centroids[:, block * columns:(block + 1) * columns]
                rows = _rows(cell, own.shape[1])
                found = np.empty((len(rows), len(own)), np.int64)
                for k, c in enumerate(own):
                    found[:, k] = ((rows - c) ** 2).sum(1)
                wide = bool(len(found)) and int(found.max()) >= 2**31
                yield pa.RecordBatch.from_arrays([
                    pa.array([grp], pa.int64()), pa.array([wide], pa.bool_()),
                    pa.array([found.astype("<i8" if wide else "<i4").tobytes()], pa.binary())], ["grp", "wide", "part"])

    return work


def _nearest(k: int):
    """Add the parts of a group over its blocks; the nearest centroid of each row, ties to the smaller number."""
    def work(table: pa.Table) -> pa.Table:
        total = 0
        for wide, part in zip(table.column("wide").to_pylist(), table.column("part").to_pylist()):
            total = total + np.frombuffer(part, "<i8" if wide else "<i4").reshape(-1, k).astype(np.int64)
        labels = total.argmin(1)
        return pa.table({"grp": table.column("grp").slice(0, 1), "labels": pa.array([labels.astype("<i4").tobytes()], pa.binary()),
                         "distances": pa.array([total.min(1).astype("<i8").tobytes()], pa.binary())})

    return work


def _slice_sums(k: int, columns: int, dims: int):
    """Per task, the sums and counts of each block's own columns by cluster."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims), np.int64)
        counts = np.zeros((-(-dims // columns), k), np.int64)
        for batch in batches:
            for block, cell, labels in zip(*(batch.column(c).to_pylist() for c in ("block", "data", "labels"))):
                at = slice(block * columns, min(dims, (block + 1) * columns))
                rows, label = _rows(cell, at.stop - at.start), np.frombuffer(labels, "<i4")
                order = np.argsort(label, kind="stable")
                used, starts = np.unique(label[order], return_index=True)
                sums[used, at] += np.add.reduceat(rows[order], starts, axis=0)
                counts[block] += np.bincount(label, minlength=k)
        cluster, dim = np.nonzero(counts[np.arange(dims) // columns].T)
        yield pa.RecordBatch.from_arrays([
            pa.array(cluster, pa.int32()), pa.array(dim, pa.int32()), pa.array(sums[cluster, dim], pa.int64()),
            pa.array(counts[dim // columns, cluster], pa.int64())], ["cluster", "dim", "total", "n"])

    return work


def labels_of(cells: DataFrame, centroids: np.ndarray, columns: int = COLUMNS) -> DataFrame:
    """(grp, labels, distances): the nearest centroid of each vector of a group."""
    parts = cells.select("block", "grp", "data").mapInArrow(
        _partial_distances(centroids, columns), "grp long, wide boolean, part binary")
    return parts.groupBy("grp").applyInArrow(_nearest(len(centroids)), "grp long, labels binary, distances binary")


def labelled(cells: DataFrame, labels: DataFrame, blocks: int) -> DataFrame:
    """(block, grp, data, labels): each cell with the labels of its rows. Only the labels move."""
    told = labels.select("grp", "labels", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    return cells.select("block", "grp", "data").hint("merge").join(told, ["block", "grp"])


def updated(cells: DataFrame, labels: DataFrame, centroids: np.ndarray, columns: int = COLUMNS) -> np.ndarray:
    """The floor of each cluster's mean per component; an empty cluster's centroid stays."""
    k, dims = centroids.shape
    sums = labelled(cells, labels, -(-dims // columns)).mapInArrow(_slice_sums(k, columns, dims), "cluster int, dim int, total long, n long")
    exact = sums.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                               F.sum("n").cast("decimal(38,0)").alias("n"))
    out = centroids.copy()
    # As many rows as the centroids have components.
    for r in exact.select("cluster", "dim", F.expr("(total - pmod(total, n)) div n").alias("mean")).collect():
        out[r["cluster"], r["dim"]] = r["mean"]
    return out


def _assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, distances in zip(*(batch.column(c) for c in ("ids", "labels", "distances"))):
            yield pa.RecordBatch.from_arrays([
                ids.values, pa.array(np.frombuffer(labels.as_py(), "<i4")), pa.array(np.frombuffer(distances.as_py(), "<i8"))],
                ["vec_id", "cluster", "distance"])


def first_centroids(vectors: DataFrame, k: int, rank: Column) -> np.ndarray:
    """The ``k`` vectors of least ``rank``, in its order; ties by components. Fewer vectors give fewer centroids."""
    best = vectors.select(rank.alias("rank"), "q").orderBy("rank", "q").limit(k).collect()
    return np.array([r["q"] for r in best], np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 8,
            rounds: int = 10, scale: int = 1024, seed: int = 3, columns: int = COLUMNS, group: int = GROUP) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Vectors of exactly ``dims`` components, none null or non-finite, are kept and become integers, floor(scale * x).
    The first centroids are the ``k`` vectors of least SHA-256 of "seed:id". In each of ``rounds`` rounds all
    vectors go to the nearest centroid (squared distance; ties: the smaller number), and each centroid with vectors
    becomes the floor of their mean. All arithmetic is exact.

    Rows with equal ids are vectors of their own; a null id counts as empty text in the hash. Fewer than ``k``
    vectors give fewer clusters; no vector gives no rows. A component beyond 2**27 after scaling is an error. Ids are
    integers. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = integer_vectors(vectors, id_col, vec_col, dims, scale)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    centroids = first_centroids(rows, k, F.sha2(name, 256))
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    # Group numbers come from the reading task, so cells are written before they are used.
    made = rows.select(F.col("id").cast("long"), "q").mapInArrow(
        _cells(dims, columns, group), "block int, grp long, ids array<long>, data binary")
    cells = bucketed(made, "vector_cells", ["block", "grp"], path=scratch_path(spark, "cells"))
    for _ in range(rounds):
        centroids = updated(cells, labels_of(cells, centroids, columns), centroids, columns)
    ids = cells.where("block = 0").select("grp", "ids")
    found = cut_lineage(ids.join(labels_of(cells, centroids, columns), "grp").select("ids", "labels", "distances")
                        .mapInArrow(_assigned, "vec_id long, cluster int, distance long"), "assigned")
    # At most k rows.
    sums = {r["cluster"]: int(r["own"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()}
    told = spark.createDataFrame([(c, own, sum(sums.values()), ",".join(map(str, centroids[c].tolist()))) for c, own in sums.items()],
                                 "cluster int, cluster_inertia long, inertia long, parts string")
    told = told.withColumn("centroid_sha256", F.sha2("parts", 256))
    return found.join(F.broadcast(told), "cluster").select(*[c.split()[0] for c in schema.split(", ")])
