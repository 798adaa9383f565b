"""Centroid clustering beside a plain version in Python integers."""

import hashlib
import math

import pytest

from millrace.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster int, distance string, grp long"


def brute(rows, dims, k, rounds):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), q) for i, q in kept)
    means = [q for _, q in order[:k]]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda q: min(range(len(means)), key=lambda c: (apart(q, means[c]), c))
    for _ in range(rounds):
        labels = [nearest(q) for _, q in kept]
        for c in range(len(means)):
            own = [q for (_, q), label in zip(kept, labels) if label == c]
            if own:
                means[c] = [sum(col) // len(own) for col in zip(*own)]
    out = [(repr(i), nearest(q), apart(q, means[nearest(q)])) for i, q in kept]
    told = [(i, c, d, sum(e for _, o, e in out if o == c), sum(e for *_, e in out),
             hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()) for i, c, d in out]
    return sorted(told)


def result(df):
    return sorted((repr(r["vec_id"]), *tuple(r)[1:]) for r in df.collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", None) for i, v in rows], SCHEMA).repartition(3)


def odd_rows(dims, n=60):
    """Clouds with a third of all rows equal, ties, and vectors that are not kept."""
    rows = [(i, [math.sin(i * 7.3 + d) * (1 + i % 5) for d in range(dims)]) for i in range(n)]
    rows += [(1000 + i, [0.5] * dims) for i in range(n // 2)] + [(5, [0.5] * dims), (5, [0.25] * dims), (None, [0.125] * dims)]
    bad = [None, [], [1.0] * (dims - 1), [1.0] * (dims + 1), [float("nan")] + [1.0] * (dims - 1),
           [float("inf")] + [1.0] * (dims - 1), [None] + [1.0] * (dims - 1)]
    return rows + [(2000 + i, v) for i, v in enumerate(bad)]


@pytest.mark.parametrize("dims, columns, group, k", [(8, 3, 7, 4), (16, 16, 4096, 3), (5, 1, 2, 200)])
def test_like_brute_force(spark, dims, columns, group, k):
    rows = odd_rows(dims)
    got = centroids.cluster(vectors(spark, rows), dims=dims, k=k, rounds=4, columns=columns, group=group)
    assert result(got) == brute(rows, dims, k, 4)


def test_wide_distances_stay_exact(spark):
    rows = [(i, [(-1) ** i * 120000.0 + i / 1024, 3.0, -65000.0 * (i % 3)]) for i in range(12)]
    assert result(centroids.cluster(vectors(spark, rows), dims=3, k=3, rounds=3, columns=2)) == brute(rows, 3, 3, 3)


def test_components_beyond_the_limit_are_an_error(spark):
    with pytest.raises(Exception, match="beyond 131072"):
        centroids.cluster(vectors(spark, [(1, [131072.0, 0.0])]), dims=2, k=1).collect()


def test_empty_tables(spark):
    assert centroids.cluster(vectors(spark, []), dims=2).collect() == []
    assert centroids.cluster(vectors(spark, [(1, None), (2, [1.0])]), dims=2).collect() == []


def test_labels_meet_the_cells_without_moving_them(spark, monkeypatch):
    plans, made = [], centroids.labelled

    def seen(*args):
        joined = made(*args)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(centroids, "labelled", seen)
    centroids.cluster(vectors(spark, odd_rows(4)), dims=4, k=2, rounds=1, columns=2).collect()
    cells = plans[0].split("SortMergeJoin")[1].split("Exchange")[0]
    assert "Bucketed: true" in cells
