"""Running values against a plain loop, with few rows per bucket."""

import random

import pytest
from conftest import rows

from millrace.operators.ordered import Running, running, with_rank


def brute(data, pick):
    state, out = {}, []
    for key, pos, val in sorted(data, key=lambda r: r[1]):
        seen = state.setdefault(key, [])
        out.append((key, pos, pick(seen, val)))
        seen.append(val)
    return sorted(out, key=str)


KINDS = {
    "sum": lambda seen, v: sum(x for x in [*seen, v] if x is not None) if any(
        x is not None for x in [*seen, v]) else None,
    "max": lambda seen, v: max((x for x in [*seen, v] if x is not None), default=None),
    "min": lambda seen, v: min((x for x in [*seen, v] if x is not None), default=None),
    "last": lambda seen, v: next((x for x in reversed([*seen, v]) if x is not None), None),
    "count": lambda seen, v: sum(x is not None for x in [*seen, v]),
}


@pytest.mark.parametrize("kind", list(KINDS))
@pytest.mark.parametrize("bits", [1, 2, 4, 20])
def test_inclusive(spark, kind, bits):
    rnd = random.Random(bits)
    places = rnd.sample(range(1000, 5000), 120)
    data = [("hot" if i % 3 else rnd.choice(["a", None]), p, rnd.choice([None, rnd.randint(-9, 9)]))
            for i, p in enumerate(places)]
    df = spark.createDataFrame(data, "k string, p long, v long")
    got = running(df, ["k"], "p", {"r": Running(kind, "v")}, bits=bits).select("k", "p", "r")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(data, KINDS[kind])


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_exclusive(spark, bits):
    data = [("k", p, p % 5) for p in range(0, 90, 3)]
    df = spark.createDataFrame(data, "k string, p long, v long")
    got = running(df, ["k"], "p", {
        "m": Running("max", "v", exclusive=True), "c": Running("count", exclusive=True),
        "s": Running("sum", "v", exclusive=True)}, bits=bits)
    want, seen = [], []
    for k, p, v in data:
        want.append((k, p, v, max(seen, default=None), len(seen), sum(seen)))
        seen.append(v)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def test_rank_without_keys_uses_several_buckets(spark):
    df = spark.range(0, 400_000, 2).toDF("id")
    ranked = with_rank(df, "id")
    assert ranked.where("rank <> id / 2 + 1").count() == 0
    assert "scan_pos_b" in ranked._jdf.queryExecution().optimizedPlan().toString()


def test_known_span_needs_no_scan(spark):
    df = spark.createDataFrame([(5, 1), (9, 2)], "p long, v long")
    assert rows(running(df, [], "p", {"s": Running("sum", "v")}, span=(0, 10))) == [(5, 1, 1), (9, 2, 3)]
