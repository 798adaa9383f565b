"""Exact duplicates and sharding beside brute force."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, sharding
from millrace.llm.common import LOWER, UPPER


def plain(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("fan_bits", [1, 3])
def test_exact_duplicates(odd, keep, fan_bits):
    groups = collections.defaultdict(list)
    for r in odd.collect():
        groups[plain(r["text"])].append(r["doc_id"])
    rank = lambda i: (i is not None, i or 0)
    want = []
    for text, ids in groups.items():
        best = (max if keep == "max" else min)(ids, key=rank)
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(repr(i), repr(best), len(ids), sha) for i in ids]
    got = exact_dedup.exact_duplicates(odd, keep=keep, fan_bits=fan_bits).collect()
    assert sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in got) == sorted(want)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_partitions_exchange_sorted_runs(spark):
    """A round is one exchange by the number of the run, which a sort of that partition and a merge follow; a round more, one more."""
    digests = spark.range(100).selectExpr("id", "id AS row", "id % 7 AS digest", "1L AS n_bytes", "'s' AS sha", "id % 16 AS run")
    for bits, fan, rounds in ((4, 4, 1), (4, 2, 2), (3, 1, 3)):
        runs = exact_dedup.merge_runs(digests.withColumn("run", F.col("run") % (1 << bits)), bits, fan_bits=fan)
        plan = runs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange shufflepartitionidpassthrough") == rounds + 1 and plan.count("Exchange") == rounds + 1
        assert plan.count("Sort [run") >= rounds + 1
        got = sorted((r["digest"], r["best"]["id"], r["copies"]) for r in runs.collect())
        ids = [[i for i in range(100) if i % 7 == d] for d in range(7)]
        assert got == [(d, max(i), len(i)) for d, i in enumerate(ids)]


def test_internal_names_of_other_columns(spark):
    docs = spark.range(6).selectExpr("id AS doc_id", "concat('T', id % 2) AS text", "id + 100 AS __row", "1 AS __slot", "2 AS run", "3 AS best")
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["__row"] for r in kept.collect()) == [104, 105]
    assert sharding.shard_rows(docs, "doc_id", ["a", "b"], 11).count() == 6


def test_runs_merge_at_every_level(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('T', id % 37) AS text").repartition(37)
    got = exact_dedup.exact_duplicates(docs).where("kept").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3963, 4000))
    assert sum(r["group_size"] for r in got) == 4000


def test_drop_duplicates_keeps_columns(spark, odd, empty, tmp_path):
    odd.write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    out = exact_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len({plain(r["text"]) for r in docs.collect()})
    assert exact_dedup.drop_duplicates(empty).collect() == []
    assert exact_dedup.exact_duplicates(empty).collect() == []


def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(13)]
    table = sharding.fill_table(names, 1009)
    sizes = collections.Counter(table)
    assert set(table) == set(range(13)) and max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.fill_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 12)
    assert moved < 0.2 * 1009


def test_each_turn_claims_the_first_free_choice():
    names, slots = ["a", "b", "c"], 7
    orders = [[(sharding._number(f"start:{n}") + j * (sharding._number(f"step:{n}") % 6 + 1)) % 7 for j in range(7)]
              for n in names]
    assert all(sorted(o) == list(range(7)) for o in orders)
    table = [None] * slots
    for turn in range(slots):
        table[next(s for s in orders[turn % 3] if table[s] is None)] = turn % 3
    assert sharding.fill_table(names, slots) == table


def test_shard_rows(odd, empty):
    names = ["a", "b", "c", "d"]
    out = sharding.shard_rows(odd.withColumnRenamed("source", "shard"), "doc_id", names, 101, without=["d"])
    rows = out.collect()
    assert len(rows) == odd.count() and out.columns.count("shard") == 1
    assert all(0 <= r["slot"] < 101 and r["shard"] in names and r["shard_after"] in names[:3] for r in rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert sharding.shard_rows(empty, "doc_id", names).collect() == []
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 100)
