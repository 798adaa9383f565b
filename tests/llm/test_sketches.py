"""Sketches beside exact shingle sets."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.llm import sketches
from millrace.llm.common import LOWER, UPPER, in_order_ranges

from .conftest import SF


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(docs):
    """[(row, edited text, next text)] for rows with distinct ids, by descending id."""
    order = sorted(docs, key=lambda d: -d[0])
    out = []
    for (i, text), (_, other) in zip(order, order[1:] + order[:1]):
        n = len(text) // 3
        out.append((i, text, text[:len(text) - n] + other[:n], other))
    return out


def check(rows, docs):
    rows = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    near = []
    for i, text, changed, other in edited(docs):
        r = rows[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        near.append(abs(r["near_edited"] - jaccard(shingles(text), shingles(changed))))
        near.append(abs(r["near_next"] - jaccard(shingles(text), shingles(other))))
        if len(shingles(text) | shingles(changed)) <= 128:
            assert near[-2] < 1e-9
    assert max(near) < 0.2 and sum(near) / len(near) < 0.03


def test_op3_query(spark):
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    name = next(n for n in entry.queries() if n.startswith("op3_"))
    rows = entry.queries()[name](spark, SF).collect()
    check(rows, docs)
    prints = {}
    for r in rows:
        assert prints.setdefault(dict(docs)[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    at = {r["doc_id"]: r for r in rows}
    off = []
    for i, text, changed, _ in edited(docs):
        mine, other = shingles(text), shingles(changed)
        if len(mine) < 128:
            assert at[i]["shingles"] == len(mine)
        off.append(abs(at[i]["held_in_edited"] - (len(mine & other) / len(mine) if mine else 1)))
    assert sum(off) / len(off) < 0.05


@pytest.mark.parametrize("size", [200, 5000])
def test_ranges(spark, size):
    random.seed(4)
    docs = [(random.randrange(10 ** 9) * 2 + i % 2, "é" * (i % 7) + " ".join(f"w{random.randrange(50)}" for _ in range(i % 40)))
            for i in range(150)]
    docs = list(dict(docs).items())
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = sketches.edited_texts(df, range_bytes=size).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
    check(rows.collect(), docs)


def test_every_row_has_one_next(spark, odd, empty):
    rows = sketches.edited_texts(odd, range_bytes=2000).collect()
    assert len(rows) == odd.count()
    assert all(r["edited"] is not None and r["next_sketch"] is not None for r in rows)
    assert sketches.edited_texts(empty).collect() == []
    assert sketches.sketches(empty).collect() == []
    sole = sketches.edited_texts(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert [r["edited"] for r in sole] == ["abcdab"]
    same = [(5, f"text number {i} of one id") for i in range(60)] + [(i, "x") for i in range(5)] + [(None, "n")] * 2
    hot = sketches.edited_texts(spark.createDataFrame(same, "doc_id long, text string"), range_bytes=100)
    assert hot.count() == len(same)


def test_estimates(spark):
    random.seed(2)
    a = [f"a{i}" for i in range(3000)]
    b = a[:1500] + [f"b{i}" for i in range(500)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a[:1600]), " ".join(a[1596:]))], "a string, b string, p string, q string")
    s = lambda c: sketches.sketch(sketches.shingle_hashes(F.col(c)))
    r = df.select(s("a").alias("a"), s("b").alias("b"), sketches.merge(s("p"), s("q")).alias("parts")).select(
        (F.col("a") == F.col("parts")).alias("same"), sketches.resemblance(F.col("a"), F.col("b")).alias("near"),
        sketches.containment(F.col("b"), F.col("a")).alias("inside"), sketches.distinct_shingles(F.col("a")).alias("n")).first()
    sa, sb = shingles(" ".join(a)), shingles(" ".join(b))
    assert r["same"]
    assert r["near"] == pytest.approx(jaccard(sa, sb), abs=0.13)
    assert r["inside"] == pytest.approx(len(sa & sb) / len(sb), abs=0.2)
    assert r["n"] == pytest.approx(len(sa), rel=0.3)


def test_sketches_of_odd_rows(odd):
    rows = sketches.sketches(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert len(r["fingerprint"]) == 8 * len(r["sketch"]) <= 8 * 128 and r["sketch"] == sorted(set(r["sketch"]))
    text = {repr(r["doc_id"]): r["text"] for r in odd.collect() if r["doc_id"] is not None}
    for r in rows:
        if repr(r["doc_id"]) in text and len(shingles(text[repr(r["doc_id"])])) < 128:
            assert r["shingles"] == len(shingles(text[repr(r["doc_id"])]))


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_ranges_follow_the_order_of_ids(spark, fan):
    """Null ids and one id with many rows are dealt over several ranges; no row is lost, whatever the depth of the tree."""
    random.seed(fan)
    ids = [random.choice([None, 7, random.randrange(-50, 50)]) for _ in range(3000)]
    rows = spark.createDataFrame([(i, random.randrange(-10 ** 18, 10 ** 18)) for i in ids], "id long, tie long").repartition(4)
    dealt, filled = in_order_ranges(rows, "id", "tie", 40, "range", fan)
    got = [tuple(r) for r in dealt.collect()]
    assert sorted(repr(r[:2]) for r in got) == sorted(repr(tuple(r)) for r in rows.collect())
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    ordered = sorted(got, key=key)
    assert [r[2] for r in ordered] == sorted(r[2] for r in ordered)
    assert {r[2] for r in got} == {r["range"] for r in filled.collect()}
    assert len({r[2] for r in got if r[0] is None}) > 5 and len({r[2] for r in got if r[0] == 7}) > 5


def test_the_plan_does_not_grow_with_the_ranges(spark):
    rows = spark.range(20_000).selectExpr("id", "hash(id) AS tie")
    plans = [len(in_order_ranges(rows, "id", "tie", n, "range")[0]._jdf.queryExecution().optimizedPlan().toString()) for n in (3000, 4000)]
    assert max(plans) < 60_000 and abs(plans[0] - plans[1]) < 5000
