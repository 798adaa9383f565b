"""Repeated passages beside brute force."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import __spark_entry__ as entry
from millrace.llm import substrings

from .conftest import SF


def brute(docs, window):
    """[(id, n words, n removed, kept)]"""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    seen, out = set(), []
    for doc, text in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            run = tuple(words[s:s + window])
            if run in seen:
                gone[s:s + window] = [True] * window
            seen.add(run)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((repr(doc), len(words), sum(gone), kept))
    return sorted(out)


def found(df):
    return sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


def test_op7_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted((i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in brute(docs, 20))
    name = next(n for n in entry.queries() if n.startswith("op7_"))
    got = sorted((repr(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"])
                 for r in entry.queries()[name](spark, SF).collect())
    assert got == want and sum(m for _, _, m, _ in want) > 0


@pytest.mark.parametrize("leaves", [3, 1_000_000])
@pytest.mark.parametrize("bucket_bytes", [60_000, 2_000_000])
def test_many_buckets_and_prefixes(spark, bucket_bytes, leaves):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = found(substrings.remove_repeats(docs, bucket_bytes=bucket_bytes, leaves=leaves))
    assert got == brute([tuple(r) for r in docs.collect()], 20)


def test_few_words_and_short_windows(spark):
    rng = np.random.default_rng(1)
    docs = [(int(i), " ".join(rng.choice(["a", "b", "c"], int(rng.integers(0, 60))))) for i in rng.permutation(120)]
    docs += [(7, "a b c a b c a b c")] * 3 + [(7, f"a b {i} c") for i in range(40)] + [(None, "a b c a b c")] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for window in (3, 4, 7):
        want = brute(docs, window)
        got = found(substrings.remove_repeats(df.where("doc_id <> 7"), window, bucket_bytes=300, leaves=10))
        assert got == brute([d for d in docs if d[0] not in (7, None)], window)
        got = substrings.remove_repeats(df, window, bucket_bytes=10 ** 6)
        assert sorted(r["n_removed"] for r in got.collect()) == sorted(m for _, _, m, _ in want)


def test_spans(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (2, "x " + text + " y z"), (3, text[:-4])], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in substrings.remove_repeats(df).collect()}
    assert rows[1]["spans"] == [] and rows[2]["spans"] == [[1, 51]] and rows[2]["kept"] == "x y z"
    assert rows[3]["kept"] == "" and rows[3]["n_removed"] == rows[3]["n_words"]


def test_odd_rows(odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(substrings.remove_repeats(odd)) == brute(docs, 20)
    assert substrings.remove_repeats(empty).collect() == []


def test_windows_that_agree_in_half_of_a_fingerprint(spark):
    head = [f"h{i}" for i in range(19)]
    memo = substrings.Memo(lambda w: xxhash.xxh64_intdigest(w))
    lasts = [f"v{i}" for i in range(300_000)]
    run = np.zeros(1, np.uint64)
    for w in head[10:]:
        run = run * substrings._ODD + np.uint64(memo[w.encode()])
    code = np.array([xxhash.xxh64_intdigest(w.encode()) for w in lasts], np.uint64)
    low = substrings._mix(run * substrings._ODD + code).astype("<u4")
    order = np.argsort(low, kind="stable")
    same = np.flatnonzero(low[order[1:]] == low[order[:-1]])
    assert len(same)
    docs = []
    for k in same.tolist():
        docs += [(len(docs) + j, " ".join([*head, lasts[order[k + j]]])) for j in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(substrings.remove_repeats(df, bucket_bytes=60)) == brute(docs, 20)


def test_a_hot_anchor_is_split(spark):
    """Windows that share one frequent run and differ around it are told apart by further bits, so no group takes them all."""
    rng = np.random.default_rng(6)
    run = [f"r{i}" for i in range(10)]
    docs = [(i, " ".join([*(f"a{k}" for k in rng.integers(0, 10 ** 9, 12)), *run, *(f"b{k}" for k in rng.integers(0, 10 ** 9, 12))]))
            for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(substrings.remove_repeats(df, bucket_bytes=6000, leaves=50)) == brute(docs, 20)
    table = pa.table({"part": [0] * 30, "bucket": list(range(30)), "anchors": [np.array([7], "<u8").tobytes()] * 30,
                      "suffixes": [np.array([100], "<u2").tobytes()] * 30})
    told = substrings._prefix_rows(50)(table)
    assert {int(np.frombuffer(m, "u1")[0]) for m in told.column("more").to_pylist()} == {6}
