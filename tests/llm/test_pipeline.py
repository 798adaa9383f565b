"""Each stage of the pipeline on its own input, and the whole."""

import collections

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import language, simhash
from millrace.llm.common import LOWER, UPPER

from .conftest import SF
from .test_substrings import brute


def plain(text):
    return (text or "").translate(str.maketrans(UPPER, LOWER))


def run_stages(spark, docs, folder, tmp_path):
    """[(input rows, output rows)] of each stage, with the input's DataFrame."""
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, docs, folder)
        df.write.parquet(str(tmp_path / str(i)))
        got = spark.read.parquet(str(tmp_path / str(i)))
        out.append((docs, docs.collect(), got.collect(), got.columns))
        docs = got
    return out


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = run_stages(spark, docs, SF, tmp_path)
    for i, (_, before, after, columns) in enumerate(steps[:4]):
        assert columns == docs.columns
        if i < 3:
            assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    first, before, after, _ = steps[0]
    model = {r["doc_id"]: r for r in language.identify(first).collect()}
    assert {r["doc_id"] for r in after} == {d for d, r in model.items() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert len(after) > 0.98 * len(before)

    _, before, after, _ = steps[1]
    groups = collections.defaultdict(list)
    for r in before:
        groups[plain(r["text"])].append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(max(g) for g in groups.values())

    _, before, after, _ = steps[2]
    rows = sorted(before, key=lambda r: r["doc_id"])
    prints = np.array([simhash.simhash(r["text"], 4) for r in rows])
    near = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2) <= 4
    least = np.arange(len(rows))
    while True:
        low = np.array([least[near[i]].min() for i in range(len(rows))])
        if (low == least).all():
            break
        least = low
    assert sorted(r["doc_id"] for r in after) == [rows[i]["doc_id"] for i in np.unique(least)]
    assert len(after) < len(before)

    _, before, after, _ = steps[3]
    want = {i: k for i, n, m, k in brute([(r["doc_id"], r["text"]) for r in before], 20) if m < n}
    assert {repr(r["doc_id"]): b" ".join(r["text"].encode().split()).decode() for r in after} == want
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        assert r["n_chars"] == len(r["text"]) or r["text"] == texts[r["doc_id"]]

    _, before, after, _ = steps[4]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_run_is_the_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    last = run_stages(spark, docs, SF, tmp_path)[-1][2]
    got = entry.queries()["pipeline"](spark, SF)
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(tuple(r)[:5] for r in last)


def test_odd_and_empty_tables(spark, odd, empty, tmp_path):
    odd.write.parquet(str(tmp_path / "odd"))
    steps = run_stages(spark, spark.read.parquet(str(tmp_path / "odd")), SF, tmp_path / "o")
    assert all(s[3] == odd.columns for s in steps[:4])
    assert len(steps[1][2]) == len({plain(r["text"]) for r in steps[1][1]})
    empty.write.parquet(str(tmp_path / "empty"))
    steps = run_stages(spark, spark.read.parquet(str(tmp_path / "empty")), SF, tmp_path / "e")
    assert all(s[2] == [] for s in steps)
