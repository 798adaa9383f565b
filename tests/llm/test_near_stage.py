"""The near stage of the pipeline and distinct shingles."""

import numpy as np

import corpus_pipeline
from millrace.llm import simhash

SCHEMA = "doc_id long, text string, __row long"


def kept(spark, tmp_path, texts):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], SCHEMA)
    docs.write.parquet(str(tmp_path / "docs"))
    got = corpus_pipeline.near_stage(spark, spark.read.parquet(str(tmp_path / "docs")), "").collect()
    assert all(r["__row"] == 7 for r in got)
    return sorted(r["doc_id"] for r in got)


def prose(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_one_of_each_component_stays(spark, tmp_path):
    """Links of four bits and no more, over any number of steps."""
    rng = np.random.default_rng(5)
    words = prose("a", 400)
    texts = [" ".join(words)]
    for k in rng.integers(0, 400, 12).tolist():
        words[k] = f"v{k}"
        texts.append(" ".join(words))
    texts += [" ".join(prose(f"b{i}x", 60)) for i in range(6)] + [texts[0].upper(), "", "  "]
    prints = np.array([simhash.simhash(t) for t in texts])
    near = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2) <= 4
    least = np.arange(len(texts))
    for _ in texts:
        least = np.array([least[row].min() for row in near])
    want = np.unique(least).tolist()
    assert 7 < len(want) < len(texts)
    assert kept(spark, tmp_path, texts) == want


def test_distinct_counts_once_over_all_chunks(monkeypatch):
    text = " ".join(prose("a", 40) * 5)
    want = simhash.simhash(text, 1, 4, distinct=True)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert (simhash.simhash(text, 1, 4, distinct=True) == want).all()
    assert (want == simhash.simhash(" ".join(prose("a", 40)), 1, 4)).all()
    assert np.array_equal(simhash.shingle_set(text, 1), simhash.shingle_set(" ".join(prose("a", 40)), 1))
