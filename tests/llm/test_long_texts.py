"""Texts beyond a slice, a bucket and a chunk of each operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, language, line_dedup, packing, queries, simhash, sketches, spelling, substrings


@pytest.fixture(scope="module")
def docs(spark):
    """Two long texts that differ in a word, one long word, one long line and short ones."""
    long = " ".join(f"word{i % 99_991}" if i % 12 else "\n" for i in range(900_000))
    texts = [long, long + " more", "x" * 3_000_000, "short text", "Short Text", ""]
    assert len(long) > 7_000_000
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache(), texts


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_long_texts_are_deduplicated(docs):
    df, texts = docs
    found = by_id(exact_dedup.exact_duplicates(df))
    assert [i for i in found if not found[i]["kept"]] == [3]
    assert found[1]["text_sha256"] == hashlib.sha256(texts[1].encode()).hexdigest()
    near = by_id(simhash.near_duplicates(df))
    assert near[1]["component_id"] == 0 and near[0]["fingerprint"] == f"{int(simhash.simhash(texts[0])[0]):016x}"
    assert near[3]["component_id"] == near[4]["component_id"] == 3


def test_long_texts_lose_passages_and_lines(docs):
    df, texts = docs
    found = by_id(substrings.remove_repeats(df))
    assert found[1]["kept"].split()[-1] == "more" and found[1]["n_words"] == found[0]["n_words"] + 1
    assert found[1]["n_removed"] == found[0]["n_words"]
    lines = by_id(line_dedup.remove_lines(df, least_docs=2))
    assert lines[1]["n_dropped"] == 0 and lines[0]["n_lines"] == texts[0].count("\n") + 1
    assert lines[0]["n_dropped"] > 60_000 and lines[2]["kept"] == texts[2]


def test_long_texts_are_read_whole(docs):
    df, texts = docs
    spec = queries.vocabulary("word_bpe_49k.json")
    pieces = packing.pack_documents(df, spec).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("length").alias("most")).collect()
    totals = {r["doc_id"]: r["n"] for r in pieces}
    assert totals[1] == totals[0] + 1 and all(r["most"] <= 4096 for r in pieces) and totals[5] == 1
    counted = {r["word"]: r["n"] for r in spelling.count_words(df).collect()}
    assert set(counted) == set()  # "word" and "short" have fewer than six letters, the long word stands once
    assert by_id(language.predict(df, language.LanguageModel([], [{}] * 5, None)))[0]["lang_pred"] == "und"
    likeness = by_id(sketches.edited_texts(df).select("doc_id", sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near")))
    assert likeness[1]["near"] > 0.95
