"""Bitmaps of documents, and a reduce in order as a table function."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators import postings, textjobs


@pytest.mark.parametrize("few", [0, 3, 64])
def test_documents_with_all_words(spark, few):
    rng = random.Random(few)
    texts = {i: " ".join(rng.choice("abcdefgh") * rng.choice((1, 1, 2)) for _ in range(rng.randint(0, 8)))
             for i in [*range(150), 32_767, 32_768, 70_000, 5_000_000_000]}
    df = spark.createDataFrame([*texts.items(), (3, "zz"), (None, "a b"), (9, None)], "doc long, text string")
    index = postings.build(df, "doc", "text", few=few)
    assert index.where("(places IS NULL) = (bitmap IS NULL)").count() == 0
    assert index.where(f"bitmap IS NOT NULL AND n <= {few}").count() == 0
    asked = {"one": ["a"], "two": ["a", "b"], "same": ["cc", "cc"], "three": ["a", "b", "c"], "absent": ["a", "nowhere"], "none": []}
    got = sorted((r["query"], r["doc"]) for r in postings.documents_with_all(index, asked).collect())
    held = lambda t, w: t is not None and set(w) <= set(t.split(" "))
    assert got == sorted((q, i) for q, w in asked.items() for i, t in texts.items() if w and held(t, w))


def test_negative_ids_fail_and_empty_tables(spark):
    bad = spark.createDataFrame([(-1, "a")], "doc long, text string")
    with pytest.raises(Exception, match="negative document id"):
        postings.build(bad, "doc", "text").collect()
    index = postings.build(bad.limit(0), "doc", "text")
    assert postings.documents_with_all(index, {"q": ["a"]}).collect() == []


def test_a_reduce_in_order_of_any_key_type(spark):
    data = [(i % 3, 100 - i, f"v{i}") for i in range(20)]
    df = spark.createDataFrame(data, "k int, at int, v string").repartition(4)
    add = lambda state, row: state + row["v"]
    got = textjobs.ordered_reduce(df, "k", "at", str, add, lambda s: (s, len(s)), "all string, n int")
    assert got.dtypes == [("k", "int"), ("all", "string"), ("n", "int")]
    want = {k: "".join(v for _, v in sorted((at, v) for k2, at, v in data if k2 == k)) for k in range(3)}
    assert rows(got) == sorted((k, s, len(s)) for k, s in want.items())
    named = df.select(F.concat(F.lit("k"), "k").alias("k"), "at", "v")
    assert textjobs.ordered_reduce(named, "k", "at", str, add, lambda s: (s,), "all string").dtypes[0] == ("k", "string")
