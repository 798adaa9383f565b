"""Language ID and toxicity: held-out accuracy, odd rows and parts beside brute force."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

import __spark_entry__ as entry
from millrace.llm import language, toxicity

DIR = "/root/testdata/sf0.01"


def run(spark, prefix):
    return entry.queries()[next(n for n in entry.queries() if n.startswith(prefix))](spark, DIR)


def test_op9_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = run(spark, "op9_").collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    assert right / len(held) > 0.97
    for r in rows:
        if not regex.search(r"\p{L}", docs[r["doc_id"]]["text"] or ""):
            assert r["lang_pred"] == "und"


def test_language_of_odd_rows(spark, odd, empty):
    rows = {repr((r["doc_id"], r["held_out"])): r for r in language.identify(odd).collect()}
    assert all(r["lang_pred"] in ("en", "und") for r in rows.values())
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    for r in rows.values():
        if r["doc_id"] in texts:
            has = bool(regex.search(r"\p{L}", texts[r["doc_id"]] or ""))
            assert (r["lang_pred"] == "und") == (not has), texts[r["doc_id"]]
    assert language.identify(empty).collect() == []
    nameless = odd.withColumn("lang", odd["lang"].substr(9, 1).cast("string")).where("lang is null")
    assert {r["lang_pred"] for r in language.identify(nameless).collect()} <= {"und"}


def test_backoff(spark):
    train = spark.createDataFrame([(1, "the house the dog", "x"), (2, "das haus der hund", "y")], "doc_id long, text string, lang string")
    model = language.fit(train)
    words = {"x": Counter("the house the dog".split()), "y": Counter("das haus der hund".split())}
    size = len({w for c in words.values() for w in c})
    for i, lang in enumerate(["x", "y"]):
        want = math.log((words[lang]["the"] + 0.5) / (4 + 0.5 * size))
        assert model.scores([["the"]])[0][i] == pytest.approx(want, abs=1e-5)
    grams = [model.rows[4][g] for g in ("ouse", "use_")]  # these are known, so shorter ones are not asked
    assert model.found("mouse") == grams
    assert model.scores([["the", "mouse"], []])[0] == pytest.approx(
        model.table[model.rows[0]["the"]] + model.table[grams].mean(0))
    assert model.found("qqq") == []
    got = language.predict(spark.createDataFrame([(1, "mouses"), (2, "hunden"), (3, "123"), (4, None)], "doc_id long, text string"), model)
    assert [r["lang_pred"] for r in got.orderBy("doc_id").collect()] == ["x", "y", "und", "und"]


def test_op8_query(spark):
    rows = {r["doc_id"]: r for r in run(spark, "op8_").collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{DIR}/labels.parquet").collect()
    assert rows.keys() == docs.keys()
    assert all(0 <= r["severity"] <= 2 and r["grade"] in (0, 1, 2) for r in rows.values())
    clean = [rows[r["doc_id"]]["toxic"] for r in labels if r["toxic"] == 0]
    toxic = [rows[r["doc_id"]]["toxic"] for r in labels if r["toxic"] == 1]
    assert sum(clean) / len(clean) < 0.01 and sum(toxic) / len(toxic) > 0.5  # 51 toxic labels to learn from


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").selectExpr("doc_id", "toxic AS grade")
    model = toxicity.fit(toxicity.labelled_rows(docs, labels.where("doc_id % 5 != 0")), 2, severe_from=10)
    assert model.thresholds == sorted(model.thresholds)
    scored = toxicity.score(docs.where("doc_id % 5 = 0"), model).select("doc_id", "toxic")
    held = [(r["grade"], r["toxic"]) for r in scored.join(labels, "doc_id").collect()]
    clean, toxic = ([t for g, t in held if g == y] for y in (0, 1))
    assert sum(clean) / len(clean) < 0.01 and sum(toxic) / len(toxic) > 0.85


def test_ordinal_fit_shares_weights():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    true = np.array([4.0, -3.0, 0.0])
    latent = x @ true + rng.logistic(size=3000)
    grades = (latent > 0).astype(int) + (latent > 2)
    rows, columns = np.nonzero(x > -1)
    weights, cuts = toxicity.fit_ordinal(rows, columns, x[rows, columns], grades, 3, ridge=0.01)
    assert weights == pytest.approx(true, abs=0.5) and cuts == pytest.approx([0, 2], abs=0.4)
    model = toxicity.OrdinalModel({0: 1.0}, [0.0, 2.0])
    assert model.grades(np.array([0.0]))[0] == pytest.approx([0.5, 1 / (1 + math.exp(2))])


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 0), (3, 0), (4, 1), (None, 1), (5, None), (6, 7)], "doc_id long, grade int")
    model = toxicity.fit(toxicity.labelled_rows(odd, labels), 2, severe_from=2)
    assert toxicity.score(odd, model).count() == odd.count()
    assert toxicity.score(empty, model).collect() == []
    none = toxicity.fit(toxicity.labelled_rows(odd, labels.where("false")), 2, severe_from=2)
    assert {(r["severity"], r["grade"], r["toxic"]) for r in toxicity.score(odd, none).collect()} == {(0.0, 0, False)}
