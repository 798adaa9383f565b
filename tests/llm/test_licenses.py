"""License scans beside brute force."""

import math
import re

import duckdb
import pytest

from millrace.llm import licenses, queries
from millrace.llm.common import LOWER, UPPER

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
HARD = [
    "CC BY cc-by CC_BY cc by by", "cc CC BY", "the GNU General Public License, version 3. All Rights Reserved",
    "all rights all rights reserved reserved", "Released under the MIT License.", "mit license", "a released by the mit license",
    "license version 2 0", "General Public License version", "écc by", "cc by4 0", "under the Apache License, Version 2.0 only",
    "licensed under cc by sa 4 0", "public domain", "released into the public domain", None, "", "cc", "cc by", "by cc by",
    "cc\x00by", "cc0 1 0 universal", "Redistribution, and use in source and binary forms, are permitted",
]
# Notices whole, cut at both ends, with words changed, with a word more in the middle, and without their phrase.
for _t in licenses.NOTICES:
    _w, _n = _t.words, len(_t.words)
    HARD += [_t.phrase.capitalize() + ".", " ".join(_w[_n // 6:]), "x, " + " ".join(_w[:_n - _n // 8]) + " y",
             " ".join("changed" if i % 9 == 0 and w not in _t.key.split() else w for i, w in enumerate(_w)),
             " ".join([*_w[:_n // 2], "more", *_w[_n // 2:]]), _t.phrase.replace(_t.key, ""), _t.key, _t.phrase + "\n\n" + _t.phrase]


def brute(docs):
    known = [*licenses.BASE, *licenses.MORE, *licenses.NOTICES]
    split = [WORD.findall((t or "").translate(str.maketrans(UPPER, LOWER))) for _, t in docs]
    weight = {w: math.log((len(docs) + 1) / (sum(w in set(s) for s in split) + 1)) + 1 for t in known for w in t.words}
    out = []
    for (doc, _), words in zip(docs, split):
        found = []
        for t in known:
            for start in range(-len(t.words), len(words)):
                same = [0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(t.words)]
                score = sum(weight[w] for w, s in zip(t.words, same) if s) / sum(weight[w] for w in t.words)
                if all(same[t.key_at:t.key_at + len(t.key.split())]) and score >= (1 if t.base else licenses.COVER) - 1e-9:
                    found.append((t.label, t.base, start, score))
        base = [f for f in found if f[1]]
        starts = [f[2] for f in base]
        out.append((repr(doc), len(words), len(base), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({f[0] for f in base})), ",".join(sorted({f[0] for f in found})),
                    round(max((f[3] for f in found), default=0.0), 6)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((repr(r[0]), *r[1:7], r[7]) for r in licenses.summary(licenses.scan(df, [*licenses.MORE, *licenses.NOTICES])).collect()), key=repr)


def test_hard_texts(spark):
    docs = list(enumerate(HARD))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df) == brute(docs)


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(d) for d in enumerate(HARD)])
    rows = con.execute(queries.ORACLES["op10_licenses"]).fetchall()
    assert sorted(((repr(r[0]), *r[1:7], r[7]) for r in rows), key=repr) == brute(list(enumerate(HARD)))


def test_odd_rows(odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(odd) == brute(docs)
    assert found(empty) == []


def test_places(spark):
    df = spark.createDataFrame([(1, "x CC BY and cc by 4.0")], "doc_id long, text string")
    places = licenses.scan(df).first()["places"]
    assert [(p["label"], p["start"], p["score"]) for p in places] == [("cc-by", 1, pytest.approx(1)), ("cc-by", 4, pytest.approx(1))]


def test_postings_of_two_rare_words_are_intersected(spark):
    """A place needs both words at their distance: without the rarer or the other word of the key there is none to compare."""
    df = spark.createDataFrame([(1, "mit x license"), (2, "license mit"), (3, "mit license")], "doc_id long, text string")
    scanned = licenses.scan(df, [licenses.Template("mit", "mit license", "mit license")])
    assert {r["doc_id"]: len(r["places"]) for r in scanned.collect()} == {1: 0, 2: 0, 3: 1}
    plan = scanned._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect" in plan
