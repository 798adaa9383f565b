"""Spelling variants beside a plain version."""

import collections
import random
import re
import zlib

import pytest

from millrace.llm import spelling
from millrace.llm.common import LOWER, UPPER


def words_of(rows):
    found = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return found


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(rows, least_chars=6, least_count=5, ratio=5):
    words = {w: n for w, n in words_of(rows).items() if len(w) >= least_chars and n >= least_count}
    beside = {w: [v for v in words if near(v, w)] for w in words}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(beside[w]), words.get(form.get(w))))
    return sorted(out)


def texts(seed=1, n=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeé÷o") for _ in range(rng.randint(5, 9))) for _ in range(30)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(30):
            w = rng.choice(stems[:8] if rng.random() < 0.7 else stems)
            while rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("abÉo") + w[k:], w[:k] + rng.choice("cdé") + w[k + 1:]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, rng.choice([" ", "\n", ", ", "1"]).join(words)))
    return rows


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("crowd", [2, 200])
def test_like_brute_force(spark, crowd):
    rows = texts()
    want = brute(rows)
    assert len(want) > 100 and any(w[1] for w in want) and any(w[1] != w[2] and w[1] for w in want)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(spelling.variants(docs, crowd=crowd)) == want


def test_signatures_meet_for_every_near_pair():
    rng, part_of = random.Random(2), lambda d: spelling._part_of(d, 7)

    class Parts(dict):
        def __missing__(self, key):
            return part_of(key)

    for _ in range(500):
        a = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 12)))
        k = rng.randrange(len(a))
        for b in (a[:k] + rng.choice("xyz") + a[k + 1:], a[:k] + a[k + 1:], a[:k] + "q" + a[k:]):
            sa, sb = ({(min(s[0], 1), s[1], s[2]) for s in spelling.signatures(w, 7, Parts())} for w in (a, b))
            assert sa & sb


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    clash = odd.selectExpr("*", "1 AS word", "2 AS n", "3 AS sig", "4 AS run", "5 AS form")
    assert result(spelling.variants(clash, least_chars=1, least_count=1)) == brute(rows, 1, 1)
    assert spelling.variants(empty).collect() == []


def test_chains_end_at_their_last_form(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(21)] + [("v", "w3")], "word string, form string")
    assert {r["word"]: r["root"] for r in spelling.roots(forms).collect()} == {"v": "w21", **{f"w{i}": "w21" for i in range(21)}}


def test_long_words_and_a_crowd_of_near_words(spark):
    base = "abcdefghijklmnopqrst"
    crowd = sorted({base[:i] + c + base[i + 1:] for i in range(20) for c in "uvwxyz"})
    long = "x" * 50_000
    rows = [(1, " ".join([base] * 30 + crowd * 5 + [long] * 6 + [long + "y"] * 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(spelling.variants(docs, crowd=10))
    assert got == brute(rows)
