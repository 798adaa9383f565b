"""SimHash beside brute force over all pairs."""

import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from millrace.llm import simhash
from millrace.llm.common import LOWER, UPPER
from millrace.llm.components import components

from .conftest import SF


def brute_print(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=4):
    """{row number: smallest id reachable}"""
    prints = np.array([p for _, p in rows], np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(rows))]


def expected(docs):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs]
    return sorted((repr(d), f"{p:016x}", repr(c)) for (d, p), c in zip(rows, brute_components(rows)))


def found(df):
    return sorted((repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in df.collect())


def test_op1_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    name = next(n for n in entry.queries() if n.startswith("op1_"))
    got = found(entry.queries()[name](spark, SF))
    assert got == expected(docs)
    assert len({c for _, _, c in got}) < len(got)


@pytest.mark.parametrize("tile", [2, 5, None])
def test_odd_rows_and_small_tiles(odd, empty, tile):
    assert found(simhash.near_duplicates(odd, tile=tile)) == expected(odd.collect())
    assert simhash.near_duplicates(empty, tile=tile).collect() == []


@pytest.mark.parametrize("lanes", [1, 3])
def test_tile_links_connect_what_is_near(lanes):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, (40, lanes), dtype=np.uint64)
    prints = np.repeat(centres, 30, 0)
    for _ in range(6):
        rows = np.flatnonzero(rng.random(len(prints)) < 0.5)
        prints[rows, rng.integers(0, lanes, len(rows))] ^= np.uint64(1) << rng.integers(0, 64, len(rows), dtype=np.uint64)
    radius = 5
    near = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2) <= radius
    want = np.arange(len(prints))
    while True:
        low = np.array([want[near[i]].min() for i in range(len(prints))])
        if (low == want).all():
            break
        want = low
    half = len(prints) // 3
    links = [simhash.tile_links(prints[:half], None, radius), simhash.tile_links(prints[half:], None, radius),
             simhash.tile_links(prints[:half], prints[half:], radius)]
    links[1] = (links[1][0] + half, links[1][1] + half)
    root = np.arange(len(prints))
    for a, b in links:
        assert len(a) < len(prints)
        root = simhash._link(root, a, b)
    assert (root == want).all()


def test_lanes_tell_similar_from_other():
    words = [f"w{i}" for i in range(600)]
    changed = list(words)
    changed[100:130] = [f"x{i}" for i in range(30)]
    apart = lambda a, b: int(np.bitwise_count(
        simhash.simhash(" ".join(a), 5, 4) ^ simhash.simhash(" ".join(b), 5, 4)).sum())
    assert apart(words, changed) <= simhash.radius_of(0.8, 4) < apart(words, words[300:] + changed[100:130] * 10)


def test_components(spark):
    links = [(f"{i:03d}", f"{i + 1:03d}") for i in range(200)] + [("z1", "z2"), ("z3", "z2"), ("q", "q"), ("z1", "z2")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {f"{i:03d}": "000" for i in range(1, 201)} | {"z2": "z1", "z3": "z1"}
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
