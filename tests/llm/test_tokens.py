"""Packing and BPE beside the tokenizers library."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from millrace.llm import bpe, packing

from .conftest import SF, TEXTS

ODD = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sStTdD<|>éÉñİσΣ́\x85\x1c 0a_")),
              max_size=40)


def library(spec):
    tok = Tokenizer.from_str(spec)
    tok.no_truncation()
    tok.no_padding()
    return lambda t: tok.encode(t, add_special_tokens=False).ids, tok


@pytest.fixture(scope="module")
def word(vocabulary):
    spec = vocabulary("word_bpe_49k.json")
    return packing.WordTokenizer(spec), library(spec)[0]


@pytest.fixture(scope="module")
def byte(vocabulary):
    spec = vocabulary("byte_bpe_50k.json")
    return bpe.Merger(spec), *library(spec)


def test_word_ids_equal_the_library(word, spark):
    mine, theirs = word
    texts = [t for t in TEXTS if t] + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text in texts:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs(text), text[:80]


@settings(max_examples=400, deadline=None)
@given(text=ODD)
def test_word_ids_of_any_text(word, text):
    mine, theirs = word
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == theirs(text)


@settings(max_examples=400, deadline=None)
@given(text=ODD)
def test_byte_ids_of_any_text(byte, text):
    merger, theirs, _ = byte
    assert np.frombuffer(bpe.Encoder(merger, None).encode(text), "<i4").tolist() == theirs(text)


def test_automaton_is_minimal_and_exact(tmp_path, byte):
    merger = byte[0]
    words = [w.encode() for w in "tap taps top tops stop stops a é éé walking talking".split()]
    arrays = bpe.Automaton.build((w, merger.merge(w)) for w in words)
    (tmp_path / "a.fst").write_bytes(bpe.Automaton.image(arrays))
    found = bpe.Automaton.open(str(tmp_path / "a.fst"))
    assert [found.get(w) for w in words] == [merger.merge(w) for w in words]
    assert all(found.get(w) is None for w in (b"", b"ta", b"tapss", b"x", b"walkin"))
    languages = set()  # no two states accept the same endings

    def endings(state):
        out = {b""} if found.final[state] else set()
        for arc in np.flatnonzero(found.keys // 256 == state):
            out |= {bytes([found.label[arc]]) + e for e in endings(int(found.target[arc]))}
        return frozenset(out)

    for state in range(len(found.final)):
        languages.add(endings(state))
    assert len(languages) == len(found.final)
    assert bpe.Automaton.open(str(tmp_path / "a.fst")).get(b"stop") == merger.merge(b"stop")


def test_loose_texts_walk_the_automaton(tmp_path, byte):
    """Indented and double-spaced texts ask the automaton for their words too, and only unknown ones are merged."""
    merger, theirs, _ = byte
    words = [w.encode() for w in (" return", "return", " value", " for", " ", "\n", "   ", "def")]
    arrays = bpe.Automaton.build((w, merger.merge(w)) for w in words)
    (tmp_path / "a.fst").write_bytes(bpe.Automaton.image(arrays))
    encoder, merged = bpe.Encoder(merger, bpe.Automaton.open(str(tmp_path / "a.fst"))), []
    real = merger.merge
    encoder.merger = type("Seen", (), {"special": merger.special, "cut": merger.cut, "merge": staticmethod(lambda w: merged.append(w) or real(w))})()
    text = "def  f:\n    return value\n    for value  in value: return value \n"
    assert np.frombuffer(encoder.encode(text), "<i4").tolist() == theirs(text)
    merged.clear()
    encoder._of_words([bpe.WORDS.findall(text)])
    assert merged and not set(merged) & set(words)


def test_empty_automaton(tmp_path):
    (tmp_path / "e.fst").write_bytes(bpe.Automaton.image(bpe.Automaton.build([])))
    assert bpe.Automaton.open(str(tmp_path / "e.fst")).get(b"a") is None


def test_encode_and_decode_frames(spark, odd, empty, vocabulary, byte):
    _, theirs, tok = byte
    spec = vocabulary("byte_bpe_50k.json")
    got = bpe.decode(bpe.encode(odd, spec, bpe.compile_lexicon(odd, spec, words=20)), spec)
    want = sorted((repr(r["doc_id"]), theirs(r["text"] or "")) for r in odd.collect())
    assert sorted((repr(r["doc_id"]), r["ids"]) for r in got.collect()) == want
    assert all(r["text"] == tok.decode(r["ids"], skip_special_tokens=False) for r in got.collect())
    assert bpe.decode(bpe.encode(empty, spec, bpe.compile_lexicon(empty, spec)), spec).collect() == []
    broken = spark.createDataFrame([([255, 128],), (None,), ([10 ** 6, 64],)], "ids array<int>")
    assert [r["text"] for r in bpe.decode(broken, spec).collect()][1:] == ["", "a"]


def test_op6_query(spark, byte):
    _, theirs, tok = byte
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = theirs(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    name = next(n for n in entry.queries() if n.startswith("op6_"))
    assert sorted(map(tuple, entry.queries()[name](spark, SF).collect())) == sorted(want)


def check_packing(rows, want, capacity):
    got = sorted((repr(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert got == sorted(want)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in rows) // capacity)
    assert len(bins) <= 1.01 * least + 2
    return len(bins), least


def pieces_of(docs, theirs, capacity):
    out = []
    for r in docs:
        ids = theirs(r["text"] or "") + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            out.append((repr(r["doc_id"]), k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def test_pack_frames(odd, empty, vocabulary, word):
    spec = vocabulary("word_bpe_49k.json")
    for capacity in (7, 64, 4096):
        rows = packing.pack_documents(odd, spec, capacity).collect()
        want = pieces_of(odd.collect(), word[1], capacity)
        got = sorted((repr(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
        assert got == sorted(want)
    assert packing.pack_documents(empty, spec).collect() == []


def test_op4_query(spark, word):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    name = next(n for n in entry.queries() if n.startswith("op4_"))
    check_packing(entry.queries()[name](spark, SF).collect(), pieces_of(docs, word[1], 4096), 4096)


def brute_plan(counts, capacity):
    """Best-two-fit, one bin at a time."""
    left, bins = collections.Counter(counts), collections.Counter()
    while left := +left:
        fill, gap = [], capacity
        while fits := [n for n in left if left[n] > fill.count(n) and n <= gap]:
            fill.append(max(fits))
            gap -= max(fits)
        if gap and len(fill) > 1:
            room, free = gap + fill[-1], left - collections.Counter(fill)
            sums = [a + b for a in free for b in free if a + b <= room and (a != b or free[a] > 1)]
            if sums and max(sums) > fill[-1]:
                a = max(a for a in free for b in free if a + b == max(sums) and (a != b or free[a] > 1))
                fill[-1:] = [a, max(sums) - a]
        left -= collections.Counter(fill)
        bins[tuple(sorted(fill, reverse=True))] += 1
    return bins


@settings(max_examples=60, deadline=None)
@given(counts=st.dictionaries(st.integers(1, 50), st.integers(1, 9), max_size=12))
def test_plan_is_within_a_bin_of_one_bin_at_a_time(counts):
    bins = packing.plan_bins(counts, 50)
    used = collections.Counter()
    for fill, times in bins:
        assert sum(fill) <= 50
        for n in fill:
            used[n] += times
    assert used == collections.Counter(counts)
    brute = brute_plan(counts, 50)
    assert abs(sum(t for _, t in bins) - brute.total()) <= 1
