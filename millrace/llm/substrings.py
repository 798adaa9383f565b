"""Removal of repeated passages by a sort of fixed-length word paths, dealt by minimizers; no suffix tree is built."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Memo, free_name, in_order_ranges

WINDOW = 20
# Bytes of text in a bucket, bytes of text whose anchors are one group, leaves in a subtree.
BUCKET_BYTES, ANCHOR_BYTES, LEAVES = 6_000_000, 16_000_000, 1_000_000
# A bucket's suffixes under one anchor are counted so far, to tell how large its group will be.
MOST_COUNTED = 65_535
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Bucket:
    """The documents of a bucket in order, their words in one row, and the paths of their suffixes.

    The path of the suffix at word s is its first ``window`` words as two edges of half as many words (which overlap if that is odd), each by a
    64-bit fingerprint. Its anchor is the least fingerprint of the half-window word runs in the window:
    equal windows have equal anchors wherever they stand, and few runs are an anchor.
    """

    def __init__(self, table: pa.Table, codes: Memo, window: int):
        half = (window + 1) // 2
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] or ""))
        self.order = order
        self.ids = [ids[i] for i in order]
        self.words = [(texts[i] or "").encode().split() for i in order]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        total = int(sizes.sum())
        code = np.fromiter((codes[w] for ws in self.words for w in ws), np.uint64, total)
        n = max(0, total - window + 1)
        self.total, self.window = total, window
        run = np.zeros(max(0, total - half + 1), np.uint64)
        for k in range(half if len(run) else 0):
            run = run * _ODD + code[k:k + len(run)]
        run = _mix(run)
        self.first, self.second = run[:n], run[window - half:window - half + n]
        # The least of a number of neighbours that is no power of two comes from two overlapping ranges.
        width, least = window - half + 1, run
        done = 1
        while done * 2 <= width and len(least):
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        rest = width - done
        # The least of several values is a low one; mixed again, anchors are even over all prefixes.
        self.anchor = _mix(np.minimum(least[:n], least[rest:rest + n])) if n else run[:0]
        valid = np.zeros(n, bool)
        for a, b in zip(self.starts.tolist(), self.ends.tolist()):
            if b - a >= window:
                valid[a:b - window + 1] = True
        self.valid = np.flatnonzero(valid)

    def firsts(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of suffixes ``at``: the first of each path, and all others."""
        path = _mix(self.first[at] + self.second[at] * _ODD)
        order = np.argsort(path, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = path[order[1:]] != path[order[:-1]]
        return at[np.sort(order[new])], at[order[~new]]


def _pack(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values.astype(kind)).tobytes()


def _unpack(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of packed rows, and the row of each."""
    parts = [np.frombuffer(v, kind) for v in column.to_pylist()]
    sizes = [len(p) for p in parts]
    return np.concatenate(parts or [np.zeros(0, kind)]), np.repeat(np.arange(len(parts)), sizes)


def _by_group(group: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(group, places) of each group, places in order."""
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    return [(int(group[p[0]]), p) for p in np.split(order, cuts) if len(p)]


def _anchor_rows(groups: int, window: int):
    codes: list[Memo] = []

    def work(table: pa.Table) -> pa.Table:
        codes[:] = codes or [Memo(lambda w: xxhash.xxh64_intdigest(w))]
        bucket = Bucket(table, codes[0], window)
        anchors, suffixes = np.unique(bucket.anchor[bucket.valid], return_counts=True)
        # The leading bits of the fingerprint, a prefix that is still too short.
        parts = _by_group((anchors >> np.uint64(32)).astype(np.int64) * groups >> 32) if len(anchors) else []
        number = table.column("bucket")[0].as_py()
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int64()),
                         "bucket": pa.array([number] * len(parts), pa.int32()),
                         "anchors": pa.array([_pack(anchors[i], "<u8") for _, i in parts], pa.binary()),
                         "suffixes": pa.array([_pack(np.minimum(suffixes[i], MOST_COUNTED), "<u2") for _, i in parts], pa.binary())})

    return work


def _prefix_rows(leaves: int):
    """Anchors that several buckets have, each with the prefix group that its suffixes go to.

    Going through the fingerprints in order, a group is closed when it is full: its prefix is as long as
    its size asks for. Suffixes under one fingerprint that fill more than a group are told apart
    by further bits of their path. A group's size is the number of suffixes that its anchors have in their buckets.
    """
    def work(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        anchors, row = _unpack(table.column("anchors"), "<u8")
        suffixes, _ = _unpack(table.column("suffixes"), "<u2")
        order = np.argsort(anchors, kind="stable")
        anchors, row, suffixes = anchors[order], row[order], suffixes[order]
        new = np.ones(len(anchors), bool)
        new[1:] = anchors[1:] != anchors[:-1]
        run = np.cumsum(new) - 1
        size = np.bincount(run, minlength=1)
        load = np.where(size > 1, np.bincount(run, suffixes, minlength=1), 0)
        group = ((np.cumsum(load) - load) // leaves).astype(np.int64)
        more = np.ceil(np.log2(np.maximum(load / leaves, 1))).astype(np.int64)
        kept = size[run] > 1
        numbers = table.column("bucket").to_numpy()[row[kept]]
        anchors, group, more = anchors[kept], group[run[kept]], more[run[kept]]
        rows = _by_group(numbers)
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()),
                         "anchors": pa.array([_pack(anchors[i], "<u8") for _, i in rows], pa.binary()),
                         "groups": pa.array([_pack((part << 32) + group[i], "<i8") for _, i in rows], pa.binary()),
                         "more": pa.array([_pack(more[i], "u1") for _, i in rows], pa.binary())})

    return work


def _suffix_rows(window: int):
    codes: list[Memo] = []
    none = pa.table({"part": pa.array([], pa.int64()), "bucket": pa.array([], pa.int32()), "first": pa.array([], pa.binary()),
                     "second": pa.array([], pa.binary()), "place": pa.array([], pa.binary())})

    def work(docs: pa.Table, prefixes: pa.Table) -> pa.Table:
        if not len(docs) or not len(prefixes):
            return none
        codes[:] = codes or [Memo(lambda w: xxhash.xxh64_intdigest(w))]
        bucket = Bucket(docs, codes[0], window)
        anchors, _ = _unpack(prefixes.column("anchors"), "<u8")
        order = np.argsort(anchors)
        anchors = anchors[order]
        groups, more = _unpack(prefixes.column("groups"), "<i8")[0][order], _unpack(prefixes.column("more"), "u1")[0][order]
        at = bucket.valid
        slot = np.minimum(np.searchsorted(anchors, bucket.anchor[at]), len(anchors) - 1)
        at = at[anchors[slot] == bucket.anchor[at]]
        at, _ = bucket.firsts(at)
        slot = np.searchsorted(anchors, bucket.anchor[at])
        first, second = bucket.first[at], bucket.second[at]
        longer = np.where(more[slot] > 0, _mix(first + second) >> (np.uint64(64) - np.maximum(more[slot], 1).astype(np.uint64)),
                          np.uint64(0)).astype(np.int64)
        rows = _by_group((groups[slot] + (longer << 20)) if len(at) else np.zeros(0, np.int64))
        return pa.table({"part": pa.array([g for g, _ in rows], pa.int64()),
                         "bucket": pa.array([docs.column("bucket")[0].as_py()] * len(rows), pa.int32()),
                         "first": pa.array([_pack(first[i], "<u8") for _, i in rows], pa.binary()),
                         "second": pa.array([_pack(second[i], "<u8") for _, i in rows], pa.binary()),
                         "place": pa.array([_pack(at[i], "<u4") for _, i in rows], pa.binary())})

    return work


def _subtree_rows(table: pa.Table) -> pa.Table:
    """The leaves of a subtree's nodes at window depth that are not the first of their node.

    Leaves are sorted by path; neighbours that agree in both edges are below one node of window depth. A node with
    one leaf is no repeat.
    """
    order = np.argsort(table.column("bucket").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    first, row = _unpack(table.column("first"), "<u8")
    second, place = _unpack(table.column("second"), "<u8")[0], _unpack(table.column("place"), "<u4")[0]
    leaf = np.lexsort((row, second, first))
    same = np.zeros(len(leaf), bool)
    same[1:] = (first[leaf[1:]] == first[leaf[:-1]]) & (second[leaf[1:]] == second[leaf[:-1]])
    later = leaf[same]
    rows = _by_group(table.column("bucket").to_numpy()[row[later]])
    return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()),
                     "place": pa.array([_pack(place[later[i]], "<u4") for _, i in rows], pa.binary())})


def _removal_rows(window: int, kind: pa.DataType, extra: list[str], untouched: bool):
    codes: list[Memo] = []

    def work(docs: pa.Table, repeats: pa.Table) -> pa.Table:
        codes[:] = codes or [Memo(lambda w: xxhash.xxh64_intdigest(w))]
        bucket = Bucket(docs, codes[0], window)
        _, here = bucket.firsts(bucket.valid)
        there, _ = _unpack(repeats.column("place"), "<u4")
        change = np.zeros(bucket.total + 1, np.int64)
        for at in (here, there.astype(np.int64)):
            np.add.at(change, at, 1)
            np.add.at(change, at + window, -1)
        gone = np.cumsum(change)[:-1] > 0
        n_removed, spans, kept = [], [], []
        texts = docs.column("text").take(pa.array(bucket.order)).to_pylist() if untouched else None
        for words, a, b in zip(bucket.words, bucket.starts.tolist(), bucket.ends.tolist()):
            mine = gone[a:b]
            n = int(mine.sum())
            n_removed.append(n)
            if not n:
                spans.append([])
                kept.append((texts[len(kept)] or "").encode() if untouched else b" ".join(words))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
            spans.append(edges.reshape(-1, 2).tolist())
            kept.append(b" ".join([w for w, g in zip(words, mine.tolist()) if not g]))
        order = pa.array(bucket.order, pa.int64())
        return pa.table({"doc_id": pa.array(bucket.ids, kind), **{c: docs.column(c).take(order) for c in extra}, "n_words": pa.array(bucket.ends - bucket.starts, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                         "kept": pa.array([k.decode() for k in kept], pa.string())})

    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = BUCKET_BYTES, leaves: int = LEAVES, untouched: bool = False,
                   extra: Sequence[Column] = ()) -> DataFrame:
    """One row per document: doc_id, the ``extra`` columns, n_words, n_removed, spans array<array<int>> and kept string.

    Words are cut at ASCII white space. A word is removed if it is in a run of ``window`` words that also
    starts earlier: in a document with a smaller id, or earlier in the same one. Runs are judged on the input. ``kept`` has
    the other words, joined by a space (with ``untouched``, a text that loses none as it is); ``spans`` the first and past-the-end number of each removed stretch.

    1. Documents go to buckets in order of id and the text's hash, by size. The texts move once.
    2. A suffix can only be repeated in another bucket if its anchor is. Each bucket sends its distinct
       anchors; those in several buckets are parted into prefix groups of at most about ``leaves`` suffixes.
    3. Each bucket sends the first suffix of each path under such an anchor to its prefix group: a passage
       that a third of all documents have is sent once per bucket.
    4. A group is the subtree under its prefix; its nodes at window depth with more than one leaf are the
       repeats, and every leaf but that of the first bucket goes back to its bucket.
    5. Buckets add what they repeat in themselves and remove.

    Both edges are compared by 64 bits of fingerprint. Ids are numbers. Null text has no words. Null
    ids come before all others; rows of one id are in order of text. An empty table gives no
    rows. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *extra)
    carried = [f for f in rows.schema if f.name not in ("doc_id", "text")]
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    tie = free_name("__tie", *rows.columns)
    dealt, _ = in_order_ranges(rows.withColumn(tie, F.xxhash64("text")), "doc_id", tie, buckets, "bucket")
    dealt = dealt.drop(tie)
    groups = max(8, math.ceil(size / ANCHOR_BYTES))
    by_bucket = dealt.groupBy("bucket")
    anchors = by_bucket.applyInArrow(_anchor_rows(groups, window), "part long, bucket int, anchors binary, suffixes binary")
    prefixes = anchors.groupBy("part").applyInArrow(
        _prefix_rows(leaves), "bucket int, anchors binary, groups binary, more binary")
    suffixes = by_bucket.cogroup(prefixes.groupBy("bucket")).applyInArrow(
        _suffix_rows(window), "part long, bucket int, first binary, second binary, place binary")
    repeats = suffixes.groupBy("part").applyInArrow(_subtree_rows, "bucket int, place binary")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return by_bucket.cogroup(repeats.groupBy("bucket")).applyInArrow(
        _removal_rows(window, to_arrow_type(rows.schema["doc_id"].dataType), [f.name for f in carried], untouched),
        ", ".join([f"doc_id {kind}", *(f"`{f.name}` {f.dataType.simpleString()}" for f in carried),
                   "n_words long, n_removed long, spans array<array<int>>, kept string"]))
