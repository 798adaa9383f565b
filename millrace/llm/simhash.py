"""Near duplicates by SimHash and tiled exact comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import numbered, slices
from .components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
# Fingerprints in a tile at most, and the number of tiles up to which tiles are smaller.
TILE, TILES = 1 << 17, 24
# Shingles that are hashed at once.
CHUNK = 1 << 15
# Rows and columns of a block of one comparison.
BLOCK = (512, 2048)


def _mixed(h: np.ndarray, lane: int) -> np.ndarray:
    """Another 64 bits of each hash (the finaliser of splitmix64 over hash and lane)."""
    h = h + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """The hash of each shingle in order, repeats included, ``CHUNK`` at a time."""
    words = (text or "").encode().lower().split()
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words))
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[width - 1:] - 1).tolist()
    for at in range(0, n, CHUNK):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])], np.uint64)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The different shingle hashes of a text in order of value; none if it has no word."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *_hashes(text, shingle)]))


def simhash(text: str | None, shingle: int = SHINGLE, lanes: int = 1, distinct: bool = False) -> np.ndarray:
    """``lanes`` times 64 bits: one where over half of the shingle hashes have a one.

    A shingle that is repeated counts each time; with ``distinct``, once in the whole text.
    """
    chunks = _hashes(text, shingle)
    if distinct:
        whole = shingle_set(text, shingle)
        chunks = (whole[at:at + CHUNK] for at in range(0, len(whole), CHUNK))
    out, ones, n = np.zeros(lanes, np.uint64), np.zeros((lanes, 64), np.int64), 0
    for h in chunks:
        n += len(h)
        for lane in range(lanes):
            bits = np.unpackbits((_mixed(h, lane) if lane else h).view(np.uint8), bitorder="little")
            ones[lane] += bits.reshape(-1, 64).sum(0, dtype=np.int32)
    for lane in range(lanes):
        out[lane] = np.packbits(ones[lane] * 2 > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, lanes: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", *extra, distinct: bool = False) -> DataFrame:
    """doc_id, bits array<long> (one per lane), ones int (bits set), and the ``extra`` columns."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("text"))
    kept = [f for f in rows.schema if f.name != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch, "text"):
                bits = np.array([simhash(t, shingle, lanes, distinct) for t in texts], np.uint64).reshape(-1, lanes)
                ends = pa.array(np.arange(0, len(texts) * lanes + 1, lanes, dtype=np.int32))
                ones = np.bitwise_count(bits).sum(1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name).slice(first, len(texts)) for f in kept]
                    + [pa.ListArray.from_arrays(ends, pa.array(bits.ravel().view(np.int64))), pa.array(ones)],
                    [*(f.name for f in kept), "bits", "ones"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return rows.mapInArrow(work, ", ".join([*fields, "bits array<long>, ones int"]))


def _find(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def _link(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the trees of linked nodes; the smaller root wins. In each pass every tree joins one other."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        high, low = np.maximum(ra[apart], rb[apart]), np.minimum(ra[apart], rb[apart])
        root = root.copy()
        root[high] = low  # of several, one stays
        root = _find(root)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the fingerprints within ``radius`` bits, as pairs of row numbers.

    ``left`` and ``right`` are rows of 64-bit lanes; without ``right``, ``left`` is compared with itself. Rows of
    the right side are numbered after those of the left. Every pair is compared by exclusive or and bit count, in
    blocks; blocks whose bit counts differ by more than the radius hold no link and are skipped. Links
    inside a tree that is known are left out, so there are fewer links than rows.
    """
    n = len(left)
    a_ones = np.bitwise_count(left).sum(1, dtype=np.int32)
    a_order = np.argsort(a_ones, kind="stable")
    if right is None:
        right, b_order, b_ones, base = left, a_order, a_ones, 0
    else:
        b_ones = np.bitwise_count(right).sum(1, dtype=np.int32)
        b_order, base = np.argsort(b_ones, kind="stable"), n
    lefts, rights = left[a_order], right[b_order]
    a_ones, b_ones = a_ones[a_order], b_ones[b_order]
    root = np.arange(n + (base and len(right)))
    # As many lanes as make a hit of unrelated fingerprints rare.
    lanes = left.shape[1]
    leading = next((k for k in range((lanes + 1) // 2, lanes) if 32 * k - 12 * math.sqrt(k) > radius), lanes)
    for i in range(0, n, BLOCK[0]):
        rows = lefts[i:i + BLOCK[0]]
        low, high = a_ones[i], a_ones[min(i + BLOCK[0], n) - 1]
        start = int(np.searchsorted(b_ones, low - radius, "left"))
        stop = int(np.searchsorted(b_ones, high + radius, "right"))
        if not base:
            start = max(start, i)  # the other half is the same pairs
        for j in range(start, stop, BLOCK[1]):
            columns = rights[j:min(j + BLOCK[1], stop)]
            apart = np.bitwise_count(rows[:, None, 0] ^ columns[None, :, 0])
            for lane in range(1, leading):
                apart = apart + np.bitwise_count(rows[:, None, lane] ^ columns[None, :, lane])
            hit = np.flatnonzero((apart <= radius).ravel())
            if hit.size:  # the other lanes can only add
                apart = apart.ravel()[hit].astype(np.int32)
                x, y = hit // len(columns), hit % len(columns)
                for lane in range(leading, lanes):
                    apart += np.bitwise_count(rows[x, lane] ^ columns[y, lane])
                near = apart <= radius
                root = _link(root, a_order[i + x[near]], b_order[j + y[near]] + base)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return linked, root[linked]


def _bands(counts: dict[int, int], size: int) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """For each bit count its first tile and number of tiles; for each tile its lowest and highest bit count."""
    top = max(counts) + 1
    first, number, spans = [0] * top, [1] * top, []
    held = 0  # rows in the open tile
    for ones in range(top):
        n = counts.get(ones, 0)
        if n > size or held + n > size or not spans:
            number[ones] = max(1, math.ceil(n / size))
            first[ones] = len(spans)
            spans += [(ones, ones)] * number[ones]
            held = n if number[ones] == 1 else size
        else:
            first[ones] = len(spans) - 1
            spans[-1] = (spans[-1][0], ones)
            held += n
    return first, number, spans


def near_links(prints: DataFrame, radius: int, tile: int | None = None) -> DataFrame:
    """(a, b) hexadecimal fingerprints: links that connect all fingerprints within ``radius`` bits.

    ``prints`` has bits and ones, without repeats. Fingerprints are dealt into tiles by bit count; a large
    bit count is dealt by hash into several. Each pair of tiles whose bit counts are within the
    radius is one group, bounded by the tile size, and gives a forest, not all its pairs.
    """
    counts = {r["ones"]: r["n"] for r in prints.groupBy("ones").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return prints.sparkSession.createDataFrame([], "a string, b string")
    size = tile or min(TILE, max(1024, math.ceil(sum(counts.values()) / TILES)))
    first, number, spans = _bands(counts, size)
    at = lambda values, i: F.element_at(F.array(*map(F.lit, values)), i + F.lit(1))
    dealt = at(first, F.col("ones")) + F.pmod(F.xxhash64("bits"), at(number, F.col("ones"))).cast("int")
    tiles = (prints.select("bits", dealt.alias("tile"), F.pmod(F.xxhash64("bits", F.lit(1)), F.lit(128)).alias("chunk"))
             .groupBy("tile", "chunk").agg(F.flatten(F.collect_list("bits")).alias("bits")))
    low, high = [s[0] for s in spans], [s[1] for s in spans]
    # Tiles are in order of bit counts, so the partners of a tile are a range.
    partner = [(next(i for i in range(len(spans)) if high[i] >= low[t] - radius),
                next(i for i in reversed(range(len(spans))) if low[i] <= high[t] + radius)) for t in range(len(spans))]
    other = F.explode(F.sequence(at([p[0] for p in partner], F.col("tile")), at([p[1] for p in partner], F.col("tile"))))
    paired = (tiles.select("tile", "bits", other.alias("other"))
              .select(F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), "tile", "bits"))
    lanes = len(prints.select("bits").first()["bits"])

    def work(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        side = {t: np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.filter(
            pa.compute.equal(table.column("tile"), t)).column("bits").chunks] or [np.zeros(0, np.int64)]
            ).view(np.uint64).reshape(-1, lanes) for t in {x, y}}
        if x != y and not (len(side[x]) and len(side[y])):
            return pa.table({"a": pa.array([], pa.string()), "b": pa.array([], pa.string())})
        a, b = tile_links(side[x], side[y] if x != y else None, radius)
        both = np.concatenate([side[x], side[y]]) if x != y else side[x]
        name = lambda rows: pa.array([r.astype(">u8").tobytes().hex() for r in both[rows]], pa.string())
        return pa.table({"a": name(a), "b": name(b)})

    return paired.groupBy("x", "y").applyInArrow(work, "a string, b string")


def hexadecimal(bits: str = "bits"):
    """The fingerprint as hexadecimal digits, 16 for each lane."""
    digits = F.transform(F.col(bits), lambda b: F.lpad(F.lower(F.hex(b)), 16, "0"))
    return F.array_join(digits, "")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, lanes: int = 1,
                    id_col: str = "doc_id", text_col: str = "text", tile: int | None = None, *extra,
                    distinct: bool = False) -> DataFrame:
    """One row per document: doc_id, the ``extra`` columns, fingerprint, component_id, component_size
    and component, the fingerprint that stands for it.

    A-Z are lower-cased, words are cut at ASCII white space, and a fingerprint bit is set where over half of the
    shingle hashes (XXH64, repeats included, or without them if ``distinct``) have it. Fewer words than a shingle are one shingle; no
    word gives fingerprint zero, linked like any other. Fingerprints within ``radius`` bits are linked;
    ``component_id`` is the smallest id that can be reached. Equal fingerprints are compared once, whatever
    the number of their documents.

    Null text counts as empty. Null ids are no candidates for component_id; it is null if there is no other. Rows
    with equal ids are rows of their own. An empty table gives no rows. Other columns are not read.
    """
    prints = cut_lineage(fingerprints(docs, shingle, lanes, id_col, text_col, *extra, distinct=distinct)
                         .withColumn("fingerprint", hexadecimal()), "prints")
    nodes = cut_lineage(prints.groupBy("fingerprint").agg(
        F.first("bits").alias("bits"), F.first("ones").alias("ones"), F.min("doc_id").alias("least"),
        F.count("*").alias("n")), "nodes")
    roots = components(near_links(nodes.select("bits", "ones"), radius, tile))
    rooted = (nodes.select("fingerprint", "least", "n").join(roots, F.col("fingerprint") == F.col("node"), "left")
              .select("fingerprint", "least", "n", F.coalesce("root", "fingerprint").alias("root")))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    named = rooted.join(groups, "root").select("fingerprint", "component_id", "component_size", "root")
    kept = [c for c in prints.columns if c not in ("doc_id", "bits", "ones", "fingerprint")]
    return prints.join(named, "fingerprint").select(
        "doc_id", *kept, "fingerprint", "component_id", "component_size", F.col("root").alias("component"))


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, lanes: int = 1,
                         id_col: str = "doc_id", text_col: str = "text", distinct: bool = False) -> DataFrame:
    """``docs`` with one row of each component, all columns: the one with the smallest id, null ids last.

    Of rows with equal ids the first by place stays. Cases as in :func:`near_duplicates`.
    """
    rows, number = numbered(docs)
    found = near_duplicates(rows, radius, shingle, lanes, id_col, text_col, None, F.col(number),
                            distinct=distinct).where("component_size > 1")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(number).alias("row"))
    best = found.groupBy("component").agg(F.min(place)["row"].alias("best"))
    gone = found.join(best, "component").where(F.col(number) != F.col("best")).select(number)
    return rows.join(gone, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def radius_of(similarity: float, lanes: int, slack: float = 2.0) -> int:
    """The radius for a Jaccard similarity of shingle sets of like size.

    Two such sets at similarity J have a cosine of 2J / (1 + J), and each bit differs with the angle's share of a half
    turn. ``slack`` standard deviations are added, so that pairs at the limit are found.
    """
    n = 64 * lanes
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(n * p + slack * math.sqrt(n * p * (1 - p)))
