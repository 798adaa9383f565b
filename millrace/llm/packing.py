"""Packing of tokenised documents into sequences by best-two-fit."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import Memo, slices

CAPACITY = 4096
END_ID = 1
# Pieces of one length that are ranked in one group; a more frequent length has several.
RANK_ROWS = 250_000

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
# The word pattern of the tokenizer, for text below U+0250, where lower-casing and
# normalisation go character by character.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
_ODD = re.compile(r"[^\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-ɏ]|<\|")


class WordTokenizer:
    """Ids of a text as little-endian bytes, for a BPE with word ends that drops white space.

    No token spans a space or a line feed, so a text is cut there and its chunks are looked up.
    Unseen chunks of plain letters are merged word by word, all others by the library.
    """

    def __init__(self, spec: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        model = json.loads(spec)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = _byte_symbols()
        # A word end becomes byte 0xFF, which no UTF-8 text has; a byte joins its word end first of all.
        code = lambda t: (bytes(symbols[c] for c in t[:-len(end)]) + b"\xff" if t.endswith(end)
                          else bytes(symbols[c] for c in t))
        single = [bytes([b]) for b in range(256)]
        ended = [bytes([b, 255]) for b in range(255)]
        merged = [code(a + b) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        ranks: dict[bytes, int] = {}
        for token in [*single, *ended, *merged]:
            ranks.setdefault(token, len(ranks))
        self.merge = tiktoken.Encoding("word", pat_str=".", mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece
        self.ids = [b"\0\0\0\0"] * len(ranks)
        for token, number in vocab.items():
            if (token_bytes := code(token)) in ranks:
                self.ids[ranks[token_bytes]] = number.to_bytes(4, "little")
        self.chunks = Memo(self._chunk)
        self.chunks[""] = b""

    def _chunk(self, chunk: str) -> bytes:
        if _ODD.search(chunk):
            return np.array(self.library.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        ids, merge, chunk = self.ids, self.merge, chunk.lower()
        words = (chunk,) if chunk.isalpha() else _WORDS.findall(chunk)
        return b"".join([ids[r] for word in words for r in merge(word.encode() + b"\xff")])

    def encode(self, text: str) -> bytes:
        chunks = self.chunks
        return b"".join([chunks[c] for c in text.replace("\n", " ").split(" ")])


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece int, start long, length long, ids_crc32 long, ids binary.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut into pieces of
    ``capacity`` ids, the last of which may be shorter. ``ids`` are little-endian unsigned 32-bit numbers.
    ``tokenizer`` is the JSON text of the tokenizer, sent to the executors once.
    """
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer)
    width, ending = 4 * capacity, b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = WordTokenizer(spec.value)
        for batch in batches:
            for first, texts in slices(batch, "text"):
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, text in enumerate(texts, first):
                    coded = encoder.encode(text or "") + ending
                    for k, at in enumerate(range(0, len(coded), width)):
                        part = coded[at:at + width]
                        rows.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        ids.append(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, PIECES.format(id=kind) + ", ids binary")


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Best-two-fit over a histogram of lengths: (lengths in a bin, number of such bins).

    A bin is filled greedily, each time with the longest length that still fits. Then its smallest
    document gives way to the two unpacked documents that fill the gap it leaves most
    tightly, if they fill it better than before. The choice depends only on which lengths are left, so
    the bin is repeated as often as its lengths allow. Work and result are bounded by the
    number of lengths, not of documents.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} is not in 1..{capacity}")
        left[length] = n
    bins: list[tuple[list[int], int]] = []
    while (present := np.flatnonzero(left)).size:
        fill: list[int] = []
        gap, used = capacity, np.zeros(capacity + 1, np.int64)
        while gap:
            fits = present[present <= gap]
            fits = fits[left[fits] > used[fits]]
            if not fits.size:
                break
            length = int(fits[-1])
            n = int(min(gap // length, left[length] - used[length]))
            fill += [length] * n
            used[length] += n
            gap -= n * length
        if gap and len(fill) > 1:
            smallest = fill[-1]
            room = gap + smallest
            free = present[left[present] > used[present]]
            pair = _best_pair(free, left - used, room)
            if pair and sum(pair) > smallest:
                fill[-1:] = pair
                used[smallest] -= 1
                for length in pair:
                    used[length] += 1
        lengths = np.flatnonzero(used)
        times = int((left[lengths] // used[lengths]).min())
        left[lengths] -= times * used[lengths]
        bins.append((sorted(fill, reverse=True), times))
    return bins


def _best_pair(free: np.ndarray, left: np.ndarray, room: int) -> list[int] | None:
    """Two lengths of ``free`` with the largest sum up to ``room``."""
    first = free[free < room]
    if not first.size:
        return None
    at = np.searchsorted(free, room - first, side="right") - 1
    second = np.where(at >= 0, free[at], 0)
    alone = (second == first) & (left[first] < 2)  # the one document of a length pairs with a shorter one
    second = np.where(alone, np.where(at > 0, free[np.maximum(at - 1, 0)], 0), second)
    total = np.where((second > 0) & (at >= 0), first + second, 0)
    best = int(total.argmax())
    return [int(max(first[best], second[best])), int(min(first[best], second[best]))] if total[best] else None


def _places(bins: list[tuple[list[int], int]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """For each length, by rank: (first rank, bins, copies in a bin, first sequence, offset of the first)."""
    place: dict[int, list[tuple[int, int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for fill, times in bins:
        at = 0
        for length in sorted(set(fill), reverse=True):
            n, first = fill.count(length), ranks.get(length, 0)
            place.setdefault(length, []).append((first, times, n, sequence, at))
            ranks[length] = first + n * times
            at += n * length
        sequence += times
    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY, rank_rows: int = RANK_ROWS) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id long and offset long.

    Only the histogram of lengths, at most ``capacity`` rows, goes to the driver, which plans the bins;
    the plan is as bounded. Each piece finds its place by its rank among pieces of its length. Ranks
    are counted in parts of about ``rank_rows`` pieces of a length, so that a length that a third of all pieces have is
    no single group, whatever their number. Which of two pieces of one length goes where is settled by id and piece.
    Sequences have no gap and no piece is left out. No rows give no rows.
    """
    spark = pieces.sparkSession
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    place = spark.sparkContext.broadcast(_places(plan_bins(totals, capacity)))
    # A row per length, at most ``capacity``.
    parts = spark.createDataFrame([(n, -(-m // rank_rows)) for n, m in totals.items()], "length long, parts long")
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.col("parts"))).drop("parts")
    counts = dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
    below = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    starts = counts.select("length", "part", below.alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (dealt.withColumn("rank", F.row_number().over(order)).join(starts, ["length", "part"])
              .withColumn("rank", F.col("rank") - 1 + F.col("before")).drop("part", "before"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {n: np.array(rows, np.int64) for n, rows in place.value.items()}
        for batch in batches:
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                mine = lengths == length
                rows = table[int(length)]
                r = rows[np.searchsorted(rows[:, 0], ranks[mine], side="right") - 1]
                inside = ranks[mine] - r[:, 0]
                sequence[mine] = r[:, 3] + inside // r[:, 2]
                offset[mine] = r[:, 4] + inside % r[:, 2] * length
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)],
                [*kept, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(work, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: a document of the end id alone. Null and repeated ids are rows like
    others. An empty table gives no rows. Other columns are not read. The pieces are tokenised once and
    written without their ids; join :func:`token_pieces` for those.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).drop("ids")
    return pack(cut_lineage(pieces, "pieces"), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def read_spec(path: str) -> str:
    """The JSON text of a tokenizer file, read on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


