"""Byte-level BPE encoding and decoding through a minimal acyclic transducer of frequent words."""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_scratch, scratch_path, write_step
from .common import most_frequent, slices
from .packing import _byte_symbols

# Words in the automaton. It bounds the automaton, not what can be encoded.
LEXICON_WORDS = 50_000
# Fixed value: the pattern that cuts a text into words, of byte-level BPE vocabularies of this kind.
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# Chunks known at a time, and bytes of text encoded at a time.
KNOWN, ABREAST = 200_000, 2_000_000
# A chunk of letters and then ASCII signs is two words at most.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-&(-/:-@\[-`{-~]*)")


def words_of(chunk: str, lead: str = "") -> list[str]:
    """The words of the pattern in ``lead`` and a chunk."""
    if chunk.isascii() and chunk.isalpha():
        return [lead + chunk]
    simple = _SIMPLE.fullmatch(chunk)
    if not simple:
        return WORDS.findall(lead + chunk)
    return [lead + simple[1], simple[2]] if simple[2] else [lead + chunk]


class Merger:
    """The vocabulary of a byte-level BPE: exact merges, and the bytes of each id."""

    def __init__(self, spec: str):
        import tiktoken

        data = json.loads(spec)
        symbols = _byte_symbols()
        vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.token = {i: bytes(symbols[c] for c in t) for t, i in vocab.items()}
        self.token |= {i: t.encode() for t, i in self.special.items()}
        self.number = {b: i for i, b in self.token.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"])
        # Of the pairs in a word, the one merged first is the one whose merge has the lowest rank, the leftmost of equals.
        ranks = {bytes([i]): i for i in range(256)}
        for a, b in pairs:
            ranks.setdefault(bytes(symbols[c] for c in a + b), len(ranks))
        self.ids = [self.number[token].to_bytes(4, "little") for token in ranks]
        self.pieces = tiktoken.Encoding("byte", pat_str=".", mergeable_ranks=ranks,
                                        special_tokens={})._core_bpe.encode_single_piece
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def merge(self, word: bytes) -> bytes:
        """Little-endian 32-bit ids of one word by exact merges."""
        ids = self.ids
        return b"".join([ids[r] for r in self.pieces(word)])


class Automaton:
    """A minimal acyclic transducer from words to ids, in flat arrays.

    Words are added in sorted order; a state that can no longer change is replaced by an equal one,
    so that endings are shared. Each arc counts the words that end below its earlier
    siblings; their sum along a word is its number, which gives its ids.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.label, self.target, self.skip, self.final, self.starts, self.ids = (
            arrays[k] for k in ("label", "target", "skip", "final", "starts", "ids"))
        first = arrays["first"]
        self.root = int(arrays["root"][0])
        # Arcs are in order of state and byte, so an arc is found by search.
        self.keys = np.repeat(np.arange(len(first) - 1), np.diff(first)) * 256 + self.label

    def number(self, words: list[bytes]) -> np.ndarray:
        """The number of each word in the lexicon, -1 for others. All words walk abreast, a byte a step."""
        out = np.full(len(words), -1)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        at = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"".join(words), np.uint8)
        state, number, here = np.full(len(words), self.root), np.zeros(len(words), np.int64), np.arange(len(words))
        for step in range(int(sizes.max(initial=0)) + 1):
            done = sizes[here] == step
            ended = done & (self.final[state] == 1)
            out[here[ended]] = number[ended]
            here, state, number = here[~done], state[~done], number[~done]
            if not len(here) or not len(self.keys):
                break
            key = state * 256 + raw[at[here] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[arc] == key
            here, arc = here[known], arc[known]
            state, number = self.target[arc].astype(np.int64), number[known] + self.skip[arc]
        return out

    def get(self, word: bytes) -> bytes | None:
        """The ids of a word of the lexicon, else None."""
        n = int(self.number([word])[0])
        return self.ids[self.starts[n]:self.starts[n + 1]].tobytes() if n >= 0 else None

    @staticmethod
    def build(words: Iterable[tuple[bytes, bytes]]) -> dict[str, np.ndarray]:
        ordered = sorted(dict(words).items())
        known: dict[tuple, int] = {}
        states: list[tuple] = []

        def settle(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(states)
                states.append(key)
            return known[key]

        path: list[list] = [[False, []]]  # states of the latest word that can still change
        last = b""
        for word, _ in ordered:
            common = len(os.path.commonprefix([last, word]))
            for depth in range(len(last), common, -1):
                path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
            path += [[False, []] for _ in word[common:]]
            path[-1][0] = True
            last = word
        for depth in range(len(last), 0, -1):
            path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
        root = settle(path[0])
        below: list[int] = []
        first, label, target, skip = [0], [], [], []
        for final, arcs in states:  # a state comes after all it leads to
            count = int(final)
            for byte, to in arcs:
                label.append(byte)
                target.append(to)
                skip.append(count)
                count += below[to]
            below.append(count)
            first.append(len(label))
        starts = np.cumsum([0, *(len(ids) // 4 for _, ids in ordered)])
        return {"first": np.array(first, np.int32), "label": np.array(label, np.uint8),
                "target": np.array(target, np.int32), "skip": np.array(skip, np.int32),
                "final": np.array([s[0] for s in states], np.uint8), "starts": starts.astype(np.int32),
                "ids": np.frombuffer(b"".join(ids for _, ids in ordered), "<i4"), "root": np.array([root], np.int32)}

    @staticmethod
    def image(arrays: dict[str, np.ndarray]) -> bytes:
        """The content of a file to map: a line of names, types and lengths, then the arrays."""
        head = json.dumps([(k, v.dtype.str, len(v)) for k, v in arrays.items()]).encode()
        head += b" " * (-(len(head) + 1) % 8) + b"\n"
        return head + b"".join(v.tobytes() + b"\0" * (-v.nbytes % 8) for v in arrays.values())

    @classmethod
    def open(cls, path: str) -> Automaton:
        """Map the file; pages are read as words touch them and shared by the workers of a machine."""
        whole = np.memmap(path, np.uint8, "r")
        with open(path, "rb") as file:
            head = file.readline()
        at, arrays = len(head), {}
        for name, kind, n in json.loads(head):
            size = np.dtype(kind).itemsize * n
            arrays[name] = whole[at:at + size].view(kind)
            at += size + -size % 8
        return cls(arrays)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def chunk_counts(docs: DataFrame, text_col: str = "text", longest: int = 64) -> DataFrame:
    """chunk string, n long: how often each part between spaces occurs, over whole texts; parts over ``longest`` are no words."""
    chunks = docs.select(F.explode(F.split(F.col(text_col), " ")).alias("chunk"))
    return chunks.where(F.length("chunk").between(1, longest)).groupBy("chunk").agg(F.count("*").alias("n"))


def compile_lexicon(docs: DataFrame, tokenizer: str, text_col: str = "text", words: int = LEXICON_WORDS) -> str:
    """The automaton of at most ``words`` words, those of the most frequent chunks, sent to all executors; its file's name."""
    merger = Merger(tokenizer)
    counts, counted = write_step(chunk_counts(docs, text_col).where("n > 1"), "chunks")
    top = most_frequent(counts, words).collect()
    remove_scratch(docs.sparkSession, counted)
    found: Counter = Counter()
    for r in top:
        for word in words_of(r["chunk"], " "):
            found[word.encode()] += r["n"]
    arrays = Automaton.build((w, merger.merge(w)) for w, _ in found.most_common(words))
    spark = docs.sparkSession
    path = scratch_path(spark, "lexicon")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    file = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    file.write(bytearray(Automaton.image(arrays)))
    file.close()
    spark.sparkContext.addFile(path)  # each executor fetches its copy, a new one too
    return os.path.basename(path)


class Encoder:
    """Ids of texts: words of the automaton have theirs there, all others are merged.

    A text is cut at its single spaces, which no word spans. Chunks met before are looked up. A text with other white space beside
    its words is cut into words as a whole, which are looked up together.
    """

    def __init__(self, merger: Merger, lexicon: Automaton | None):
        self.merger, self.lexicon = merger, lexicon
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes | None] = {}
        self.signs = {c: merger.merge(c.encode()) for c in ".,;:!?"}

    def _learn(self, known: dict, chunks: set[str], lead: str) -> None:
        """Ids of new chunks. A chunk that white space or nothing stands at an end of has none after a space."""
        new = [c for c in chunks if not lead or c and not c[0].isspace() and not c[-1].isspace()]
        if lead:
            known.update(dict.fromkeys(chunks.difference(new)))
            # A sign after a letter is a word of its own, and the chunk without it may be known.
            signed = [c for c in new if c[-1] in ".,;:!?" and c[-2:-1].isalpha() and known.get(c[:-1])]
            for c in signed:
                known[c] = known[c[:-1]] + self.signs[c[-1]]
            new = list(set(new).difference(signed))
        words = [[w.encode() for w in words_of(c, lead)] for c in new]
        flat = [w for ws in words for w in ws]
        numbers = iter(self.lexicon.number(flat).tolist() if self.lexicon else [-1] * len(flat))
        merge = self.merger.merge
        if self.lexicon:
            starts, ids = self.lexicon.starts.tolist(), self.lexicon.ids.tobytes()
        for chunk, ws in zip(new, words):
            known[chunk] = b"".join([ids[4 * starts[n]:4 * starts[n + 1]] if n >= 0 else merge(w)
                                     for w, n in zip(ws, numbers)])

    def _of_words(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts that are cut into words: all of them walk the automaton together, and those that it lacks are merged."""
        words = list({w.encode() for ws in texts for w in ws})
        numbers = self.lexicon.number(words).tolist() if self.lexicon and words else [-1] * len(words)
        if self.lexicon:
            starts, ids = self.lexicon.starts.tolist(), self.lexicon.ids.tobytes()
        known = {w: ids[4 * starts[n]:4 * starts[n + 1]] if n >= 0 else self.merger.merge(w) for w, n in zip(words, numbers)}
        return [b"".join([known[w.encode()] for w in ws]) for ws in texts]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; the text of a special token is that token."""
        merger = self.merger
        special = merger.special
        cut = [[t] if not any(s in t for s in special) else [p for p in merger.cut.split(t) if p] for t in texts]
        parts = [[p if p in special else p.split(" ") for p in ps] for ps in cut]
        first, later = self.first, self.later
        if len(first) + len(later) > KNOWN:
            first.clear()
            later.clear()
        self._learn(first, {p[0] for ps in parts for p in ps if p.__class__ is list} - first.keys(), "")
        new = set().union(*(p[1:] for ps in parts for p in ps if p.__class__ is list)) - later.keys()
        bare = {c for c in new if c.isalpha()}
        self._learn(later, bare, " ")
        self._learn(later, new - bare, " ")
        out, loose = [], {}
        for pieces, ps in zip(cut, parts):
            done = []
            for text, p in zip(pieces, ps):
                if p.__class__ is not list:
                    done.append(special[p].to_bytes(4, "little"))
                    continue
                chunks = [later[c] for c in p[1:]]
                if None in chunks or len(p) > 1 and p[0][-1:].isspace():
                    loose[text] = None
                    done.append(text)
                else:
                    done.append(first[p[0]] + b"".join(chunks))
            out.append(done)
        loose = dict(zip(loose, self._of_words([WORDS.findall(t) for t in loose])))
        done = ([loose[d] if d.__class__ is str else d for d in ds] for ds in out)
        return [d[0] if len(d) == 1 else b"".join(d) for d in done]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def encode(docs: DataFrame, tokenizer: str, lexicon: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id and ids array<int> of every whole text.

    ``tokenizer`` is the JSON text of a byte-level BPE, ``lexicon`` the name :func:`compile_lexicon` gave; the
    result doesn't depend on the lexicon. Null text counts as empty and has no ids. Null and
    repeated ids are rows like others. An empty table gives no rows. Other columns are not read.
    """
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = Automaton.open(SparkFiles.get(lexicon)) if lexicon else None
        encoder = Encoder(Merger(spec.value), opened)
        for batch in batches:
            for first, texts in slices(batch, "text", ABREAST):
                coded = encoder.encode_all([t or "" for t in texts])
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(ends), values)],
                    ["doc_id", "ids"])

    rows = _rows(docs, id_col, text_col)
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (any columns, ids array<int>) with text string: the tokens' bytes read as UTF-8.

    Bytes that are no UTF-8 become U+FFFD. Null ids count as none. An unknown id is left out.
    """
    spec = encoded.sparkSession.sparkContext.broadcast(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = Merger(spec.value).token
        table = [token.get(i, b"") for i in range(max(token) + 1)]
        size = len(table)
        for batch in batches:
            column = batch.column("ids")
            texts = []
            for i in range(len(column)):
                ids = column[i].values
                numbers = ids.to_numpy(zero_copy_only=False).tolist() if ids is not None else []
                try:
                    raw = b"".join([table[n] for n in numbers])
                except IndexError:
                    raw = b"".join([table[n] for n in numbers if n < size])
                texts.append(raw.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, "text"])

    kept = [c for c in encoded.columns if c != "text"]
    rows = encoded.select(*[F.col(f"`{c}`") for c in kept])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(work, ", ".join([*fields, "text string"]))
