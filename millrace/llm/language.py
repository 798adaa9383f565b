"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import remove_scratch, write_step
from .common import bounded_sample, most_frequent, slices

# Documents to fit on.
FIT_DOCUMENTS = 12_000
LONGEST = 4
UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")
_SMOOTH = 0.5


@dataclass
class LanguageModel:
    """Languages, the row of each word (n = 0) and n-gram, and rows of log frequencies by language."""

    languages: list[str]
    rows: list[dict[str, int]]
    table: np.ndarray

    def found(self, word: str) -> list[int]:
        """The row of a known word, else the rows of its longest known n-grams; none if it has none."""
        row = self.rows[0].get(word)
        if row is not None:
            return [row]
        padded = f"_{word}_"
        for n in range(LONGEST, 0, -1):
            get = self.rows[n].get
            rows = [r for g in _grams(padded, n) if (r := get(g)) is not None]
            if rows:
                return rows
        return []

    def scores(self, chunks: list[list[str]]) -> np.ndarray:
        """For each list of words the sum over words of the mean of their rows."""
        rows, owner, weight = [], [], []
        for i, words in enumerate(chunks):
            for word in words:
                found = self.found(word)
                if found:
                    rows += found
                    owner += [i] * len(found)
                    weight += [1 / len(found)] * len(found)
        out = np.zeros((len(chunks), len(self.languages)))
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(owner, self.table[rows, k] * weight, len(chunks)) if rows else 0
        return out


def _grams(padded: str, n: int) -> list[str]:
    return [padded[i:i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(padded[1:-1])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in slices(batch, "text"):
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(langs[first:], texts):
                words[lang].update(_LETTERS.findall((text or "").lower()))
            rows = []
            for lang, counts in words.items():
                grams: Counter = Counter()
                for word, times in counts.items():
                    for n in range(1, LONGEST + 1):
                        for gram in _grams(f"_{word}_", n):
                            grams[n, gram] += times
                rows += [(lang, 0, w, c) for w, c in counts.items()] + [(lang, n, g, c) for (n, g), c in grams.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.int64()))],
                    ["lang", "n", "entry", "times"])


def fit(train: DataFrame, documents: int = FIT_DOCUMENTS, entries: int | None = None, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on at most ``documents`` rows of ``train`` with a language; rows without one are left out.

    All words and n-grams of those rows are kept, unless ``entries`` bounds them to the most frequent ones. Log frequencies are made
    on the executors, a row for each entry with a column for each language. Without rows the model knows no language.
    """
    rows = train.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counted, path = write_step(
        bounded_sample(rows, documents, "id").select("lang", "text")
        .mapInArrow(_counts, "lang string, n int, entry string, times long")
        .groupBy("lang", "n", "entry").agg(F.sum("times").alias("times")), "language")
    if entries is not None:
        counted = most_frequent(counted, entries, "times")
    totals: dict = defaultdict(Counter)
    for r in counted.groupBy("lang", "n").agg(F.sum("times").alias("times")).collect():  # a row per language and n
        totals[r["n"]][r["lang"]] = r["times"]
    languages = sorted(totals[0])
    if not languages:
        return LanguageModel([], [{} for _ in range(LONGEST + 1)], np.zeros((0, 0)))
    size = {r["n"]: r["entries"] for r in counted.groupBy("n").agg(F.count_distinct("entry").alias("entries")).collect()}
    pick = lambda by_n: F.element_at(F.array(*[F.lit(float(by_n(n))) for n in range(LONGEST + 1)]), F.col("n") + 1)
    table = counted.groupBy("n", "entry").agg(*[
        F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("times"))), F.lit(0)).alias(f"l{i}") for i, x in enumerate(languages)])
    logs = [F.log((F.col(f"l{i}") + _SMOOTH) / pick(lambda n, x=x: totals[n][x] + _SMOOTH * size.get(n, 0))).alias(f"l{i}")
            for i, x in enumerate(languages)]
    # The words and n-grams of the sample, which ``documents`` bounds.
    found = table.select("n", "entry", *logs).toArrow()
    remove_scratch(train.sparkSession, path)
    known: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    for row, (n, entry) in enumerate(zip(found.column("n").to_pylist(), found.column("entry").to_pylist())):
        known[n][entry] = row
    columns = [found.column(f"l{i}").to_numpy() for i in range(len(languages))]
    return LanguageModel(languages, known, np.stack(columns, 1).astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
            *extra: Column, with_text: bool = False) -> DataFrame:
    """doc_id, the ``extra`` columns, lang_pred string and score double of every whole text; ``with_text``, text too, moved once.

    ``score`` is the share of the likelihood that the best language has. A null text, one
    without letters, and any text under a model without languages are ``und`` with score 0. Ties go to the first language
    by name. Null and repeated ids are rows like others; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.rows, model.table))  # plain data
    rows = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("text"))
    kept = [f for f in rows.schema if with_text or f.name != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*sent.value)
        wide = len(model.languages)
        numbers, table = Numbers(), np.zeros((0, wide), np.float32)
        letters = np.zeros(0, bool)

        def words(chunk: str) -> list[str]:
            return [chunk.lower()] if chunk.isalpha() else _LETTERS.findall(chunk.lower())

        for batch in batches:
            for first, texts in slices(batch, "text"):
                names, scores = [], []
                if len(numbers) > 150_000:
                    numbers, table, letters = Numbers(), np.zeros((0, wide), np.float32), np.zeros(0, bool)
                places = [np.fromiter(map(numbers.__getitem__, t.split() if t else ()), np.int64) for t in texts]
                if numbers.new:
                    found = [words(c) for c in numbers.new]
                    letters = np.concatenate([letters, [bool(w) for w in found]])
                    table = np.concatenate([table, model.scores(found).astype(np.float32)])
                    numbers.new = []
                for place in places:
                    if not wide or not len(place) or not letters[place].any():
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    total = table[place].sum(0, dtype=np.float64)
                    best = int(total.argmax())
                    names.append(model.languages[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f.name).slice(first, len(texts)) for f in kept]
                    + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    [*(f.name for f in kept), "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return rows.mapInArrow(work, ", ".join([*fields, "lang_pred string, score double"]))


class Numbers(dict):
    """Numbers keys in the order they are first seen, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4. The rows with remainder 2 are held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             *extra: Column, with_text: bool = False) -> DataFrame:
    """Fit on the rows that are not held out, predict all: doc_id, held_out, extra columns, lang_pred, score.

    A row with a null id is neither learned from nor held out. Cases as in :func:`predict`.
    """
    model = fit(docs.where(remainder(F.col(id_col)) != 2), id_col=id_col, text_col=text_col, lang_col=lang_col)
    held = F.coalesce(remainder(F.col(id_col)) == 2, F.lit(False)).alias("held_out")
    return predict(docs, model, id_col, text_col, held, *extra, with_text=with_text)
