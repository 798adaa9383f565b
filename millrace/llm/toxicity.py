"""Toxicity by cumulative-link ordinal regression over sparse word features."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_scratch, write_step
from .common import Memo, bounded_sample, slices

# Labelled rows to fit on.
FIT_ROWS = 6_000
PREFIXES = (4, 5, 6, 7)
# Rows of the sample that a feature must be in to be a witness of anything.
LEAST_ROWS = 5
# Minimum hashes over runs of three words, by which copies are known.
HASHES = 6
RIDGE, STEPS = 0.1, 40
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class OrdinalModel:
    """P(grade >= k) = logistic(weights . features - thresholds[k - 1]); weights of other features are 0."""

    weights: dict[int, float]
    thresholds: list[float]

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k), a column for each k from 1."""
        return _logistic(scores[:, None] - np.array(self.thresholds)[None])


def _logistic(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _feature(word: str) -> int:
    return xxhash.xxh64_intdigest(word) - 2**63


def strength_of_chance(features: int) -> float:
    """The strength that chance gives none of so many features."""
    return (2 * np.log(max(features, 2))) ** 0.5


def _parts(text: str) -> list[str]:
    """The features of a text: lower-case words, and the beginnings of longer ones, which inflections share."""
    words = _WORDS.findall(text.lower())
    return words + [w[:n] + "_" for w in words for n in PREFIXES if len(w) > n]


def _value(times: int | np.ndarray):
    return 1 + np.log(times)


def _marks(text: str) -> list[int]:
    words = text.split()
    runs = np.array([zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))], np.uint64)
    return [int((runs * np.uint64(odd) % np.uint64(1 << 32)).min()) for odd in range(0x9E3779B1, 0x9E3779B1 + 2 * HASHES, 2)]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature numbers, their counts and the marks of each row."""
    for batch in batches:
        for first, texts in slices(batch, "text"):
            columns, values, marks = [], [], []
            for text in texts:
                marks.append(_marks(text or ""))
                counts: Counter = Counter()
                for word, times in Counter(_parts(text or "")).items():
                    counts[_feature(word)] += times
                columns.append(list(counts))
                values.append(list(counts.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(first, len(texts)), batch.column("grade").slice(first, len(texts)),
                 pa.array(columns, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.int32())),
                 pa.array(marks, pa.list_(pa.int64()))], ["row", "grade", "features", "counts", "marks"])


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_grades: int,
                ridge: float = RIDGE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the least negative log likelihood plus ``ridge`` / 2 times the weights' squares.

    All thresholds share the weights. Newton steps, by turns over the weights, solved by conjugate gradients on the sparse
    features, and over each threshold.
    """
    n, width = len(grades), int(columns.max()) + 1 if len(columns) else 0
    share = np.array([(grades >= k).mean() for k in range(1, n_grades)]).clip(1e-4, 1 - 1e-4)
    cuts = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(n_grades - 1))
    weights = np.zeros(width)

    def times(v: np.ndarray) -> np.ndarray:
        return np.bincount(rows, values * v[columns], n)

    def back(u: np.ndarray) -> np.ndarray:
        return np.bincount(columns, values * u[rows], width)

    def solved(curve: np.ndarray, pull: np.ndarray) -> np.ndarray:
        """The step for which (X' curve X + ridge) step = pull."""
        step, rest = np.zeros(width), pull.copy()
        way, size = rest.copy(), rest @ rest
        least = 1e-18 * size
        for _ in range(10 * width):
            if size <= least:
                break
            bent = back(curve * times(way)) + ridge * way
            by = size / (way @ bent)
            step, rest = step + by * way, rest - by * bent
            size, old = rest @ rest, size
            way = rest + size / old * way
        return step

    def sides(cuts: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.concatenate([[-np.inf], cuts, [np.inf]])
        return _logistic(edge[grades + 1] - score), _logistic(edge[grades] - score)

    for _ in range(steps):
        above, below = sides(cuts, times(weights))  # a row's likelihood is above - below
        curve = above * (1 - above) + below * (1 - below)
        if width:
            step = solved(curve, back(above + below - 1) - ridge * weights)
            weights = weights + step * min(1, 2 / max(np.abs(step).max(), 1e-12))
        score = times(weights)
        for k in range(1, n_grades):
            above, below = sides(cuts, score)
            chance = np.maximum(above - below, 1e-12)
            up, down = (above * (1 - above) / chance)[grades == k - 1], (below * (1 - below) / chance)[grades == k]
            slope = up.sum() - down.sum() - 1e-3 * cuts[k - 1]
            move = slope / max((up * up).sum() + (down * down).sum(), 1e-3)
            cuts[k - 1] += np.clip(move, -1, 1)
        cuts = np.maximum.accumulate(cuts + 1e-6 * np.arange(len(cuts)))
    return weights, cuts


def _residuals(share: np.ndarray) -> np.ndarray:
    """The slope of a row's log likelihood by its grade, under the ordinal model without features; mean 0."""
    at_least = np.concatenate([np.cumsum(share[::-1])[::-1], [0.0]])
    slope = at_least[:-1] + at_least[1:] - 1
    return (slope * share).sum() - slope


def telling(rows: np.ndarray, columns: np.ndarray, residual: np.ndarray, marks: np.ndarray, least: float) -> np.ndarray:
    """The columns whose presence goes with higher or lower grades by a strength above ``least``.

    The score test of the ordinal model without features. Copies count as one witness: rows that
    agree in a mark are taken as wholly dependent, and of several marks the one that gives the
    widest spread holds.
    """
    width = int(columns.max()) + 1 if len(columns) else 0
    sums, spread = np.bincount(columns, residual[rows], width), np.zeros(width)
    for mark in marks.T:
        group = np.unique(mark, return_inverse=True)[1]
        cells, size = np.unique(group[rows] * width + columns, return_counts=True)
        spread = np.maximum(spread, np.sqrt(np.bincount(cells % width, size.astype(float) ** 2, width)))
    strength = np.abs(sums) / (spread * residual.std() + 1e-12)
    return np.flatnonzero(strength > least)


def fit(rows: DataFrame, n_grades: int, severe_from: int | None = None, most: int = FIT_ROWS, id_col: str = "doc_id",
        text_col: str = "text", grade_col: str = "grade") -> OrdinalModel:
    """Fit on at most ``most`` rows with a grade 0 .. n_grades - 1; rows with another or no grade are left out.

    Features are found and first tested on the executors; only strong ones come to the driver, which tests
    them again with copies in mind and fits over all :func:`telling` ones, beyond what chance gives the best of all that were found. With ``severe_from``, the highest grade given is
    parted in two: rows where telling features occur that often are one grade higher. Without rows every text has grade 0.
    """
    graded = rows.where(F.col(grade_col).between(0, n_grades - 1)).select(
        F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade"), F.col(text_col).alias("text"))
    sample = bounded_sample(graded, most, "id").select(
        F.monotonically_increasing_id().alias("row"), "grade", "text").mapInArrow(
        _features, "row long, grade int, features array<long>, counts array<int>, marks array<long>")
    sample, path = write_step(sample, "labelled")  # its row numbers are those of one reading
    labels = sample.select("row", "grade", "marks").orderBy("row").toPandas()
    n = len(labels)
    if not n:
        return OrdinalModel({}, [np.inf] * (n_grades - 1 + bool(severe_from)))
    grades = labels["grade"].to_numpy(np.int64)
    by_grade = _residuals(np.bincount(grades, minlength=n_grades) / n)
    residual, marks = by_grade[grades], np.stack(labels["marks"].to_numpy())
    pairs = sample.select("row", "grade", F.explode(F.arrays_zip("features", "counts")).alias("f")).select(
        "row", F.get(F.array(*map(F.lit, by_grade.tolist())), F.col("grade")).alias("residual"),
        F.col("f.features").alias("feature"), F.col("f.counts").alias("times"))
    spread = F.sqrt(F.col("n") * (1 - F.col("n") / n)) * float(residual.std()) + 1e-12
    found = cut_lineage(pairs.groupBy("feature").agg(F.count("*").alias("n"), F.sum("residual").alias("sum")), "features")
    least = strength_of_chance(found.count())
    strong = found.where((F.col("n") >= LEAST_ROWS) & (F.abs("sum") / spread > least)).select("feature")
    used = pairs.join(strong, "feature").select("row", "feature", "times").toPandas()  # features of the sample, which ``most`` bounds
    remove_scratch(rows.sparkSession, path)
    at = np.searchsorted(labels["row"].to_numpy(), used["row"].to_numpy())
    kept, columns = np.unique(used["feature"].to_numpy(np.int64), return_inverse=True)
    best = telling(at, columns, residual, marks, least)
    here = np.isin(columns, best)
    times = used["times"].to_numpy(np.float64)[here]
    if severe_from:
        severe = np.bincount(at[here], times, n) >= severe_from
        grades = grades + ((grades == n_grades - 1) & severe)
        n_grades += 1
    weights, cuts = fit_ordinal(at[here], np.searchsorted(best, columns[here]), _value(times), grades, n_grades)
    return OrdinalModel({int(f): float(w) for f, w in zip(kept[best], weights) if w}, cuts.tolist())


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity double, grade int, toxic_score double and toxic boolean of every whole text.

    ``severity`` is the expected grade, ``grade`` the likeliest (the lower of equal ones), ``toxic_score`` the chance of
    grade 1 or more and ``toxic`` whether that is a half or more. Null text counts as empty. Null and
    repeated ids are rows like others. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # plain data
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = OrdinalModel(*sent.value)

        def weighty(chunk: str) -> tuple[int, ...]:
            return tuple(f for w in _parts(chunk) if (f := _feature(w)) in model.weights)

        chunks = Memo(weighty)
        for batch in batches:
            for first, texts in slices(batch, "text"):
                scores = np.zeros(len(texts))
                for i, text in enumerate(texts):
                    hits = [h for c in (text or "").split() if (h := chunks[c])]
                    counts = Counter(f for h in hits for f in h)
                    scores[i] = sum(model.weights[f] * _value(t) for f, t in counts.items())
                above = model.grades(scores)
                each = -np.diff(np.concatenate([np.ones((len(texts), 1)), above, np.zeros((len(texts), 1))], 1), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(texts)), pa.array(above.sum(1)),
                     pa.array(each.argmax(1).astype(np.int32)), pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)],
                    ["doc_id", "severity", "grade", "toxic_score", "toxic"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, severity double, grade int, toxic_score double, toxic boolean")


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, text, grade of at most ``most`` labels (doc_id, grade); that bound is what is broadcast.

    Null ids have no label. A document with several labels, or a label with several documents, is several rows.
    """
    graded = labels.where(F.col("grade").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "grade")
    few = bounded_sample(graded, most, "doc_id")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(few), "doc_id")
