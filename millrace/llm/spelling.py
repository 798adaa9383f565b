"""Spelling variants by PartEnum signatures on letter multisets.

A word's letters are a binary vector with one dimension per letter and occurrence: "anna" has a1, a2, n1, n2. One
replaced code point changes two dimensions, one inserted or deleted code point one. The dimensions are partitioned
by a hash into ``PARTS`` parts; vectors that differ in d dimensions are equal on all but d parts, so every choice of
PARTS - d parts is enumerated, and its projection is a signature. Words of equal length are compared by choices that leave out two
parts, words whose lengths differ by one by choices that leave out one. Signatures are joined on equality, and pairs verified.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, remove_scratch, scratch_path
from .common import Memo, ascii_lower

# Words count from so many code points and so many occurrences on; a form is so many times as frequent.
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
# Parts of the dimensions.
PARTS = 7
# Signatures of more words than this are told apart by the words' equal halves too.
CROWD = 200
# The letters of a word after A-Z are lower-cased.
LETTERS = "[a-z\\u00C0-\\u00FF]+"
# One of so many runs loses a code point.
LOSS = 199


def runs_with_losses(id_col: str, run: Column) -> Column:
    """``run`` without its code point h % length where h, the crc32 of "id:run", is divisible by LOSS."""
    h = F.crc32(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % LOSS == 0, less).otherwise(run)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
                least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the runs of letters, A-Z lower-cased, after losses, of at least ``least_chars`` code points."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(
        ascii_lower(F.col(text_col)), F.lit(LETTERS), F.lit(0))).alias("run")).where(F.length("run") >= least_chars)
    words = runs.select(runs_with_losses("id", F.col("run")).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _part_of(dimension: tuple[str, int], parts: int) -> int:
    return zlib.crc32(f"{dimension[0]}{dimension[1]}".encode()) * parts >> 32


def signatures(word: str, parts: int, part_of: Callable) -> list[tuple[int, int, int]]:
    """(kind, length, hash) of a word's signatures.

    Kind 0: as a word of equal length. Kinds 1 and 2: as the longer and the shorter of two words; ``length`` is the longer one's.
    """
    held: list[list[str]] = [[] for _ in range(parts)]
    for letter, n in sorted(Counter(word).items()):
        for i in range(n):
            held[part_of[letter, i]].append(letter)
    projections = ["".join(p) for p in held]
    n, found = len(word), []
    for left_out, kinds in ((2, ((0, n),)), (1, ((1, n), (2, n + 1)))):
        for choice in itertools.combinations(range(parts), parts - left_out):
            key = "\0".join([*map(str, choice), *(projections[p] for p in choice)])
            found += [(kind, length, xxhash.xxh64_intdigest(key, length * 2 + min(kind, 1)) - 2**63) for kind, length in kinds]
    return found


def _signature_rows(parts: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_of = Memo(lambda dimension: _part_of(dimension, parts))
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                rows = [signatures(w, parts, part_of) for w in part.column("word").to_pylist()]
                owner = pa.array(np.repeat(np.arange(len(rows)), [len(r) for r in rows]))
                kind, length, sig = zip(*itertools.chain.from_iterable(rows)) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([
                    part.column("word").take(owner), part.column("n").take(owner), pa.array(kind, pa.int32()),
                    pa.array(length, pa.int32()), pa.array(sig, pa.int64())], ["word", "n", "kind", "length", "sig"])

    return work


def _halves(kind: Column, length: Column, word: Column) -> Column:
    """The two halves of a word of which one at least equals that of a near word.

    ``length`` is that of the longer word of the pair. The change lies behind the first half of the longer word, or else what
    follows that half is equal in both.
    """
    half = (length / 2).cast("int")
    return F.array(F.struct(F.lit(1).alias("side"), F.substring(word, F.lit(1), half).alias("half")),
                   F.struct(F.lit(2).alias("side"), F.right(word, length - half).alias("half")))


def near_pairs(words: DataFrame, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """Pairs of words that differ by one inserted, deleted or replaced code point, each once: a, b, a_n, b_n.

    ``words`` has word (distinct) and n. Signatures that more than ``crowd`` words share are compared within equal halves only,
    which near words have by nature, so no pair is lost.
    """
    # Few bytes of words make much work.
    spread = words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sigs = cut_lineage(spread.select("word", "n").mapInArrow(
        _signature_rows(parts), "word string, n long, kind int, length int, sig long"), "signatures")
    counts = sigs.groupBy("sig").agg(F.count("*").alias("members"))
    crowded = counts.where(F.col("members") > crowd).select("sig", F.lit(True).alias("crowded"))
    marked = sigs.join(crowded, "sig", "left")
    whole = F.array(F.struct(F.lit(0).alias("side"), F.lit("").alias("half")))
    keyed = marked.withColumn("h", F.explode(F.when(F.col("crowded"), _halves(F.col("kind"), F.col("length"), F.col("word")))
                                             .otherwise(whole))).select("word", "n", "kind", "length", "sig", "h.side", "h.half")
    side = lambda at, kinds: keyed.where(F.col("kind").isin(kinds)).select(
        "sig", "side", "half", F.col("kind").alias(f"{at}_kind"), F.col("word").alias(at), F.col("n").alias(f"{at}_n"))
    pairs = side("a", [0, 1]).hint("merge").join(side("b", [0, 2]), ["sig", "side", "half"])
    pairs = pairs.where(((F.col("a_kind") == 0) & (F.col("b_kind") == 0) & (F.col("a") < F.col("b")))
                        | ((F.col("a_kind") == 1) & (F.col("b_kind") == 2)))
    return pairs.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "a_n", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last form reached from each word of ``forms`` (word, form). Each round doubles the steps."""
    spark = forms.sparkSession
    path = scratch_path(spark, "roots")
    forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")).write.parquet(path)
    steps = spark.read.parquet(path)
    while not steps.where("moved").isEmpty():
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = steps.join(ahead, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        old, path = path, scratch_path(spark, "roots")
        moved.write.parquet(path)
        remove_scratch(spark, old)
        steps = spark.read.parquet(path)
    return steps.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS,
             least_count: int = LEAST_COUNT, ratio: int = RATIO, parts: int = PARTS, crowd: int = CROWD) -> DataFrame:
    """One row per word: word, form, root, n, n_near and form_n.

    Words are the maximal runs of a-z and U+00C0 to U+00FF after A-Z are lower-cased, of at least ``least_chars`` code points and
    ``least_count`` occurrences (n), after one run in 199 of a document lost a code point. Words are near if they
    differ by one inserted, deleted or replaced code point. A word's form is its near word of largest n (ties: the
    smallest in code-point order) if that is at least ``ratio`` times its own, else null; root follows forms to the last.

    Null and empty texts have no words; a null id counts as empty text in the hash. Rows with equal ids are counted each, and
    repeated rows again. A text and a word may have any length. Other columns are not read; an empty table gives no rows.
    """
    words = cut_lineage(count_words(docs, id_col, text_col, least_chars, least_count), "words")
    pairs = cut_lineage(near_pairs(words, parts, crowd), "near")
    both = pairs.union(pairs.select("b", "a", "b_n", "a_n"))
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("rank"), F.col("b").alias("form"))).alias("best"))
    told = cut_lineage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.rank")).alias("best_n"), F.col("best.form").alias("best"))
        .withColumn("known", F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))), "forms")
    ends = roots(told.where("known").select("word", F.col("best").alias("form")))
    return told.join(ends, "word", "left").select(
        "word", F.when(F.col("known"), F.col("best")).alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.when(F.col("known"), F.col("best_n")).alias("form_n"))
