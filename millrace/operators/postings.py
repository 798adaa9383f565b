"""Postings of words as bitmaps over ranges of document ids, and documents that hold several words.

A range has 32,768 ids. A word in more than ``FEW`` documents of a range has a bitmap there, one in fewer a list of their places.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_fields
from ..session import bucketed
from .textjobs import document_words

# Fixed value: the ids of one bitmap, as a power of two.
RANGE_BITS = 15
FEW = 64


def build(df: DataFrame, doc: str, text: str, tokens: Callable[[Column], Column] = split_fields, few: int = FEW) -> DataFrame:
    """(word, range, n, places, bitmap): one of places, a sorted list of short numbers, and bitmap is null.

    Ids are not negative. The pairs of word and document are moved once, into buckets by word and range.
    """
    pairs = document_words(df.where(F.col(doc).isNotNull()), doc, text, tokens)
    checked = F.when(F.col("doc") >= 0, F.col("doc")).otherwise(
        F.raise_error(F.concat(F.lit("a negative document id: "), F.col("doc").cast("string"))).cast("long"))
    cells = bucketed(pairs.select("word", F.shiftright(checked.cast("long"), RANGE_BITS).alias("range"),
                                  F.col("doc").cast("long").bitwiseAND(F.lit((1 << RANGE_BITS) - 1)).cast("int").alias("place"))
                     .repartition("word", "range"), "postings", ["word", "range"])
    # One pass over the cells: a range holds at most 2**RANGE_BITS places, so its set is bounded.
    both = cells.groupBy("word", "range").agg(
        F.array_sort(F.collect_set(F.col("place").cast("short"))).alias("places"),
        F.bitmap_construct_agg(F.col("place").cast("long")).alias("bitmap"))
    n = F.size("places").cast("long")
    return both.select("word", "range", n.alias("n"), F.when(n <= few, F.col("places")).alias("places"),
                       F.when(n > few, F.col("bitmap")).alias("bitmap"))


def _bits(bitmap: Column) -> Column:
    """The places of the bits set, from the bytes that have one."""
    size = (1 << RANGE_BITS) // 8
    byte = lambda i: F.conv(F.hex(F.substring(bitmap, i + 1, F.lit(1))), 16, 10).cast("int")
    used = F.filter(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.struct(i.alias("i"), byte(i).alias("b"))),
                    lambda s: s["b"] != 0)
    one = lambda s: F.transform(F.filter(F.sequence(F.lit(0), F.lit(7)), lambda k: F.getbit(s["b"], k) == 1),
                                lambda k: s["i"] * 8 + k)
    return F.flatten(F.transform(used, one))


def documents_with_all(index: DataFrame, queries: dict[str, Sequence[str]]) -> DataFrame:
    """(query, doc): the documents that hold every word of a query. A query without words has none.

    Bitmaps are intersected per range; only the ranges in which all words of a query occur are opened.
    """
    spark = index.sparkSession
    rows = [(name, word, len(set(words))) for name, words in queries.items() for word in set(words)]
    asked = spark.createDataFrame(rows, "query string, word string, size int")
    # The words that were asked for, given by the caller.
    found = index.join(F.broadcast(asked), "word")
    lists = (found.where("bitmap IS NULL").select("query", "size", "word", "range", F.explode("places").alias("place"))
             .groupBy("query", "size", "word", "range").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bitmap")))
    maps = found.where("bitmap IS NOT NULL").select("query", "size", "word", "range", "bitmap")
    met = lists.unionByName(maps).groupBy("query", "size", "range").agg(
        F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("words"))
    whole = met.where((F.col("words") == F.col("size")) & (F.bitmap_count("bitmap") > 0))
    first = F.shiftleft(F.col("range").cast("long"), RANGE_BITS)
    return whole.select("query", first.alias("first"), F.explode(_bits(F.col("bitmap"))).alias("place")).select(
        "query", (F.col("first") + F.col("place")).alias("doc"))


