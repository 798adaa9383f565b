"""Document fingerprints: bottom-k sketches of shingle hashes. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, in_order_ranges, split_words

K = 128
SHINGLE = 5
# Hashes are 32 bits wide, so a shingle is 8 hexadecimal digits of a fingerprint.
SPACE = 2.0 ** 32
# Bytes of text in a range of ids.
RANGE_BYTES = 6_000_000


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hash of each run of ``shingle`` words, lower-cased for A-Z; of all words if there are fewer; none without words."""
    words = split_words(ascii_lower(text))

    def hashes(words: Column) -> Column:
        last = F.size(words) - F.lit(shingle)
        whole = F.array(F.shiftrightunsigned(F.xxhash64(words), 32))
        runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.shiftrightunsigned(
            F.xxhash64(*[F.get(words, i + F.lit(k)) for k in range(shingle)]), 32))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(last < 0, whole).otherwise(runs)

    # A transform over one element computes the words once.
    return F.element_at(F.transform(F.array(words), hashes), 1)


def sketch(hashes: Column, k: int = K) -> Column:
    """The ``k`` least distinct hashes, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together, from their sketches."""
    return sketch(F.concat(a, b), k)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    size = F.size(a)
    return F.when(size < k, size.cast("double")).otherwise(
        F.lit((k - 1) * SPACE) / (F.element_at(a, -1).cast("double") + 1))


def _merged(a: Column, b: Column, k: int, value: Callable[[Column], Column]) -> Column:
    """``value`` of the merged sketch, which a transform over one element computes once."""
    return F.element_at(F.transform(F.array(merge(a, b, k)), value), 1)


def _likeness(a: Column, b: Column, union: Column) -> Column:
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both.cast("double") / F.size(union))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both; 1 if both have none."""
    return _merged(a, b, k, lambda union: _likeness(a, b, union))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` has none."""
    common = _merged(a, b, k, lambda union: _likeness(a, b, union) * distinct_shingles(union, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(common / distinct_shingles(a, k), F.lit(1.0)))


def fingerprint(a: Column) -> Column:
    """A sketch as text: eight hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def sketches(docs: DataFrame, k: int = K, shingle: int = SHINGLE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, sketch array<long>, fingerprint string and shingles double (the estimated number).

    Null text counts as empty and has an empty sketch. Null and repeated ids are rows like others; an empty
    table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), sketch(shingle_hashes(text, shingle), k).alias("sketch"))
    return rows.select("doc_id", "sketch", fingerprint(F.col("sketch")).alias("fingerprint"),
                       distinct_shingles(F.col("sketch"), k).alias("shingles"))


def in_ranges(rows: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``rows`` (doc_id, text) in ranges of ids, by size, with range int, tie long and lent int.

    Each range is also given the greatest row of the range below (lent 1), the lowest range that of the highest (lent 2),
    so that the row before each of its own is there. Ranges are cut in order of id and the hash of the text, in which the rows
    of an id are ordered; null ids are below all others. Everything is told from the rows' content and the written cuts, so
    a repeated reading gives the same.
    """
    total = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    ranges = max(1, math.ceil(total / range_bytes))
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt, filled = in_order_ranges(keyed, "doc_id", "tie", ranges, "range")
    top = F.max_by(F.struct("doc_id", "text", "tie"), F.struct("doc_id", "tie")).alias("top")
    lent = dealt.groupBy("range").agg(top)
    if filled is None:
        lent = lent.select("top.*", "range", F.lit(2).alias("lent"))
    else:
        # One small row for each range.
        order = Window.orderBy("range")
        to = filled.select("range", F.coalesce(F.lead("range").over(order), F.first("range").over(
            order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("to"), F.lead("range").over(order).isNull().alias("last"))
        lent = lent.join(to, "range").select("top.*", F.col("to").alias("range"), F.when(F.col("last"), 2).otherwise(1).alias("lent"))
    return dealt.withColumn("lent", F.lit(0)).unionByName(lent)


def edited_texts(docs: DataFrame, k: int = K, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Each document beside an edited form: doc_id, text, sketch, edited, edited_sketch, next_sketch.

    ``edited`` has the first floor(n / 3) code points (or all) of the next document, by descending id, in place of as many at
    its end; the document after the last is the first. Null text counts as empty. Rows of one id follow each other in order of
    a hash of the text; null ids come last. A sole document is its own next. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = in_ranges(rows, range_bytes).withColumn("sketch", sketch(shingle_hashes(F.col("text"), shingle), k))
    window = Window.partitionBy("range").orderBy("lent", F.col("doc_id").desc_nulls_last(), F.desc("tie"))
    rows = rows.withColumn("next", F.lead(F.struct("text", "sketch")).over(window)).where("lent = 0")
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - third),
                      F.substring(F.col("next.text"), F.lit(1), third))
    rows = rows.select("doc_id", "text", "sketch", edited.alias("edited"), F.col("next.sketch").alias("next_sketch"))
    return rows.withColumn("edited_sketch", sketch(shingle_hashes(F.col("edited"), shingle), k))
