"""Map, shuffle and reduce jobs over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions.hashing import hash_bucket
from ..functions.text import kv_line, split_fields
from ..session import cut_lineage

# documents per index segment (as a power of two) and spreads of a hot key
INDEX_BITS = 14
SALTS = 256

Reduce = Callable[[str, list[str]], str]


def words(df: DataFrame, text: str, tokens: Callable[[Column], Column] = split_fields,
          *keep: str) -> DataFrame:
    """One row per word occurrence."""
    return df.select(*keep, F.explode(tokens(F.col(text))).alias("word"))


def word_count(df: DataFrame, text: str,
               tokens: Callable[[Column], Column] = split_fields) -> DataFrame:
    """Occurrences of each word; counted per task before the shuffle."""
    return words(df, text, tokens).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def distinct_keys(df: DataFrame, text: str) -> DataFrame:
    """Each word once with an empty value, in byte order."""
    return words(df, text).distinct().select(
        F.col("word").alias("key"), F.lit("").alias("value")).orderBy("key")


def document_words(df: DataFrame, doc: str, text: str,
                   tokens: Callable[[Column], Column] = split_fields) -> DataFrame:
    """Each (document, word) once. A document is one row, so no shuffle is needed."""
    return df.select(F.col(doc).alias("doc"),
                     F.explode(F.array_distinct(tokens(F.col(text)))).alias("word"))


def document_name(doc: Column) -> Column:
    """A name whose byte order is the order of the non-negative ids."""
    return F.concat(F.lit("doc-"), F.lpad(doc.cast("string"), 19, "0"))


def _cut(pairs: DataFrame, keys: list[str], number: Column, bits: int) -> DataFrame:
    """Pairs moved to their (*keys, segment).

    Lists do not shrink by partial aggregation, so rows are moved first and
    gathered once, where they end up.
    """
    return pairs.withColumn("segment", F.shiftright(number, bits)).repartition(*keys, "segment")


def _lists(cut: DataFrame, keys: list[str], names: Callable[[Column], Column]) -> DataFrame:
    """The sorted document list per (*keys, segment)."""
    return cut.groupBy(*keys, "segment").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list("doc")), names), ",").alias("docs"))


def _index(cut: DataFrame, names: Callable[[Column], Column]) -> DataFrame:
    """Lists with the number of documents of their word.

    Counting ``doc`` itself keeps the columns of both branches equal, so that
    the texts are split and moved once and the shuffle is read twice.
    """
    totals = cut.groupBy("word", "segment").agg(F.count("doc").alias("n")).groupBy("word").agg(
        F.sum("n").alias("n_docs"))
    return _lists(cut, ["word"], names).join(totals, "word").select(
        "word", "n_docs", "segment", "docs")


def inverted_index(df: DataFrame, doc: str, text: str,
                   tokens: Callable[[Column], Column] = split_fields,
                   bits: int = INDEX_BITS) -> DataFrame:
    """word, number of documents, and the sorted document list in segments.

    A segment covers ``2**bits`` consecutive document ids, so the list of a
    word found in every document is never in one row or task; the whole list
    is the segments joined in order. A word whose documents fall into one
    range has one row. Documents with names and no ids are numbered by
    ``number_documents`` first.
    """
    pairs = document_words(df, doc, text, tokens)
    return _index(_cut(pairs, ["word"], F.col("doc"), bits), document_name)


def number_documents(df: DataFrame, name: str) -> DataFrame:
    """(name, number): increasing numbers in byte order of the names.

    The sort is by range, so no task sees all names; the numbers grow with the
    partition and are written down, so that a lost task cannot change them.
    """
    names = df.select(name).distinct().orderBy(name)
    return cut_lineage(names.select(name, F.monotonically_increasing_id().alias("number")), "names")


def inverted_index_by_name(df: DataFrame, name: str, text: str,
                           tokens: Callable[[Column], Column] = split_fields,
                           bits: int = INDEX_BITS) -> DataFrame:
    """The index of named records, such as files, in byte order of the names."""
    numbered = df.join(number_documents(df, name), name)
    pairs = numbered.select(F.struct(F.col("number").alias("n"), F.col(name).alias("name")).alias("doc"),
                            F.explode(F.array_distinct(tokens(F.col(text)))).alias("word"))
    return _index(_cut(pairs, ["word"], F.col("doc.n"), bits), lambda d: d["name"])


def top_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest counts, ascending, ties in byte order of the word."""
    best = counts.orderBy(F.desc("count"), F.desc("word")).limit(k)
    return best.orderBy("count", "word")


def top_index(df: DataFrame, doc: str, text: str, without: str = "16", k: int = 10,
              tokens: Callable[[Column], Column] = split_fields,
              bits: int = INDEX_BITS) -> DataFrame:
    """The ``k`` words in most documents among index lines free of ``without``.

    A line holds the word, the number and every document name; separators
    cannot be part of ``without``, so the test is made on the parts and
    lists are only built for the words that remain.
    """
    pairs = document_words(df, doc, text, tokens)
    stats = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.max(document_name(F.col("doc")).contains(F.lit(without))).alias("doc_hit"))
    clean = stats.where(~(F.col("doc_hit") | F.col("word").contains(F.lit(without))
                          | F.col("n_docs").cast("string").contains(F.lit(without))))
    best = clean.orderBy(F.desc("n_docs"), F.desc("word")).limit(k).select("word", "n_docs")
    found = pairs.join(F.broadcast(best), "word")  # at most k rows
    keys = ["word", "n_docs"]
    lists = _lists(_cut(found, keys, F.col("doc"), bits), keys, document_name)
    return lists.orderBy("n_docs", "word", "segment")


# --- user functions -------------------------------------------------------

def map_files(df: DataFrame, name: str, contents: str,
              mapper: Callable[[str, str], Iterable[tuple[str, str]]],
              combine: Reduce | None = None) -> DataFrame:
    """Run ``mapper(name, contents)`` on every record; key/value pairs come out.

    ``combine`` reduces the pairs of a batch before they leave the task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups: dict[str, list[str]] = {}
            for n, c in zip(batch["name"], batch["contents"]):
                for k, v in mapper(n, c):
                    groups.setdefault(k, []).append(v)
            if combine:
                rows = [(k, combine(k, vs)) for k, vs in groups.items()]
            else:
                rows = [(k, v) for k, vs in groups.items() for v in vs]
            yield pd.DataFrame(rows, columns=["key", "value"], dtype="object")

    records = df.select(F.col(name).cast("string").alias("name"), F.col(contents).alias("contents"))
    return records.mapInPandas(run, "key string, value string")


def _runs(*columns: pa.Array) -> list[int]:
    """Where runs of equal values in all of some columns start, and the end."""
    n, new = len(columns[0]), np.zeros(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        code = c.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new |= code[1:] != code[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist(), n] if n else [0]


def _combine(fn: Reduce):
    """Reduce the values of a batch by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").dictionary_encode()
            code = key.indices.fill_null(len(key.dictionary)).to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            values = batch.column("value").take(pa.array(order)).to_pylist()
            names = [*key.dictionary.to_pylist(), None]
            cuts = [0, *(np.flatnonzero(np.diff(code[order])) + 1).tolist(), len(order)] if len(order) else [0]
            groups = [names[code[order[a]]] for a in cuts[:-1]]
            done = [fn(k, values[a:b]) for k, a, b in zip(groups, cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(done, pa.string())], ["key", "value"])

    return run


def _merge_sorted(fn: Reduce, columns: list[str], hold: int = 4096):
    """Reduce sorted rows of a partition, holding at most ``hold`` values at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, schema = None, [], None

        def made(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)

        for batch in batches:
            names = [*columns, "value"]
            schema = pa.schema([batch.schema.field(n) for n in names])
            groups = [batch.column(c) for c in columns]
            values, cuts, out = batch.column("value").to_pylist(), _runs(*groups), []
            for a, b in zip(cuts, cuts[1:]):
                group = tuple(g[a].as_py() for g in groups)
                if group != current:
                    if current is not None:
                        out.append((*current, fn(current[0], held)))
                    current, held = group, []
                for at in range(a, b, hold):
                    held += values[at:min(at + hold, b)]
                    if len(held) >= hold:
                        held = [fn(current[0], held)]
            yield made(out)
        if current is not None:
            yield made([(*current, fn(current[0], held))])

    return run


def reduce_groups(pairs: DataFrame, partial: Reduce, merge: Reduce) -> DataFrame:
    """Reduce the values of each key with user functions.

    ``partial(key, values)`` turns some of a key's values into a partial
    result and ``merge(key, partials)`` joins partial results in any grouping.
    Values are reduced in the task that made them, then per (key, salt), then
    per key, so a key that holds most rows is spread over all tasks.
    """
    return _reduce_partials(pairs.select("key", "value").mapInArrow(
        _combine(partial), "key string, value string"), merge)


def _reduce_partials(local: DataFrame, merge: Reduce) -> DataFrame:
    # The salt is the task's number alone: a task that runs again may cut its
    # batches elsewhere, and all its parts of a key must still go to one place.
    salted = local.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)).cast("int"))
    spread = salted.repartition("key", "salt").sortWithinPartitions("key", "salt").mapInArrow(
        _merge_sorted(merge, ["key", "salt"]), "key string, salt int, value string")
    return spread.select("key", "value").repartition("key").sortWithinPartitions(
        "key").mapInArrow(_merge_sorted(merge, ["key"]), "key string, value string")


def reduce_native(pairs: DataFrame, value: Column) -> DataFrame:
    """Reduce with a built-in aggregate: the fast form of ``reduce_groups``."""
    return pairs.groupBy("key").agg(value.cast("string").alias("value"))


def run_job(records: DataFrame, name: str, contents: str, mapper, partial: Reduce, merge: Reduce,
            n_reduce: int) -> DataFrame:
    """map, reduce and partition: (bucket, key, value) sorted by key within a bucket."""
    reduced = _reduce_partials(map_files(records, name, contents, mapper, partial), merge)
    bucketed = reduced.withColumn("bucket", hash_bucket(F.col("key"), n_reduce))
    return bucketed.repartitionByRange("bucket", "key").sortWithinPartitions(
        "bucket", "key").select("bucket", "key", "value")


def merged_lines(pairs: DataFrame) -> DataFrame:
    """``key: value`` lines over all buckets, in byte order of the key."""
    return pairs.orderBy("key").select(kv_line(F.col("key"), F.col("value")).alias("line"))


def ordered_reduce(df: DataFrame, key: str, order: str, start: Callable[[], object], step: Callable[[object, Row], object],
                   finish: Callable[[object], tuple], result: str) -> DataFrame:
    """A fold over the rows of each key in ``order``, as a table function over partitions: the key and the ``result`` columns.

    ``step(state, row)`` is called for each row after ``start()``; ``finish(state)`` gives the result, and a bounded state is all
    that a task holds. Rows of a key are read in turn, as their order asks for. The type of the key is found from the table.
    """
    shown = T.StructType.fromDDL(result).fields

    class Fold:
        @staticmethod
        def analyze(table: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(schema=T.StructType([table.dataType[key], *shown]))

        def __init__(self):
            self.state, self.key = start(), None

        def eval(self, row: Row):
            self.key = row[key]
            self.state = step(self.state, row)

        def terminate(self):
            yield (self.key, *finish(self.state))

    return udtf(Fold)(df.asTable().partitionBy(key).orderBy(order))
