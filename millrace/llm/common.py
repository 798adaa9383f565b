"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The white space that separates words, as a Java and as a Python pattern.
BLANKS = r"[\x20\x09-\x0D]+"
# Texts are worked on in Python in slices of at most so many characters.
SLICE_CHARS = 2_000_000


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` is the same for pure ASCII, and faster."""
    pure = F.octet_length(text) == F.length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_CHARS) -> Iterator[tuple[int, list]]:
    """(first row, texts) of consecutive rows with at most ``most`` bytes, one row at least."""
    texts = batch.column(column)
    lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most:
            yield start, texts.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += int(n)
    if len(lengths) > start:
        yield start, texts.slice(start).to_pylist()


class Memo(dict):
    """A dictionary that fills itself and starts anew when it is full."""

    def __init__(self, make: Callable, most: int = 200_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def bounded_sample(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of ``keys`` and the row's place. No text is moved.

    For fitting a classifier only.
    """
    ranked = rows.withColumn("__rank", F.xxhash64(*keys, F.monotonically_increasing_id()))
    last = ranked.select("__rank").orderBy("__rank").limit(most).agg(F.max("__rank")).first()[0]
    return ranked.where(F.col("__rank") <= F.lit(last).cast("long")).drop("__rank")


def most_frequent(counted: DataFrame, most: int, by: str = "n") -> DataFrame:
    """The rows of ``counted`` with the highest counts, at most ``most`` of them, or none of equal rank beyond.

    The cut is found from the number of rows at each size of count, in steps of a ninth, so no rows are
    sorted or gathered to find it. ``counted`` is read twice.
    """
    step = F.floor(F.log(F.col(by).cast("double")) / F.log(F.lit(1.125))).cast("int")
    sizes = counted.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()
    least, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        held += r["rows"]
        if held > most:
            break
        least = r["step"]
    return counted.where(step >= least) if least is not None else counted.limit(0)


def free_name(name: str, *taken: str) -> str:
    """``name``, with as many underscores in front as make it differ from the ``taken`` ones in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a further column that numbers the rows, written to the shared folder, and that column's name.

    Numbers that are made while reading depend on how the files are cut, which another reading may do
    otherwise. The copy is compressed well, as it stays until the shared folder is cleared.
    """
    spark = docs.sparkSession
    name = free_name("__row", *docs.columns)
    rows = docs.withColumn(name, F.monotonically_increasing_id())
    path = scratch_path(spark, "numbered")
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path), name


# Cuts that a row is compared with at one step of the way to its range.
FAN = 64


def in_order_ranges(rows: DataFrame, id_col: str, tie_col: str, ranges: int, to: str, fan: int = FAN) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` with the number ``to`` of their range in order of (id, tie), null ids lowest; and the ranges' numbers, column ``range``.

    The cuts come from Spark's range partitioning of the two key columns alone and are kept as a table. A row finds its range along a
    tree of ``fan`` cuts a node, one join with a table of nodes a level, so neither the plan nor the work on a row grows with
    the number of ranges, but for the depth of the tree. Rows with one id are dealt over its ranges by their tie.
    """
    if ranges <= 1:
        return rows.withColumn(to, F.lit(0)), None
    key = F.struct(F.col(id_col).isNotNull().alias("known"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                   F.col(tie_col).alias("tie"))
    keys = rows.select(key.alias("key")).select("key.*")
    nodes = cut_lineage(keys.repartitionByRange(ranges, "known", "id", "tie").groupBy(F.spark_partition_id().alias("range")).agg(
        F.min(F.struct("known", "id", "tie")).alias("key")), "cuts")
    leaves, levels, width = nodes.select("range"), [], ranges
    while width > fan:
        child = nodes.select(F.floor(F.col("range") / fan).cast("int").alias("node"), F.struct("key", "range").alias("cut"))
        table = child.groupBy("node").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))
        levels.append(table.select(F.col("node").alias("__node"), F.col("cuts").alias("__cuts")))
        nodes, width = table.select(F.col("node").alias("range"), F.col("cuts")[0]["key"].alias("key")), -(-width // fan)
    # At most ``fan`` cuts, the root of the tree.
    top = sorted((tuple(r["key"]), r["range"]) for r in nodes.collect())
    at = rows.withColumn("__key", key)
    # A transform over one element computes the key once, not for each cut.
    spot = lambda cuts: F.element_at(F.transform(F.array(F.col("__key")), lambda k: F.element_at(
        F.filter(cuts, lambda c: c["key"] <= k), -1)["range"]), 1)
    cut = lambda k, r: F.struct(F.struct(F.lit(k[0]).alias("known"), F.lit(k[1]).cast("long").alias("id"), F.lit(k[2]).cast("long").alias("tie"))
                                .alias("key"), F.lit(r).alias("range"))
    if not top:
        return rows.withColumn(to, F.lit(0)), leaves
    at = at.withColumn("__node", spot(F.array(*[cut(k, r) for k, r in top])))
    for table in reversed(levels):
        at = at.join(table, "__node").withColumn("__node", spot(F.col("__cuts"))).drop("__cuts")
    return at.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__node").alias(to)), leaves
