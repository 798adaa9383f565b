"""Exact duplicates by a tree merge of sorted digest runs. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import ascii_lower, numbered

# Runs that meet in one merge, as a power of two.
FAN_BITS = 3
# Rows of a run, about.
RUN_ROWS = 1_000_000
VERIFY = ["digest", "n_bytes", "sha"]


def _exchanged(runs: DataFrame, number: Column, count: int, keep) -> DataFrame:
    """Rows go to the partition that is their run; what meets there is sorted by digest, and equal, verified digests become one row."""
    moved = runs.withColumn("run", number.cast("int")).repartitionById(count, F.col("run"))
    return moved.groupBy("run", *VERIFY).agg(keep("best").alias("best"), F.sum("copies").alias("copies"))


def merge_runs(digests: DataFrame, bits: int, keep=F.max, fan_bits: int = FAN_BITS) -> DataFrame:
    """Merge the runs of all partitions in binomial rounds.

    There are ``2**bits`` runs, each a partition sorted by digest. Run ``r`` starts as the rows whose ``run`` is r, those of some source
    partitions. In each round, groups of ``2**fan_bits`` partitions that differ in the next bits of their number exchange
    runs and with no other: a row goes to the member whose bits equal those of its digest, and the parts that
    a member is sent are merged in order, verified rows of one digest into one. After the last round the run number is a
    part of the digest, so equal digests have met. A group that fills a third of the table is one row of each run from the start,
    and a member is sent ``2**fan_bits`` rows of it at most.
    """
    runs = digests.select("run", *VERIFY, F.struct("id", "row").alias("best"), F.lit(1).cast("long").alias("copies"))
    runs = _exchanged(runs, F.col("run"), 1 << bits, keep)
    for low in range(0, bits, fan_bits):
        mask = ((1 << min(fan_bits, bits - low)) - 1) << low
        number = (F.col("run").cast("long").bitwiseAND(F.lit(~mask).cast("long"))
                  .bitwiseOR(F.col("digest").bitwiseAND(F.lit(mask).cast("long"))))
        runs = _exchanged(runs, number, 1 << bits, keep)
    return runs


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                     fan_bits: int = FAN_BITS, row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and row.

    Texts are equal when identical after lower-casing A-Z. Digests are sorted and
    merged by a 64-bit hash and verified by byte length and SHA-256 at every level. ``keep`` is
    "max" or "min": the row with the largest or smallest id stays.

    Null text counts as empty. Rows with the same id and text: one of them is kept (the
    last, by place in the input). A null id loses against any other with "max", and wins
    with "min". An empty table gives no rows. Other columns are not read.

    ``row`` numbers the input rows in the order of this reading only, unless ``row_col`` has numbers.
    """
    if keep not in ("max", "min"):
        raise ValueError("keep is max or min")
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
                       F.spark_partition_id().alias("part"))
    digests = cut_lineage(rows.select(
        "id", "row", "part", F.xxhash64("text").alias("digest"),
        F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "digests")
    seen = digests.agg(F.max("part").alias("last"), F.count("*").alias("rows")).first()
    # As many runs as the rows ask for, and no fewer than keep all tasks at work, if the source has as many partitions.
    at_work = min((seen["last"] or 0) + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bits = max(1, math.ceil(math.log2(max(at_work, seen["rows"] / RUN_ROWS))))
    digests = digests.withColumn("run", F.pmod("part", F.lit(1 << bits)))
    merged = merge_runs(digests, bits, F.max if keep == "max" else F.min, fan_bits)
    groups = merged.select(*VERIFY, "best", "copies")
    return digests.join(groups, VERIFY).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"), "row")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Cases as in :func:`exact_duplicates`."""
    rows, number = numbered(docs)
    found = exact_duplicates(rows, id_col, text_col, keep, row_col=number)
    gone = found.where(~F.col("kept")).select(F.col("row").alias(number))
    return rows.join(gone, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
