"""An ordered key/value changelog: dedupe, fold, read, snapshot, commit filter.

A log row is (log_index, op, key, value, client, request_id) with op Put,
Append or Get. Put and Append compose associatively, so the fold runs per
(key, segment) where a segment is ``2**bits`` consecutive log indexes; no task
and no row ever holds a whole hot key. The text of a segment is cut into pieces of
a bounded number of bytes. A value is its live pieces in order of segment and piece,
and a key whose live entries lie in one segment and are not large has exactly one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .ordered import Running, order_span, running

SEGMENT_BITS = 16
# Bytes after which a piece of a segment's text is closed.
PIECE_BYTES = 16 << 20


def dedupe(log: DataFrame, marks: DataFrame | None = None,
           span: tuple[int, int] | None = None) -> DataFrame:
    """Drop an op whose client was already seen with a request id as high.

    ``marks`` (client, mark) carries the highest ids from an earlier part;
    they take part as rows before the first of the log, not by a join.
    """
    low, high = span or order_span(log, "log_index")
    rows = log
    if marks is not None:
        low -= 1
        rows = log.unionByName(marks.select(
            "client", F.col("mark").alias("request_id"),
            F.lit(low).cast("long").alias("log_index")), allowMissingColumns=True)
    seen = running(rows, ["client"], "log_index",
                   {"seen": Running("max", "request_id", exclusive=True)}, (low, high))
    if marks is not None:
        seen = seen.where(F.col("log_index") > low)
    return seen.where(F.col("seen").isNull() | (F.col("request_id") > F.col("seen"))).select(
        *log.columns)


def client_marks(log: DataFrame) -> DataFrame:
    """Highest request id per client."""
    return log.groupBy("client").agg(F.max("request_id").alias("mark"))


def _join_after_put(df: DataFrame, order: Column, is_put: Column, text: str, piece_bytes: int) -> DataFrame:
    """Per (key, segment, piece): does it hold a Put, and the text from the last Put on.

    A piece is closed once the texts before an entry have ``piece_bytes``, so a row holds that and one entry more
    at most, whatever the size of the values. The entries of a segment are moved once; running sizes and lists are made where they end up.
    """
    rows = df.select("key", "segment", order.alias("at"), F.when(is_put, order).alias("put_at"), F.col(text).alias("t"))
    place = Window.partitionBy("key", "segment").orderBy("at")
    before = F.sum(F.octet_length("t")).over(place.rowsBetween(Window.unboundedPreceding, -1))
    pieces = rows.withColumn("piece", F.floor(F.coalesce(before, F.lit(0)) / piece_bytes).cast("int"))
    grouped = pieces.groupBy("key", "segment", "piece").agg(
        F.max("put_at").alias("last_put"), F.sort_array(F.collect_list(F.struct("at", "t"))).alias("items"))
    kept = F.filter("items", lambda e: F.col("last_put").isNull() | (e["at"] >= F.col("last_put")))
    return grouped.select("key", "segment", "piece", F.col("last_put").isNotNull().alias("has_put"),
                          F.array_join(F.transform(kept, lambda e: e["t"]), "").alias("text"))


def fold_segments(log: DataFrame, bits: int = SEGMENT_BITS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(key, segment, piece, has_put, text) of a deduplicated log."""
    ops = log.where(F.col("op").isin("Put", "Append")).withColumn(
        "segment", F.shiftright("log_index", bits))
    return _join_after_put(ops, F.col("log_index"), F.col("op") == "Put", "value", piece_bytes)


def merge_parts(parts: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Join folds of successive log parts: adds up (key, segment, piece, part, has_put, text)."""
    return _join_after_put(parts, F.struct("part", "piece"), F.col("has_put"), "text", piece_bytes)


def puts_of(segments: DataFrame) -> DataFrame:
    """(key, segment, piece) of the pieces that hold a Put.

    The condition on the text is always true. It keeps the column, so that this plan and that of the
    segments have one exchange, which is written once and read twice.
    """
    return segments.where(F.col("has_put") & (F.length("text") >= 0)).select("key", "segment", "piece")


def live(segments: DataFrame, puts: DataFrame) -> DataFrame:
    """Pieces from the key's last Put on, as (key, segment, piece, value)."""
    place = F.struct("segment", "piece")
    last = puts.groupBy(F.col("key").alias("k_p")).agg(F.max(place).alias("p"))
    joined = segments.join(last, F.col("key") == F.col("k_p"), "left")
    return joined.where(F.col("p").isNull() | (place >= F.col("p"))).select(
        "key", "segment", "piece", F.col("text").alias("value"))


def fold(log: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """State after the whole log: (key, segment, piece, value)."""
    segments = fold_segments(dedupe(log), bits)
    return live(segments, puts_of(segments))


def get(log: DataFrame, keys: DataFrame, upto: int | None = None,
        bits: int = SEGMENT_BITS) -> DataFrame:
    """Values of ``keys`` as of a log index; an absent key reads as the empty string."""
    if upto is not None:
        log = log.where(F.col("log_index") <= upto)
    wanted = keys.select(F.col("key").alias("k_w")).distinct()
    # every op counts for the dedupe, but only wanted keys are folded
    ops = dedupe(log).join(wanted, F.col("key") == F.col("k_w"), "left_semi")
    segments = fold_segments(ops, bits)
    state = live(segments, puts_of(segments)).withColumnRenamed("key", "k_s")
    return keys.select("key").join(state, F.col("key") == F.col("k_s"), "left").select(
        "key", F.coalesce("segment", F.lit(0)).alias("segment"), F.coalesce("piece", F.lit(0)).alias("piece"),
        F.coalesce("value", F.lit("")).alias("value"))


@dataclass(frozen=True)
class Snapshot:
    """Folded state and dedupe marks up to and including ``index``."""

    index: int
    state_path: str
    marks_path: str


def compact(log: DataFrame, index: int, bits: int = SEGMENT_BITS) -> Snapshot:
    """Write the state at ``index``; the log up to it is no longer needed."""
    spark = log.sparkSession
    head = log.where(F.col("log_index") <= index)
    snap = Snapshot(index, scratch_path(spark, "state"), scratch_path(spark, "marks"))
    fold_segments(dedupe(head), bits).write.parquet(snap.state_path)
    client_marks(head).write.parquet(snap.marks_path)
    return snap


def replay(spark: SparkSession, snap: Snapshot, log: DataFrame,
           bits: int = SEGMENT_BITS) -> DataFrame:
    """State after the snapshot and the rest of the log; equals ``fold``."""
    tail = log.where(F.col("log_index") > snap.index)
    marks = spark.read.parquet(snap.marks_path)
    old = spark.read.parquet(snap.state_path).withColumn("part", F.lit(0))
    new = fold_segments(dedupe(tail, marks), bits).withColumn("part", F.lit(1))
    merged = merge_parts(old.unionByName(new))
    return live(merged, puts_of(merged))


def committed_changes(log: DataFrame) -> DataFrame:
    """Last committed value per key of a begin/commit/abort/update log.

    A row is (lsn, txn, kind, key, after). A transaction ends at its first
    commit or abort; one that never ends counts as aborted.
    """
    ends = log.where(F.col("kind").isin("commit", "abort")).groupBy("txn").agg(
        F.min_by("kind", "lsn").alias("outcome"), F.min("lsn").alias("end_lsn"))
    good = ends.where(F.col("outcome") == "commit").select(F.col("txn").alias("t_e"), "end_lsn")
    changes = log.where(F.col("kind") == "update").join(
        good, (F.col("txn") == F.col("t_e")) & (F.col("lsn") < F.col("end_lsn")), "left_semi")
    return changes.groupBy("key").agg(F.max_by("after", "lsn").alias("value"),
                                      F.max("lsn").alias("lsn"))


def running_value(txns: DataFrame, key: str, order: str) -> DataFrame:
    """The value each read-increment-write transaction of a key leaves behind."""
    return running(txns, [key], order, {"value": Running("count")})


def append_order(log: DataFrame, bits: int = SEGMENT_BITS) -> DataFrame:
    """Is every live marker ``x <client> <n> y`` there once and in order, per (key, client)?

    Markers are cut out of the folded text and matched to the log by equality,
    which is linear in the text; each is then compared with the client's
    previous one.
    """
    segments = fold(log, bits)
    pieces = segments.select("key", "segment", "piece", F.posexplode(
        F.regexp_extract_all("value", F.lit(r"(x \d+ \d+ y)"), F.lit(1))).alias("at", "marker"))
    found = pieces.select(
        F.col("key"), F.split("marker", " ")[1].cast("long").alias("client"),
        F.split("marker", " ")[2].cast("long").alias("n"),
        # a piece has fewer than 2^20 markers, and a segment fewer than 2^17 pieces
        (F.shiftleft(F.col("segment").cast("long"), 37) + F.shiftleft(F.col("piece").cast("long"), 20) + F.col("at")).alias("place"))
    seen = found.groupBy("key", "client", "n").agg(
        F.count(F.lit(1)).alias("copies"), F.min("place").alias("place"))
    marks = log.select(F.regexp_extract("value", r"^x \d+ (\d+) y", 1).try_cast("long").alias("n"))
    before = running(seen, ["key", "client"], "n",
                     {"previous": Running("max", "place", exclusive=True)}, order_span(marks, "n"))
    good = (F.col("copies") == 1) & (F.col("previous").isNull()
                                     | (F.col("place") > F.col("previous")))
    return before.groupBy("key", "client").agg(
        F.count(F.lit(1)).alias("markers"), F.min(good).alias("in_order"))
