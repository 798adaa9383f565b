"""Whole files, key/value JSON, and plain lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_bucket
from ..functions.text import tab_line


def scan_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One record per file: (name, contents); partition folders become columns."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("name"), F.col("value").alias("contents"), "*"
    ).drop("value")


def write_kv_json(pairs: DataFrame, path: str, buckets: int) -> None:
    """One JSON object per line, in one folder per reduce bucket.

    Rows are brought together by bucket so that a task writes few files; the
    rebalance splits a bucket that is too large for one task.
    """
    rows = pairs.select(hash_bucket(F.col("key"), buckets).alias("bucket"), "key", "value")
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").json(path)


def read_kv_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bucket int, key string, value string").json(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def dump_rows(df: DataFrame, path: str) -> None:
    """Rows as text, every field followed by a tab."""
    df.select(tab_line(*[F.col(c) for c in df.columns]).alias("line")).write.text(path)
