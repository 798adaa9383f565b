"""Delimited text with declared int and string fields."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import trim_field, trim_truncate


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines without carriage returns and without blank lines: column ``line``."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.regexp_replace("value", "\r", "").alias("line")).where("line <> ''")


def _typed(field: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return trim_truncate(field)
    number = trim_field(field)
    return F.when(number.rlike(r"^[+-]?[0-9]+$"), number).try_cast(dtype.simpleString())


def _parsed(line: Column, schema: T.StructType, sep: str) -> tuple[Column, Column]:
    """The typed row of a line, and whether the line fits."""
    if len(sep) != 1:
        raise ValueError("the separator is one character")
    fields = F.split(line, re.escape(sep), -1)
    values = [_typed(F.get(fields, F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    fits = F.size(fields) == len(schema.fields)
    for f, value in zip(schema.fields, values):
        if not isinstance(f.dataType, T.StringType):
            fits = fits & value.isNotNull()
    return F.struct(*values), fits


def parse_lines(lines: DataFrame, schema: T.StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): typed rows, and the lines that do not fit.

    A line is bad when the number of fields is wrong or an int field is not
    an int. Strings are trimmed and cut at the fixed width.
    """
    row, fits = _parsed(F.col("line"), schema, sep)
    parsed = lines.select("line", row.alias("row"), fits.alias("fits"))
    return parsed.where("fits").select("row.*"), parsed.where("NOT fits").select("line")


def load_delimited(spark: SparkSession, path: str, schema: T.StructType, out: str, sep: str = ",") -> DataFrame:
    """Load the lines at ``path`` in one pass: typed rows to ``out/fits=true``, bad lines to ``out/fits=false``.

    One row is returned: good and bad lines, the bytes of all lines, and the first bad line by file and place, null if there is none. It is
    observed on the write itself, so the text is read once. :func:`loaded` reads the two parts.
    """
    meta = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    raw = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r", "").alias("line"), meta.alias("file"))
    raw = raw.where("line <> ''").withColumn("at", F.monotonically_increasing_id())
    row, fits = _parsed(F.col("line"), schema, sep)
    parsed = raw.select("line", F.struct("file", "at", "line").alias("place"), row.alias("row"), fits.alias("fits"))
    seen = Observation()
    report = parsed.observe(
        seen, F.count(F.when(F.col("fits"), 1)).alias("good"), F.count(F.when(~F.col("fits"), 1)).alias("bad"),
        F.coalesce(F.sum(F.octet_length("line")), F.lit(0)).cast("long").alias("bytes"),
        F.min(F.when(~F.col("fits"), F.col("place"))).getField("line").alias("first_bad"))
    report.select(F.when(F.col("fits"), F.col("row")).alias("row"), F.when(~F.col("fits"), F.col("line")).alias("line"), "fits") \
        .write.partitionBy("fits").parquet(out)
    found = seen.get
    return spark.createDataFrame([(found["good"], found["bad"], found["bytes"], found["first_bad"])],
                                 "good long, bad long, bytes long, first_bad string")


def loaded(spark: SparkSession, schema: T.StructType, out: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) as :func:`load_delimited` wrote them."""
    whole = T.StructType([T.StructField("row", schema), T.StructField("line", T.StringType()), T.StructField("fits", T.BooleanType())])
    both = spark.read.schema(whole).option("basePath", out).parquet(out)
    return both.where("fits").select("row.*"), both.where("NOT fits").select("line")


def scan_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """The rows that fit the declared types."""
    return parse_lines(read_lines(spark, path), schema, sep)[0]


def scan_bad_rows(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """The lines that do not."""
    return parse_lines(read_lines(spark, path), schema, sep)[1]
