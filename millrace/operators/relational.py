"""Scan, filter, schema, insert and delete over catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .predicates import Op, predicate


def same_types(a: T.StructType, b: T.StructType) -> bool:
    """Schemas are equal when the types agree position by position; names do not count."""
    return [f.dataType for f in a.fields] == [f.dataType for f in b.fields]


def merge_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    return T.StructType(a.fields + b.fields)


def field_index(schema: T.StructType, name: str) -> int:
    """Position of the first field called ``name``."""
    for i, f in enumerate(schema.fields):
        if f.name == name:
            return i
    raise KeyError(name)


def scan(df: DataFrame, alias: str) -> DataFrame:
    """Every row, columns renamed ``alias_field``."""
    return df.toDF(*[f"{alias}_{c}" for c in df.columns])


def scan_rows(spark: SparkSession, schema: T.StructType, rows) -> DataFrame:
    """Rows under a declared schema; a row or table that does not fit raises.

    ``rows`` is a list of Python rows, or a DataFrame that is checked by
    position and takes the declared names.
    """
    if isinstance(rows, DataFrame):
        if not same_types(rows.schema, schema):
            raise TypeError("rows do not fit the declared schema")
        return rows.toDF(*schema.names)
    return spark.createDataFrame(rows, schema, verifySchema=True)


def filter_rows(df: DataFrame, field: str | int, op: Op | str | int, constant) -> DataFrame:
    return df.filter(predicate(df, field, op, constant))


def insert_into(child: DataFrame, path: str) -> DataFrame:
    """Append ``child`` to the Parquet table at ``path``; one row with the row count.

    The write happens once, here; reading the result again writes nothing.
    The count comes from the write itself, so the child runs once.
    """
    spark = child.sparkSession
    target = spark.read.parquet(path)
    if not same_types(child.schema, target.schema):
        raise TypeError("schema of the rows differs from the table")
    return _write_counted(child.toDF(*target.columns), path, "append")


def delete_where(spark: SparkSession, path: str, condition, new_path: str) -> DataFrame:
    """Write the rows that stay to ``new_path``; one row with the number deleted.

    Rows for which the condition is null stay. The table read is never
    overwritten: the caller repoints the table to the new version.
    """
    doomed = F.coalesce(condition, F.lit(False))
    seen = Observation()
    spark.read.parquet(path).observe(
        seen, F.coalesce(F.sum(doomed.cast("long")), F.lit(0)).alias("count")
    ).where(~doomed).write.parquet(new_path)
    return spark.createDataFrame([(int(seen.get["count"]),)], "count long")


def _write_counted(df: DataFrame, path: str, mode: str) -> DataFrame:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("count")).write.mode(mode).parquet(path)
    return df.sparkSession.createDataFrame([(int(seen.get["count"]),)], "count long")
