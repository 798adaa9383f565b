"""Lines in and out of the JSON schema envelope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEMA = "schema struct<type:string,optional:boolean>, payload string"


def wrap(line: Column) -> Column:
    """``{"schema": {...}, "payload": line}`` for a required string."""
    return F.to_json(F.struct(
        F.struct(F.lit("string").alias("type"), F.lit(False).alias("optional")).alias("schema"),
        line.alias("payload")))


def unwrap(text: Column) -> Column:
    return F.from_json(text, _SCHEMA)["payload"]
