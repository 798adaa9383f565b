"""Named tables with declared schemas and an optional key."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .delimited import scan_delimited

# The declared types.
TYPES = {"int": T.IntegerType(), "string": T.StringType()}


@dataclass(frozen=True)
class Entry:
    name: str
    schema: T.StructType
    pk: str


def parse_schema(line: str) -> Entry:
    """``name (field type [pk], ...)``."""
    found = re.fullmatch(r"\s*([^(]*?)\s*\(([^)]*)\).*", line)
    if not found:
        raise ValueError(f"invalid catalog entry: {line}")
    fields, pk = [], ""
    for part in found.group(2).split(","):
        words = part.split()
        if len(words) not in (2, 3):
            raise ValueError(f"invalid catalog entry: {line}")
        kind = words[1].lower()
        if kind not in TYPES:
            raise ValueError(f"unknown type {words[1]}")
        if len(words) == 3:
            if words[2] != "pk":
                raise ValueError(f"unknown annotation {words[2]}")
            pk = words[0]
        fields.append(T.StructField(words[0], TYPES[kind]))
    return Entry(found.group(1), T.StructType(fields), pk)


class Catalog:
    """Tables by name and number; the last table added under a name wins.

    Each table is a temporary view. The key is kept as column metadata and is
    not enforced.
    """

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self.spark = spark
        self.prefix = prefix
        self._entries: dict[int, Entry] = {}
        self._ids: dict[str, int] = {}

    def add_table(self, df: DataFrame, name: str, pk: str = "") -> int:
        if pk:
            df = df.withMetadata(pk, {"pk": True})
        df.createOrReplaceTempView(self.view_name(name))
        table_id = len(self._entries)
        self._entries[table_id] = Entry(name, df.schema, pk)
        self._ids[name] = table_id
        return table_id

    def view_name(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def table_id(self, name: str) -> int:
        return self._ids[name]

    def schema(self, table_id: int) -> T.StructType:
        return self._entries[table_id].schema

    def primary_key(self, table_id: int) -> str:
        return self._entries[table_id].pk

    def table_name(self, table_id: int) -> str:
        return self._entries[table_id].name

    def table_ids(self) -> list[int]:
        return list(self._entries)

    def table(self, name: str) -> DataFrame:
        self.table_id(name)
        return self.spark.table(self.view_name(name))

    def clear(self) -> None:
        for name in self._ids:
            self.spark.catalog.dropTempView(self.view_name(name))
        self._entries.clear()
        self._ids.clear()

    def summary(self) -> DataFrame:
        """(table_name, n_fields, pk, n_rows) of every current table."""
        parts = []
        for name, table_id in self._ids.items():
            entry = self._entries[table_id]
            parts.append(self.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(len(entry.schema)).alias("n_fields"),
                F.lit(entry.pk).alias("pk"), "n_rows"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def load_schema(self, path: str, sep: str = ",") -> list[str]:
        """Register every table of a schema file; the rows are in ``<folder>/<name>.dat``."""
        folder = path.rsplit("/", 1)[0]
        lines = [r[0] for r in self.spark.read.text(path).collect() if r[0].strip()]
        names = []
        for line in lines:
            entry = parse_schema(line)
            rows = scan_delimited(self.spark, f"{folder}/{entry.name}.dat", entry.schema, sep)
            self.add_table(rows, entry.name, entry.pk)
            names.append(entry.name)
        return names
