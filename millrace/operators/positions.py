"""Deletes by row position: a table whose files stay as they are until they are rewritten.

``data/`` holds Parquet files, ``deletes/N`` the places (file, row) that the N-th delete took out, and ``dropped/N`` the files that the N-th
rewrite replaced by those in ``data/gen=N``. A folder counts once it is complete, so a delete or rewrite that fails changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path

_FILE, _ROW = "__file", "__row"
_DELETES, _DROPPED = f"{_FILE} string, {_ROW} long", f"{_FILE} string, gen long"


class PositionedTable:
    """A Parquet table with deletes by position. One writer at a time."""

    def __init__(self, spark: SparkSession, schema: T.StructType, path: str | None = None):
        self.spark, self.schema = spark, schema
        self.path = path or scratch_path(spark, "positioned")

    def _done(self, name: str) -> list[int]:
        """The complete folders ``name/N``."""
        jvm = self.spark._jvm.org.apache.hadoop.fs
        root = jvm.Path(f"{self.path}/{name}")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(int(p.getName().split("=")[-1]) for p in found if fs.exists(jvm.Path(p, "_SUCCESS")))

    def _read(self, name: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{name}/{n}" for n in self._done(name)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def append(self, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/data/gen={self._next('data', 'rewrites')}")

    def _next(self, *names: str) -> int:
        return max([n for name in names for n in self._done(name)], default=-1) + 1

    def _all(self) -> DataFrame:
        """Every row of every complete file with its place, the files that were replaced left out."""
        # A rewrite is complete once it says which files it replaced.
        rewrites, replaced = self._read("dropped", _DROPPED), self._done("dropped")
        started = self._done("rewrites")
        gens = [g for g in self._done("data") if g not in started or g in replaced]
        if not gens:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField(_FILE, T.StringType()), T.StructField(_ROW, T.LongType())]))
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/gen={g}" for g in gens])
        placed = rows.select(*[F.col(f"`{c}`") for c in self.schema.names], F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
        return placed.join(rewrites.select(_FILE), _FILE, "left_anti")

    def _live(self) -> DataFrame:
        return self._all().join(self._read("deletes", _DELETES), [_FILE, _ROW], "left_anti")

    def scan(self) -> DataFrame:
        """The rows that are there."""
        return self._live().select(*[F.col(f"`{c}`") for c in self.schema.names])

    def delete(self, condition: Column) -> int:
        """Take out the rows for which ``condition`` holds; how many they were. Only their places are written."""
        path = f"{self.path}/deletes/{self._next('deletes')}"
        self._live().where(F.coalesce(condition, F.lit(False))).select(_FILE, _ROW).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(_DELETES).parquet(path).count()

    def rewrite(self, least_share: float = 0.0) -> int:
        """Replace the files of which more than ``least_share`` is deleted by files of the rows that are left; how many they were."""
        dead = self._read("deletes", _DELETES).groupBy(_FILE).agg(F.count(F.lit(1)).alias("dead"))
        sizes = self._all().groupBy(_FILE).agg(F.count(F.lit(1)).alias("n"))
        touched = sizes.join(dead, _FILE).where(F.col("dead") > F.col("n") * least_share).select(_FILE)
        gen = self._next("data", "rewrites")
        files = cut_lineage(touched.withColumn("gen", F.lit(gen).cast("long")), "touched")
        count = files.count()
        if count:
            self.spark.range(1).write.parquet(f"{self.path}/rewrites/{gen}")  # until dropped/N is there, data/gen=N doesn't count
            left = self._live().join(files.select(_FILE), _FILE, "left_semi")
            left.select(*[F.col(f"`{c}`") for c in self.schema.names]).write.mode("overwrite").parquet(f"{self.path}/data/gen={gen}")
            files.write.parquet(f"{self.path}/dropped/{gen}")
        return count
