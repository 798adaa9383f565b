"""Start, drain and stop streaming queries; results go to files, not the driver."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """Stream a Parquet table that is a folder of files or one file."""
    schema = spark.read.parquet(path).schema
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if fs.getFileStatus(jpath).isFile():
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that hold while a query is started; it has its own copy of them from then on."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def drain(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None] | None = None,
          timeout: int | None = None, checkpoint: str | None = None, out: str | None = None,
          settings: dict[str, str] | None = None) -> str:
    """Process all that is available and return the sink folder.

    By default every micro-batch is written to its own ``batch_id=N`` folder;
    a batch that is run again after a failure replaces its own folder. With the ``checkpoint`` and ``out``
    of an earlier run the stream goes on where that ended. ``settings`` hold for this query only.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, "stream")
    # A timeout on the clock would ask for one more batch for ever; Until is for those.
    write = sink or (lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch_id={batch}"))
    idle = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with settings_of(spark, idle | (settings or {})):
        query = (stream.writeStream.outputMode(mode).foreachBatch(write)
                 .option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoint"))
                 .trigger(availableNow=True).start())
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("the stream did not end in time")
    return out


def latest_batch(spark: SparkSession, out: str, schema) -> DataFrame:
    """The last result of a complete-mode stream."""
    rows = all_batches(spark, out, schema)
    last = rows.agg(F.max("batch_id")).first()[0]
    return rows.where(F.col("batch_id") == F.lit(last)).drop("batch_id")


def all_batches(spark: SparkSession, out: str, schema) -> DataFrame:
    """Every row written, with its batch number."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).option("basePath", out).parquet(out)


def latest_update(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row per key of an update-mode stream."""
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
    return newest.select(*keys, "r.*")


class Until:
    """Run a stream that never ends by itself until its results are complete.

    With the ``checkpoint`` and ``out`` of an earlier run it goes on where that ended.
    """

    def __init__(self, stream: DataFrame, mode: str, interval: str = "500 milliseconds",
                 checkpoint: str | None = None, out: str | None = None, settings: dict[str, str] | None = None):
        spark = self.spark = stream.sparkSession
        self.schema = stream.schema
        self.out = out or scratch_path(spark, "stream")
        self._changed = threading.Condition()
        self._batches: set[int] = set()

        def write(df: DataFrame, batch: int) -> None:
            # one action only: a second would run the stateful batch again
            place = f"{self.out}/batch_id={batch}"
            df.write.mode("overwrite").parquet(place)
            with self._changed:
                self._batches.add(batch)
                self._changed.notify_all()

        with settings_of(spark, settings or {}):
            self.query = (stream.writeStream.outputMode(mode).foreachBatch(write)
                          .option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoint"))
                          .trigger(processingTime=interval).start())

    def rows(self) -> DataFrame:
        """What was written so far, with batch numbers."""
        if not self._batches:
            return self.spark.createDataFrame([], T.StructType(
                [*self.schema.fields, T.StructField("batch_id", T.LongType())]))
        return all_batches(self.spark, self.out, self.schema)

    def wait(self, done: Callable[[DataFrame], bool], timeout: int = 300) -> "Until":
        """Block until ``done`` holds for the rows written; it is asked first before any batch."""
        end, seen = time.monotonic() + timeout, -1
        while True:
            with self._changed:
                if len(self._batches) == seen:
                    self._changed.wait(1)
                fresh, seen = len(self._batches) != seen, len(self._batches)
            if fresh and done(self.rows()):
                return self
            if time.monotonic() > end or not self.query.isActive:
                self.query.stop()
                raise RuntimeError(f"the stream's results are not complete: {self.query.exception()}")

    def stop(self) -> DataFrame:
        """End the stream and return what it wrote, with batch numbers."""
        rows = self.rows()
        self.query.stop()
        return rows
