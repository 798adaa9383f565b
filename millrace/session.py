"""Session construction and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the engine is designed for.

    On a cluster leave ``master`` unset and let spark-submit decide; shuffle
    partition counts are an upper bound that AQE coalesces.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only in local mode, where it may be unset, one temporary folder is made for
    the application and removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="millrace-")
            atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
        base = _local_dirs[app]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def write_step(df: DataFrame, name: str = "step") -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; the rows read back, and their folder, to be removed when the next step is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives the loss of any executor and starts a new plan.
    """
    return write_step(df, name)[0]


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared scratch space once its rows are written elsewhere."""
    if not path.startswith(f"{shared_dir(spark)}/millrace/"):
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def bucketed(df: DataFrame, name: str, columns: list[str], buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder in sorted hash buckets and read it back.

    Joins and groups on ``columns`` need no exchange of the result. The number of buckets is the session's number of
    shuffle partitions unless it is given. The table's name lives only until it is read; its files stay at ``path``.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(count, *columns).sortBy(*columns).option("path", path or scratch_path(spark, name))
    writer.saveAsTable(table)
    rows = spark.table(table).select("*")
    spark.sql(f"DROP TABLE {table}")
    return rows


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan out over all cores when its files hold too few row groups.

    For CPU-heavy work on small or badly cut inputs. A scan that already has
    a task per core, as any large one does, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load(spark: SparkSession, folder: str, *names: str):
    """One DataFrame per table name in ``folder``."""
    frames = [spark.read.parquet(f"{folder}/{n}.parquet") for n in names]
    return frames[0] if len(frames) == 1 else frames


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text), dealt out over the cores."""
    return spread(load(spark, folder, "documents").select("doc_id", "text"))


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, text), dealt out over the cores."""
    return spread(load(spark, folder, "conversations").select("conv_id", "turn", "text"))
