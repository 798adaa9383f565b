"""Repeated lines by levelled sorted runs of line hashes. DataFrame functions only.

Documents come in batches. A run holds line keys, by two 64-bit hashes, in sorted hash buckets, each with the number of
its documents and the largest id among them. A batch is merge-anti-joined with the runs: keys that a run knows to be
repeated often enough, with an owner beyond the batch, are settled and go; the others become the batch's own run. When a level holds
``fan`` runs, they are merged into one run of the next level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import bucketed, cut_lineage, remove_scratch, scratch_path
from .common import ascii_lower

# A key of a line counts from so many code points and so many documents on.
LEAST_CHARS, LEAST_DOCS = 20, 3
# Runs of a level that are merged into one, and batches that a whole table is cut into.
FAN, BATCHES = 3, 6
KEY = ["k1", "k2"]
BLANK = " \t\n\x0b\f\r"


def two_hashes(value: Column) -> list[Column]:
    """Two 64-bit hashes that don't depend on each other."""
    return [F.xxhash64(F.lit(seed), value) for seed in (1, 2)]


def line_keys(text: Column) -> Column:
    """The keys of a text's lines: without white space at both ends, A-Z lower-cased."""
    return F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(BLANK)))


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line with a key of at least ``least_chars`` code points: id, t1 and t2 (the text's hashes), pos, k1, k2."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), *[h.alias(f"t{i}") for i, h in enumerate(two_hashes(text), 1)],
                       line_keys(text).alias("keys"))
    lines = rows.select("id", "t1", "t2", F.posexplode("keys").alias("pos", "key")).where(F.length("key") >= least_chars)
    return lines.select("id", "t1", "t2", "pos", *[h.alias(k) for k, h in zip(KEY, two_hashes(F.col("key")))])


class LineRuns:
    """Levelled sorted runs of line keys: k1, k2, docs (how many documents) and owner (the largest id).

    All rows of a document belong in one batch. Batches may come in any order; those with larger ids first leave
    the fewest rows, as a settled key needs no further entry.
    """

    def __init__(self, spark: SparkSession, fan: int = FAN, least_docs: int = LEAST_DOCS, buckets: int | None = None):
        self.spark, self.fan, self.least = spark, fan, least_docs
        # The runs meet without an exchange, so their number of buckets is fixed at the start.
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, DataFrame]]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in reversed(self.levels) for _, run in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch: ``lines`` has id, k1 and k2."""
        counted = lines.select("id", *KEY).distinct().groupBy(*KEY).agg(
            F.count("*").alias("docs"), F.max("id").alias("owner"))
        for run in self.runs():
            known = run.where(F.col("docs") >= self.least).select(
                *[F.col(k).alias(f"run_{k}") for k in KEY], F.col("owner").alias("run_owner")).hint("merge")
            same = (F.col("k1") == F.col("run_k1")) & (F.col("k2") == F.col("run_k2"))
            after = F.col("owner").isNull() | (F.col("run_owner") >= F.col("owner"))
            counted = counted.join(known, same & after, "left_anti")
        self._push(0, counted)

    def _push(self, level: int, rows: DataFrame) -> None:
        path = scratch_path(self.spark, f"run{level}")
        run = bucketed(rows, "line_run", KEY, self.buckets, path)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append((path, run))
        if len(self.levels[level]) == self.fan:
            old, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._merge(old))
            for path, _ in old:
                remove_scratch(self.spark, path)

    def _merge(self, runs: list[tuple[str, DataFrame]]) -> DataFrame:
        # Read as plain files: Spark 4.1.2 unites bucketed columnar scans without bringing equal buckets together.
        rows = self.spark.read.schema(runs[0][1].schema).parquet(*[path for path, _ in runs])
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"))

    def repeated(self) -> DataFrame:
        """k1, k2 and owner of the keys that stand in enough documents."""
        return self._merge([run for level in self.levels for run in level]).where(F.col("docs") >= self.least).select(*KEY, "owner")


def _batches(docs: DataFrame, id_col: str, batches: int) -> Column:
    """The number of a row's batch by its id, the largest ids first. Null ids come last."""
    cuts = docs.select(F.col(id_col).cast("double").alias("id")).approxQuantile(
        "id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    number = F.lit(0)
    for cut in sorted({int(c) for c in cuts}):
        number = number + F.when(F.col("id") > cut, 0).otherwise(1)
    return number.cast("int")


def _without(lines: Column, gone: Column) -> Column:
    """``lines`` without the places in the sorted array ``gone``: what lies between two of them, put together."""
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    gaps = F.arrays_zip(starts.alias("a"), F.concat(gone, F.array(F.size(lines))).alias("b"))
    return F.flatten(F.transform(gaps, lambda g: F.slice(lines, g["a"] + 1, g["b"] - g["a"])))


def remove_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", extra: list[Column] = (),
                 least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES,
                 fan: int = FAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``extra`` columns, n_lines, n_dropped and kept.

    Texts are split at line feeds. Lines are equal if their keys are: without white space at both ends, A-Z lower-cased.
    A key of at least ``least_chars`` code points that stands in at least ``least_docs`` documents loses all its lines,
    except in the document with the largest id that holds it. The other lines stay, joined by line feeds.

    A document is an id: rows with equal ids count once and share their owned lines; a null id is one document, smaller
    than any other. Repeated rows have equal results. Null and empty texts are one empty line, which stays. A line
    of any length is a key, and a text may have any number of lines. Ids are integers. Other columns are not read; an empty table gives no rows.
    ``docs`` is read three times and should be stored.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    path = scratch_path(spark, "lines")
    found = line_digests(ids, "id", "text", least_chars).withColumn("batch", _batches(docs, id_col, batches))
    found.write.partitionBy("batch").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    runs = LineRuns(spark, fan, least_docs)
    for batch in range(batches):
        runs.add(found.where(F.col("batch") == batch))
    other = F.col("owner").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("owner")))
    hits = found.join(cut_lineage(runs.repeated(), "repeated"), KEY).where(other)
    gone = hits.groupBy("id", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"__extra{i}" for i in range(len(extra))]
    shown = [c for c in docs.select(*extra).columns] if extra else []
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *[c.alias(n) for c, n in zip(extra, names)],
                       *[h.alias(f"t{i}") for i, h in enumerate(two_hashes(text), 1)])
    marked = rows.alias("d").join(
        gone.alias("g"), F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("d.t1") == F.col("g.t1"))
        & (F.col("d.t2") == F.col("g.t2")), "left").withColumn("lines", F.split("text", "\n", -1))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(_without(F.col("lines"), F.col("gone")), "\n"))
    return marked.select("doc_id", *[F.col(n).alias(s) for n, s in zip(names, shown)],
                         F.size("lines").cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``docs`` with the text that stays, all columns. Cases as in :func:`remove_lines`; null texts become empty."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")
    found = remove_lines(docs, id_col, text_col, [whole], **limits)
    return found.select(*[F.col("kept").alias(c) if c == text_col else F.col("__doc").getField(c).alias(c) for c in docs.columns])
