"""A corpus pipeline: language ID, exact, near and passage dedup, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, folder) and returns the rows that stay, with the
columns of ``docs``; the last returns the packed pieces. ``docs`` is stored data: each stage's result is written as Parquet and
read again for the next. Null text counts as empty, which has no language, so it ends at the first stage. Null ids and
repeated rows are rows like others, of which the dedup stages leave one per text. Columns beyond doc_id and text are
carried, n_chars and lang included; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, language, packing, simhash, substrings
from millrace.llm.common import read_documents
from millrace.llm.queries import vocabulary
from millrace.session import cut_lineage

# The least likelihood share of its language that a document stays with.
LEAST_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a known language stay."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(0)]).alias("__doc")
    found = language.identify(docs, "doc_id", "text", "lang", others, with_text=True)
    known = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return known.select(*[F.col("text") if c == "text" else F.col("__doc").getField(c).alias(c) for c in docs.columns])


def exact_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of SimHash fingerprints in reach, the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, simhash.RADIUS, simhash.SHINGLE)


def passage_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Words of passages that occurred before go; a document that has no other words goes too."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    extra = [F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0)]).alias("__doc")]
    found = substrings.remove_repeats(docs, untouched=True, extra=extra)
    found = found.where("n_words = 0 OR n_removed < n_words")

    def column(name: str):
        if name == "doc_id":
            return F.col("doc_id")
        if name == "text":
            return F.col("kept").alias("text")
        value = F.col("__doc").getField(name)
        if name == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(value).cast(docs.schema[name].dataType)
        return value.alias(name)

    return found.select(*map(column, docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row per piece with its sequence and offset."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language ID", language_stage), ("exact dedup", exact_stage), ("SimHash near-dedup", near_stage),
          ("substring dedup", passage_stage), ("best-fit packing", packing_stage)]

# The stages learn models, hash and pack, which SQL can't express; tests/llm checks each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name.split()[0])
    return docs
