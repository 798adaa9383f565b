"""Joins on one field pair with any of the comparison operators.

Equality is left to Spark: hash or sort-merge by size, hot keys split by AQE.
Inequalities have no equality key, for which Spark would run a nested loop
over a broadcast side. They get one in ``regions``: a number of the region of the matrix
of both sides in which a pair lies. Containment has one pass of an automaton over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .predicates import Op, column_name, compare, field_families
from .regions import join_regions

# Bytes of the patterns of one automaton, and of the texts that meet one where there are several.
PACK_BYTES, TEXT_BYTES = 4 << 20, 32 << 20
# Hits that are sent on at once.
HITS = 20_000


def _distinct_names(left: DataFrame, right: DataFrame) -> None:
    both = set(left.columns) & set(right.columns)
    if both:
        raise ValueError(f"rename repeated fields first: {sorted(both)}")


def join(left: DataFrame, lfield: str | int, op: Op | str | int, right: DataFrame,
         rfield: str | int, **sizes: int) -> DataFrame:
    """All pairs with ``left.lfield op right.rfield``; both copies of the key stay.

    ``sizes`` are those of :func:`~millrace.operators.regions.join_regions`.
    """
    _distinct_names(left, right)
    lname, rname = column_name(left, lfield), column_name(right, rfield)
    kind = field_families(left, lname, right, rname)
    op = Op.of(op)
    if op is Op.EQUALS or (op is Op.LIKE and kind != "string"):
        return left.join(right, F.col(lname) == F.col(rname), "inner")
    if op is Op.LIKE:
        return join_containing(left, lname, right, rname)
    return join_regions(left, _order_value(left, lname, kind, right, rname), op, right, _order_value(right, rname, kind, left, lname),
                        compare(F.col(lname), op, F.col(rname), kind), **sizes)


def _order_value(df: DataFrame, name: str, kind: str, other: DataFrame, oname: str) -> Column:
    """The value by which a side is put in order: of the type in which Spark compares the two fields."""
    types = df.schema[name].dataType, other.schema[oname].dataType
    if kind == "time":
        return F.col(name).cast("timestamp_ntz")
    if types[0] != types[1] and any(isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) for t in types):
        return F.col(name).cast("double")
    return F.col(name)


def _automaton(patterns: list[str]) -> ahocorasick.Automaton:
    table = ahocorasick.Automaton()
    for i, p in enumerate(patterns):
        if p:
            table.add_word(p, i)
    table.make_automaton()
    return table


def _hit_rows(rows: pa.RecordBatch | pa.Table, text: str, patterns: list[str], table, name: str) -> Iterator[pa.RecordBatch]:
    """A row per row and pattern in its text, the row's columns and the pattern, ``HITS`` at a time."""
    everywhere = [i for i, p in enumerate(patterns) if not p]
    at, which = [], []

    def made() -> Iterator[pa.RecordBatch]:
        found = rows.take(pa.array(at, pa.int64()))
        named = pa.array([patterns[i] for i in which], pa.string())
        whole = pa.Table.from_arrays([*found.columns, named], [*found.schema.names, name])
        yield from whole.combine_chunks().to_batches()

    for i, value in enumerate(rows.column(text).to_pylist()):
        if value is None:
            continue
        hits = {k for _, k in table.iter(value)} if len(table) else set()
        hits.update(everywhere)
        at.extend([i] * len(hits))
        which.extend(hits)
        if len(at) >= HITS:
            yield from made()
            at, which = [], []
    if at:
        yield from made()


def _one_pack(patterns: Broadcast, text: str, name: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _automaton(patterns.value)
        for batch in batches:
            yield from _hit_rows(batch, text, patterns.value, table, name)

    return work


def _own_pack(text: str, pattern: str, name: str, kept: list[str], schema: pa.Schema):
    def work(texts: pa.Table, patterns: pa.Table) -> pa.Table:
        own = patterns.column(pattern).to_pylist()
        found = list(_hit_rows(texts.select(kept), text, own, _automaton(own), name)) if own and len(texts) else []
        return pa.Table.from_batches(found) if found else schema.empty_table()

    return work


def containing_hits(left: DataFrame, lname: str, patterns: DataFrame, pattern: str, hit: str = "pattern_hit",
                    pack_bytes: int = PACK_BYTES, text_bytes: int = TEXT_BYTES) -> DataFrame:
    """``left`` with the column ``hit``, a row per row and different pattern that its text contains.

    The patterns are one Aho-Corasick automaton if they have at most ``pack_bytes``: it is sent to the tasks and no text
    moves. Else they are dealt into packs of about that size, the texts into parts of about ``text_bytes``, and each
    part of the texts meets each pack in a group of its own.
    """
    spark = left.sparkSession
    known = patterns.select(F.col(pattern).alias("p")).where(F.col("p").isNotNull()).distinct()
    size = known.agg(F.sum(F.octet_length("p")).alias("size")).first()["size"] or 0
    schema = T.StructType([*left.schema.fields, T.StructField(hit, T.StringType())])
    if size <= pack_bytes:
        found = spark.sparkContext.broadcast([r["p"] for r in known.collect()])
        return left.mapInArrow(_one_pack(found, lname, hit), schema)
    packs = -(-size // pack_bytes)
    parts = -(-(left.agg(F.sum(F.octet_length(lname)).alias("size")).first()["size"] or 0) // text_bytes) or 1
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id()), F.lit(parts)).cast("int")
    dealt = left.select("*", salt.alias("part_a"), F.explode(F.sequence(F.lit(0), F.lit(packs - 1))).alias("pack_a"))
    own = known.select("p", F.pmod(F.xxhash64("p"), F.lit(packs)).cast("int").alias("pack_b"),
                       F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part_b"))
    work = _own_pack(lname, "p", hit, left.columns, to_arrow_schema(schema))
    return dealt.groupBy("pack_a", "part_a").cogroup(own.groupBy("pack_b", "part_b")).applyInArrow(work, schema)


def join_containing(left: DataFrame, lname: str, right: DataFrame, rname: str, pack_bytes: int = PACK_BYTES,
                    text_bytes: int = TEXT_BYTES) -> DataFrame:
    """All pairs where the left text contains the right text; null texts contain nothing and the empty one is in all.

    The different right texts are looked for in one pass (:func:`containing_hits`), and the hits joined back by equality.
    """
    _distinct_names(left, right)
    hits = containing_hits(left, lname, right, rname, "pattern_hit", pack_bytes, text_bytes)
    return hits.join(right, F.col("pattern_hit") == F.col(rname), "inner").drop("pattern_hit")


def count_unequal(left: DataFrame, lname: str, right: DataFrame, rname: str) -> DataFrame:
    """``left`` with ``partners``, the number of right rows that differ: all but the equal ones.

    Nulls differ from nothing. The pairs are not made, and each side is aggregated before it is joined.
    """
    known = right.where(F.col(rname).isNotNull()).select(F.col(rname).alias("k_u"))
    equal = known.groupBy("k_u").agg(F.count(F.lit(1)).alias("n_u"))
    total = known.count()
    joined = left.join(equal, F.col(lname) == F.col("k_u"), "left")
    partners = F.when(F.col(lname).isNull(), F.lit(0)).otherwise(F.lit(total) - F.coalesce("n_u", F.lit(0)))
    return joined.select(*left.columns, partners.cast("long").alias("partners"))


# --- equality joins without adaptive execution ----------------------------

HOT_SHARE = 64


def hot_keys(df: DataFrame, key: str, parts: int) -> list[tuple[object, int]]:
    """(key, salts) of the keys with more than 1/64 of the rows, which are at most 64: a salt for each ``parts``-th of all rows, two at least."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k_h")).agg(F.count(F.lit(1)).alias("n_h"))
    total = df.count()
    hot = counts.where(F.col("n_h") * HOT_SHARE > total).collect()
    return [(r["k_h"], max(2, -(-r["n_h"] * parts // total))) for r in hot]


def join_salted(left: DataFrame, right: DataFrame, lname: str, rname: str, hot: list[tuple[object, int]], how: str = "inner") -> DataFrame:
    """Equality join in which the ``hot`` keys are dealt over their salts: a left row goes to one, a right row to all."""
    _distinct_names(left, right)
    if how not in ("inner", "left"):
        raise ValueError("a spread join is inner or left: a copied right row may have no partner in one of its copies")
    if not hot:
        return left.join(right, F.col(lname) == F.col(rname), how)

    def number(key: str) -> Column:
        # Compared as the join compares, whatever the types of the two keys.
        return reduce(lambda rest, pair: F.when(F.col(key) == F.lit(pair[0]), pair[1]).otherwise(rest), hot, F.lit(1))

    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    spread = left.withColumn("salt_l", F.pmod(hashed, number(lname).cast("long")).cast("int"))
    copied = right.select("*", F.explode(F.sequence(F.lit(0), number(rname) - 1)).alias("salt_r"))
    return spread.join(copied, (F.col(lname) == F.col(rname)) & (F.col("salt_l") == F.col("salt_r")), how).drop("salt_l", "salt_r")


def join_hot(left: DataFrame, right: DataFrame, lname: str, rname: str, how: str = "inner") -> DataFrame:
    """Equality join whose hot left keys are spread, for plans AQE does not reach.

    Streaming micro-batches run without adaptive execution. A hot key gets as many salts as its share of the left
    rows fills partitions.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return join_salted(left, right, lname, rname, hot_keys(left, lname, parts), how)
