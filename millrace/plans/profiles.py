"""Histograms, selectivity and table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, statistics
from ..session import cut_lineage, load, scratch_path
from .registry import query

_HIST = """
ends AS (SELECT CAST(min(l_quantity) AS BIGINT) AS low, CAST(max(l_quantity) AS BIGINT) - CAST(min(l_quantity) AS BIGINT) + 1
         AS width FROM lineitem),
hist AS (SELECT CAST((CAST(l_quantity AS BIGINT) - low) * 20 // width AS INT) AS bucket, count(*) AS count
         FROM lineitem, ends GROUP BY 1)"""


def quantity_histogram(spark, sf):
    """Twenty buckets between the bounds of the data, and those bounds."""
    lines = load(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("quantity"))
    low, high = profile.bounds_of(lines, "quantity")
    return profile.histogram(lines, "quantity", 20, low, high), low, high


@query("column_histogram", f"WITH {_HIST} SELECT * FROM hist")
def column_histogram(spark, sf):
    return quantity_histogram(spark, sf)[0]


@query("selectivity_int", f"""
WITH {_HIST},
b AS (SELECT count, ceil(bucket * width / 20) + low AS lo, ceil((bucket + 1) * width / 20) + low AS hi FROM hist, ends)
SELECT round(sum(count * (1 - (least(greatest(17 - lo, 0), hi - lo)
       + CASE WHEN 17 >= lo AND 17 < hi THEN 1 ELSE 0 END) / (hi - lo))) / sum(count), 9) AS selectivity FROM b""")
def selectivity_int(spark, sf):
    hist, low, high = quantity_histogram(spark, sf)
    estimate = profile.selectivity(hist, ">", 17, 20, low, high)
    return estimate.select(F.round("selectivity", 9).alias("selectivity"))


CODE_SQL = """
least(greatest(CASE WHEN u > 2147483647 THEN u - 4294967296 ELSE u END, 0), 2054847098)"""


def code_sql(c: str) -> str:
    """The four-character code of a text column."""
    packed = " + ".join(
        f"(CASE WHEN length({c}) > {i} THEN CAST(ord(substr({c}, {i + 1}, 1)) AS BIGINT) ELSE 0 END)"
        f" * {1 << (24 - 8 * i)}" for i in range(4))
    return f"CAST(({packed}) % 4294967296 AS BIGINT)"


@query("selectivity_str", f"""
WITH v AS (SELECT CAST({CODE_SQL} AS BIGINT) AS code FROM (SELECT {code_sql('p_name')} AS u FROM part)),
hist AS (SELECT code * 1000 // 2054847099 AS bucket, count(*) AS count FROM v GROUP BY 1),
k AS (SELECT CAST({CODE_SQL} AS BIGINT) AS x FROM (SELECT {code_sql("'red widget'")} AS u)),
b AS (SELECT count, x, ceil(bucket * 2054847099 / 1000) AS lo, ceil((bucket + 1) * 2054847099 / 1000) AS hi
      FROM hist, k)
SELECT round(sum(count * least(greatest(x - lo, 0), hi - lo) / (hi - lo)) / sum(count), 9) AS selectivity FROM b""")
def selectivity_str(spark, sf):
    estimate = profile.string_selectivity(load(spark, sf, "part"), "p_name", "<", "red widget", 1000)
    return estimate.select(F.round("selectivity", 9).alias("selectivity"))


def _stats_sql(table: str, ints: list[str], texts: list[str]) -> str:
    return " UNION ALL ".join([f"""
SELECT '{c}' AS "column", CAST(lo AS BIGINT) AS low, CAST(hi AS BIGINT) AS high,
       CAST((CAST({c} AS HUGEINT) - lo) * 100 // (hi - lo + 1) AS INT) AS bucket, count(*) AS count
FROM {table}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {table}) GROUP BY ALL""" for c in ints] + [f"""
SELECT '{c}' AS "column", 0::BIGINT AS low, 2054847098::BIGINT AS high,
       CAST(CAST({CODE_SQL} AS BIGINT) * 100 // 2054847099 AS INT) AS bucket, count(*) AS count
FROM (SELECT {code_sql(c)} AS u FROM {table}) GROUP BY ALL""" for c in texts])


_PART_STATS = _stats_sql("part", ["p_partkey", "p_size"], ["p_name", "p_brand", "p_type"])


@query("table_stats", _PART_STATS)
def table_stats(spark, sf):
    """Int and string columns; prices are no column of this kind."""
    return profile.table_stats(load(spark, sf, "part"))


@query("table_cardinality", f"""
WITH stats AS ({_PART_STATS}),
b AS (SELECT "column", count, ceil(bucket * CAST(high - low + 1 AS HUGEINT) / 100) + low AS lo,
  ceil((bucket + 1) * CAST(high - low + 1 AS HUGEINT) / 100) + low AS hi FROM stats),
k AS (SELECT CAST({CODE_SQL} AS BIGINT) AS code FROM (SELECT {code_sql("'red widget'")} AS u)),
s AS (
  SELECT 'p_size > 17' AS predicate, sum(count) AS n, sum(count * (1 - (least(greatest(17 - lo, 0), hi - lo)
    + CASE WHEN 17 >= lo AND 17 < hi THEN 1 ELSE 0 END) / (hi - lo))) / sum(count) AS share FROM b WHERE "column" = 'p_size'
  UNION ALL
  SELECT 'p_name < red widget', sum(count), sum(count * least(greatest(code - lo, 0), hi - lo) / (hi - lo)) / sum(count)
  FROM b, k WHERE "column" = 'p_name')
SELECT predicate, CAST(n AS BIGINT) AS rows, round(share, 9) AS selectivity, CAST(floor(n * share + 1e-9) AS BIGINT) AS cardinality
FROM s""")
def table_cardinality(spark, sf):
    """Estimates from the stored statistics alone."""
    stats = cut_lineage(profile.table_stats(load(spark, sf, "part")), "stats")
    size = profile.stats_cardinality(stats, "p_size", ">", 17).withColumn("predicate", F.lit("p_size > 17"))
    name = profile.stats_cardinality(stats, "p_name", "<", "red widget").withColumn("predicate", F.lit("p_name < red widget"))
    return size.unionByName(name).select("predicate", "rows", F.round("selectivity", 9).alias("selectivity"), "cardinality")


@query("merged_statistics", """
WITH o AS (SELECT o_orderkey::BIGINT AS o_orderkey, o_custkey::BIGINT AS o_custkey FROM orders),
  v AS (SELECT 'o_custkey' AS "column", o_custkey AS value FROM o UNION ALL SELECT 'o_orderkey', o_orderkey FROM o)
SELECT "column", count(*) AS rows, min(value) AS low, max(value) AS high, count(DISTINCT value) AS distinct_values,
  true AS ranks_within, true AS distinct_within, true AS counts_within, true AS depths_within, 5 AS files
FROM v GROUP BY "column" """)
def merged_statistics(spark, sf):
    """Statistics of four files, and those of a fifth added to them; each estimate is compared with the exact number."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    columns = ["o_custkey", "o_orderkey"]
    path = scratch_path(spark, "orders")
    stored = None
    for files in ((0, 1, 2, 3), (4,)):
        part = F.col("o_orderkey") % 5
        orders.where(part.isin(*files)).repartitionById(5, part.cast("int")).write.mode("append").parquet(path)
        known = [r["part"] for r in stored[0].select("part").distinct().collect()] if stored else []
        rows = spark.read.parquet(path)
        fresh = rows.where(~F.col("_metadata.file_path").isin(known)) if known else rows
        new = [cut_lineage(t, "statistics") for t in statistics.file_statistics(fresh, columns, F.col("_metadata.file_path"))]
        stored = [a.union(b) for a, b in zip(stored, new)] if stored else new
    whole, counts = (cut_lineage(t, "merged") for t in statistics.merged(*stored))
    files = stored[0].select("part").distinct().count()
    out = None

    def at_most(column, values, n):
        """The exact shares of rows with at most each value."""
        counts = [F.sum((F.col(column) <= v).cast("long")).alias(f"n{i}") for i, v in enumerate(values)]
        return [k / n for k in orders.agg(*counts).first()] if values else []

    for c in columns:
        exact = orders.agg(F.count(c).alias("rows"), F.min(c).alias("low"), F.max(c).alias("high"), F.count_distinct(c).alias("distinct_values")).first()
        bound = statistics.errors(exact["rows"])
        asked = [int(exact["low"] + s * (exact["high"] - exact["low"])) for s in (0.1, 0.25, 0.5, 0.75, 0.9)] if exact["rows"] else []
        shares = at_most(c, asked, exact["rows"])
        ranks = [statistics.share_at_most(whole, c, v).first()["share"] for v in asked]
        often = orders.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        off = statistics.occurrences(counts, c, often, "value").agg(
            F.min(F.col("estimate") - F.col("n")).alias("under"), F.avg((F.col("estimate") - F.col("n") <= bound["count"]).cast("double")).alias("within")).first()
        guess = statistics.distinct_values(whole).where(F.col("column") == c).first()
        depths = [r["upper"] for r in statistics.equi_depth(whole, 10).where(F.col("column") == c).orderBy("bucket").collect()]
        filled = at_most(c, depths, exact["rows"])
        row = (c, *exact, all(abs(a - b) <= bound["rank"] for a, b in zip(shares, ranks)),
               abs((guess["n"] if guess else 0) - exact["distinct_values"]) <= bound["distinct"] * exact["distinct_values"],
               (off["under"] or 0) >= 0 and (off["within"] or 1) >= 0.99,
               all(f >= (i + 1) / 10 - bound["rank"] for i, f in enumerate(filled)), files)
        one = spark.createDataFrame([row], 'column string, rows long, low long, high long, distinct_values long, ranks_within boolean, '
                                           'distinct_within boolean, counts_within boolean, depths_within boolean, files long')
        out = one if out is None else out.union(one)
    return out
