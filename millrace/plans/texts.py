"""Word jobs, sorting, buckets and user functions on the text tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.hashing import hash_bucket as bucket_of
from ..functions.hashing import shard_bucket as shard_of
from ..operators import comparator, partitioning, postings, textjobs
from ..session import conversations, cut_lineage, documents, load
from .registry import query
from .tables import fnv_sql, words_sql

_DOC_WORDS = f"SELECT unnest({words_sql('text')}) AS word FROM documents"
_TALK_WORDS = f"SELECT unnest({words_sql('text')}) AS word FROM conversations"
_PAIRS = f"SELECT DISTINCT doc_id, unnest({words_sql('text')}) AS word FROM documents"
_DOC_NAME = "'doc-' || lpad(CAST(doc_id AS VARCHAR), 19, '0')"


@query("word_count", f"SELECT word, count(*) AS count FROM ({_DOC_WORDS}) GROUP BY word")
def word_count(spark, sf):
    return textjobs.word_count(documents(spark, sf), "text")


@query("inverted_index", f"""
WITH pairs AS ({_PAIRS}),
totals AS (SELECT word, count(*) AS n_docs FROM pairs GROUP BY word)
SELECT word, n_docs, doc_id >> 14 AS segment, string_agg({_DOC_NAME}, ',' ORDER BY doc_id) AS docs
FROM pairs JOIN totals USING (word) GROUP BY ALL""")
def inverted_index(spark, sf):
    return textjobs.inverted_index(documents(spark, sf), "doc_id", "text")


@query("inverted_index_segments", f"""
WITH pairs AS ({_PAIRS}),
totals AS (SELECT word, count(*) AS n_docs FROM pairs GROUP BY word)
SELECT word, n_docs, doc_id >> 6 AS segment, string_agg({_DOC_NAME}, ',' ORDER BY doc_id) AS docs
FROM pairs JOIN totals USING (word) GROUP BY ALL""")
def inverted_index_segments(spark, sf):
    """The same with segments of 64 documents, so that frequent words have many."""
    return textjobs.inverted_index(documents(spark, sf), "doc_id", "text", bits=6)


@query("inverted_index_names", f"""
WITH pairs AS (SELECT DISTINCT 'talk-' || conv_id || '-' || turn AS name, unnest({words_sql('text')}) AS word FROM conversations)
SELECT word, count(*) OVER (PARTITION BY word) AS n_docs, name FROM pairs""")
def inverted_index_names(spark, sf):
    """The index of named records, one row per word and name."""
    talks = conversations(spark, sf).select(F.concat_ws("-", F.lit("talk"), "conv_id", "turn").alias("name"), "text")
    index = textjobs.inverted_index_by_name(talks, "name", "text", bits=33)
    return index.select("word", "n_docs", F.explode(F.split("docs", ",")).alias("name"))


@query("distinct_keys", f"SELECT DISTINCT word AS key, '' AS value FROM ({_DOC_WORDS}) ORDER BY key")
def distinct_keys(spark, sf):
    return textjobs.distinct_keys(documents(spark, sf), "text")


@query("top_k_counts", f"""
SELECT * FROM (SELECT word, count(*) AS count FROM ({_DOC_WORDS}) GROUP BY word
               ORDER BY count DESC, word DESC LIMIT 10) ORDER BY count, word""")
def top_k_counts(spark, sf):
    return textjobs.top_counts(textjobs.word_count(documents(spark, sf), "text"))


@query("top_k_index", f"""
WITH pairs AS ({_PAIRS}),
best AS (SELECT word, count(*) AS n_docs FROM pairs GROUP BY word
         HAVING NOT bool_or(contains({_DOC_NAME}, '16')) AND NOT contains(word, '16')
            AND NOT contains(CAST(count(*) AS VARCHAR), '16')
         ORDER BY n_docs DESC, word DESC LIMIT 10)
SELECT word, n_docs, doc_id >> 14 AS segment, string_agg({_DOC_NAME}, ',' ORDER BY doc_id) AS docs
FROM pairs JOIN best USING (word) GROUP BY ALL""")
def top_k_index(spark, sf):
    return textjobs.top_index(documents(spark, sf), "doc_id", "text")


@query("sort_keys", f"SELECT DISTINCT word FROM ({_TALK_WORDS}) ORDER BY word")
def sort_keys(spark, sf):
    return textjobs.words(conversations(spark, sf), "text").distinct().orderBy("word")


@query("hash_bucket", f"""
SELECT word, CAST({fnv_sql('word')} % 2147483648 % 7 AS INT) AS bucket
FROM (SELECT DISTINCT word FROM ({_TALK_WORDS}))""")
def hash_bucket(spark, sf):
    keys = textjobs.words(conversations(spark, sf), "text").distinct()
    return keys.select("word", bucket_of(F.col("word"), 7).alias("bucket"))


@query("shard_bucket", f"""
SELECT word, CAST(CAST(('0x' || substr(hex(encode(word)), 1, 2)) AS INT) % 10 AS INT) AS shard
FROM (SELECT DISTINCT word FROM ({_TALK_WORDS}))""")
def shard_bucket(spark, sf):
    keys = textjobs.words(conversations(spark, sf), "text").distinct()
    return keys.select("word", shard_of(F.col("word")).alias("shard"))


@query("range_slices", """
WITH k AS (SELECT CAST(o_orderkey AS HUGEINT) * 11400714819323198485 % 18446744073709551616 AS key FROM orders)
SELECT CAST(least(key // (18446744073709551615::HUGEINT // 64), 63) AS INT) AS slice, count(*) AS n,
       CAST(min(key) AS VARCHAR) AS first_key, CAST(max(key) AS VARCHAR) AS last_key
FROM k GROUP BY 1""")
def range_slices(spark, sf):
    """Order keys scattered over the unsigned 64-bit range."""
    keys = load(spark, sf, "orders").selectExpr(
        "cast(cast(o_orderkey AS decimal(18,0)) * 11400714819323198485BD % 18446744073709551616BD "
        "AS decimal(20,0)) AS key")
    return partitioning.slice_summary(keys, "key", 64).select(
        "slice", "n", *[F.col(c).cast("string").alias(c) for c in ("first_key", "last_key")])


@query("key_ranges", """
WITH k AS (SELECT CAST(o_orderkey AS HUGEINT) * 11400714819323198485 % 18446744073709551616 AS key FROM orders),
r AS (SELECT i::INT AS slice, i::HUGEINT * (18446744073709551615::HUGEINT // 64) AS first,
  CASE WHEN i = 63 THEN 18446744073709551616::HUGEINT ELSE (i + 1)::HUGEINT * (18446744073709551615::HUGEINT // 64) END AS after
  FROM range(64) t(i))
SELECT slice, first::VARCHAR AS first, after::VARCHAR AS after, count(key) AS n
FROM r LEFT JOIN k ON key >= first AND key < after GROUP BY ALL""")
def key_ranges(spark, sf):
    """Every range with its bounds and the number of keys in it."""
    ranges = [(i, str(a), str(b)) for i, (a, b) in enumerate(partitioning.key_ranges(64))]
    bounds = spark.createDataFrame(ranges, "slice int, first string, after string")
    counts = range_slices(spark, sf).select("slice", "n")
    return bounds.join(counts, "slice", "left").select("slice", "first", "after", F.coalesce("n", F.lit(0)).alias("n"))


@query("custom_slicer", """
SELECT CASE WHEN o_orderpriority < '3' THEN 0 ELSE CAST(o_custkey % 4 AS INT) + 1 END AS slice,
       count(*) AS n, min(o_orderkey) AS first_key FROM orders GROUP BY 1""")
def custom_slicer(spark, sf):
    slicer = F.when(F.col("o_orderpriority") < "3", F.lit(0)).otherwise(
        (F.col("o_custkey") % 4).cast("int") + 1)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return partitioning.sliced(orders, slicer).groupBy("slice").agg(F.count(F.lit(1)).alias("n"),
                                       F.min("o_orderkey").alias("first_key"))


@query("slicer_fn", """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 6 THEN 0 ELSE (o_custkey % 3 + 1)::INTEGER END AS slice FROM orders),
  counts AS (SELECT slice, count(*) AS n FROM o GROUP BY slice),
  numbers AS (SELECT slice, greatest(1, (n * 16 + sum(n) OVER () - 1) // sum(n) OVER ())::INTEGER AS number FROM counts),
  layout AS (SELECT slice, number, (sum(number) OVER (ORDER BY slice) - number)::INTEGER AS first FROM numbers)
SELECT o_orderkey, slice, (first + o_orderkey % number)::INTEGER AS part, (first + o_orderkey % number)::INTEGER AS partition
FROM o JOIN layout USING (slice)""")
def slicer_fn(spark, sf):
    """A user's slicer decides the partition; the slice with most rows is dealt over several."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    slicer = F.when(F.col("o_orderkey") % 10 < 6, 0).otherwise(F.col("o_custkey") % 3 + 1)
    dealt = partitioning.repartition_sliced(orders, slicer, 16, spread=F.col("o_orderkey"))
    return dealt.select("o_orderkey", "slice", "part", F.spark_partition_id().alias("partition"))


@query("balanced_slices", """
SELECT count(*) AS rows, 8 AS parts, true AS apart, true AS even, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders""")
def balanced_slices(spark, sf):
    """Eight ranges of about equal size: ranges don't overlap, and none is twice as large as the mean."""
    parts = partitioning.repartition_balanced(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 8)
    told = parts.groupBy(F.spark_partition_id().alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    below = F.lag("high").over(Window.orderBy("part"))  # one row per part
    return told.withColumn("apart", F.coalesce(F.col("low") > below, F.lit(True))).agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).cast("int").alias("parts"), F.min("apart").alias("apart"),
        (F.max("n") <= 2 * F.avg("n")).alias("even"), F.min("low").alias("first_key"), F.max("high").alias("last_key"))


def larger_together(a: tuple, b: tuple) -> int:
    """Which of two digit texts comes first if all are to be put together to the largest number."""
    return (a[0] + b[0] < b[0] + a[0]) - (a[0] + b[0] > b[0] + a[0])


@query("sort_comparator", """
WITH k AS (SELECT o_custkey::VARCHAR AS word, count(*) AS n FROM orders GROUP BY 1),
  ranks AS (SELECT a.word, 1 + coalesce(sum(b.n) FILTER (b.word || a.word > a.word || b.word), 0)::BIGINT AS rank FROM k a, k b GROUP BY a.word)
SELECT o_orderkey, word, rank FROM orders JOIN ranks ON word = o_custkey::VARCHAR""")
def sort_comparator(spark, sf):
    """Orders by a comparison of two customer numbers that no expression of one of them states."""
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("word"))
    return comparator.sort_by(orders, ["word"], larger_together).select("o_orderkey", "word", "rank")


# --- user functions: the classic word jobs as hooks -----------------------

def map_words(name: str, contents: str):
    return [(word, "1") for word in contents.split()]


def count_values(key: str, values: list[str]) -> str:
    return str(len(values))


def add_counts(key: str, counts: list[str]) -> str:
    return str(sum(map(int, counts)))


def latest(key: str, values: list[str]) -> str:
    return max(values)


@query("mr_group_reduce", """
SELECT CAST(user_id AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY user_id""")
def mr_group_reduce(spark, sf):
    """Counts by user functions, in order of key."""
    pairs = load(spark, sf, "events").selectExpr("cast(user_id AS string) AS key", "event_type AS value")
    return textjobs.reduce_groups(pairs, count_values, add_counts).orderBy("key")


@query("mr_job", f"""
SELECT CAST({fnv_sql('word')} % 2147483648 % 3 AS INT) AS bucket, word AS key, CAST(count(*) AS VARCHAR) AS value
FROM ({_TALK_WORDS}) GROUP BY word""")
def mr_job(spark, sf):
    talks = conversations(spark, sf).selectExpr(
        "concat('talk-', conv_id, '-', turn) AS name", "text")
    return textjobs.run_job(talks, "name", "text", map_words, count_values, add_counts, 3)


@query("map_pairs", f"SELECT word AS key, '1' AS value, count(*) AS n FROM ({_TALK_WORDS}) GROUP BY word")
def map_pairs(spark, sf):
    """What the map hook emits without a combiner, counted here."""
    talks = conversations(spark, sf).selectExpr("concat('talk-', conv_id, '-', turn) AS name", "text")
    return textjobs.map_files(talks, "name", "text", map_words).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


@udtf(returnType="key string, value string", useArrow=True)
class WordPairs:
    """The map hook as a table function: one call per record."""

    def eval(self, name: str, contents: str):
        yield from map_words(name, contents)


@query("udtf_map", f"""
SELECT conv_id, turn, key, '1' AS value, count(*) AS n
FROM (SELECT conv_id, turn, unnest({words_sql('text')}) AS key FROM conversations) GROUP BY ALL""")
def udtf_map(spark, sf):
    talks = conversations(spark, sf)
    pairs = talks.lateralJoin(WordPairs(F.col("conv_id").cast("string").outer(), F.col("text").outer()))
    return pairs.groupBy("conv_id", "turn", "key", "value").agg(F.count(F.lit(1)).alias("n"))


@query("udaf_reduce", """
SELECT CAST(user_id AS VARCHAR) AS key, max(event_type || ' ' || props) AS value FROM events GROUP BY user_id""")
def udaf_reduce(spark, sf):
    pairs = load(spark, sf, "events").selectExpr(
        "cast(user_id AS string) AS key", "concat(event_type, ' ', props) AS value")
    return textjobs.reduce_groups(pairs, latest, latest)


def _add_event(state: list, row) -> list:
    """[changes, run, longest run, last type] after one more event."""
    changes, run, longest, last = state
    same = row["event_type"] == last
    run = run + 1 if same else 1
    return [changes + (last is not None and not same), run, max(longest, run), row["event_type"]]


@query("udtf_reduce", """
WITH e AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS last FROM events),
  runs AS (SELECT user_id, count(*) FILTER (event_type <> last) OVER (PARTITION BY user_id ORDER BY event_id) AS run, event_type, last FROM e),
  lengths AS (SELECT user_id, run, count(*) AS n, count(*) FILTER (event_type <> last) AS changes FROM runs GROUP BY ALL)
SELECT user_id, CAST(sum(changes) AS BIGINT) AS changes, max(n) AS longest FROM lengths GROUP BY user_id""")
def udtf_reduce(spark, sf):
    """A user's reduce that depends on the order: changes of the event type, and the longest run of one type."""
    events = load(spark, sf, "events").select("user_id", "event_id", "event_type")
    return textjobs.ordered_reduce(events, "user_id", "event_id", lambda: [0, 0, 0, None], _add_event,
                                   lambda state: (state[0], state[2]), "changes long, longest long")


@query("postings_all_words", f"""
WITH pairs AS ({_PAIRS}), ranked AS (
  SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) AS r FROM pairs GROUP BY word),
q(query, r) AS (VALUES ('first two', 1), ('first two', 2), ('far apart', 1), ('far apart', 60), ('far apart', 400),
  ('rare', 60), ('rare', 2000), ('three', 3), ('three', 10), ('three', 30))
SELECT query, doc_id AS doc FROM q JOIN ranked USING (r) JOIN pairs USING (word)
GROUP BY query, doc_id HAVING count(*) = (SELECT count(*) FROM q AS o WHERE o.query = q.query)""")
def postings_all_words(spark, sf):
    """Documents that hold all of some words, from bitmaps; the words are chosen by their rank in frequency."""
    index = cut_lineage(postings.build(documents(spark, sf), "doc_id", "text"), "index")
    ranks = {"first two": (1, 2), "far apart": (1, 60, 400), "rare": (60, 2000), "three": (3, 10, 30)}
    top = index.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(max(map(max, ranks.values()))).collect()
    asked = {name: [top[r - 1]["word"] for r in rs if r <= len(top)] for name, rs in ranks.items()}
    return postings.documents_with_all(index, {name: words for name, words in asked.items() if len(words) == len(ranks[name])})
