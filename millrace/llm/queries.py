"""The registered queries of this folder, with SQL where SQL can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, centroids, exact_dedup, language, licenses, line_dedup, packing, sharding, simhash,
               sketches, spelling, substrings, toxicity)
from .common import read_documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = [f"shard-{i:02d}" for i in range(32)]


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    """The text of a vocabulary file, from the folder in MILLRACE_TOKENIZERS or else the installed files."""
    folder = os.environ.get("MILLRACE_TOKENIZERS")
    if folder:
        return packing.read_spec(os.path.join(folder, name))
    import public_tokenizers

    return packing.read_spec(public_tokenizers.path(name))


# Each step, the shard whose turn it is claims the first free slot of its own order.
_FILL = """
  pref{n} AS (
    SELECT i, (('0x' || substr(md5('start:' || 'shard-' || lpad(i::VARCHAR, 2, '0')), 1, 15))::BIGINT) % 4099 AS start,
      (('0x' || substr(md5('step:' || 'shard-' || lpad(i::VARCHAR, 2, '0')), 1, 15))::BIGINT) % 4098 + 1 AS step
    FROM range({n}) r(i)),
  fill{n} AS (
    SELECT 0::BIGINT AS turn, [-1 FOR x IN range(4099)] AS slots
    UNION ALL
    SELECT turn + 1, list_concat(slots[1:spot], [i], slots[spot + 2:4099])
    FROM (
      SELECT turn, slots, i, (start + step * list_position([slots[((start + step * j) % 4099) + 1] < 0 FOR j IN range(
        least(4099, reach))], true) - step) % 4099 AS spot
      FROM (SELECT f.turn, f.slots, p.i, p.start, p.step, 4099 AS reach
            FROM fill{n} f JOIN pref{n} p ON p.i = f.turn % {n} WHERE f.turn < 4099))),
  table{n} AS (
    SELECT unnest(range(4099)) AS slot, unnest(slots) AS shard FROM fill{n} WHERE turn = 4099)"""


@query("op2_sharding", f"""
WITH RECURSIVE {_FILL.format(n=32)}, {_FILL.format(n=31)},
  placed AS (
    SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT) % 4099 AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(a.shard::VARCHAR, 2, '0') AS shard,
  'shard-' || lpad(b.shard::VARCHAR, 2, '0') AS shard_after
FROM placed JOIN table32 a USING (slot) JOIN table31 b USING (slot)""")
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard_rows(read_documents(spark, folder), "doc_id", SHARDS, without=SHARDS[-1:])
    return placed.select("doc_id", "slot", "shard", "shard_after")


@query("op4_packing")
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_documents(spark, folder), vocabulary("word_bpe_49k.json"))


@query("op5_exact_dedup", """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)""")
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_documents(spark, folder)).drop("row")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs, spec = read_documents(spark, folder), vocabulary("byte_bpe_50k.json")
    encoded = bpe.encode(docs, spec, bpe.compile_lexicon(docs, spec))
    return bpe.decode(encoded, spec).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


@query("op1_simhash")
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, folder)).drop("component")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.score(docs, toxicity.fit(toxicity.labelled_rows(docs, labels), 2, severe_from=10))


@query("op9_language")
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read_documents(spark, folder))


@query("op7_substrings")
def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(read_documents(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = sketches.edited_texts(read_documents(spark, folder))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketches.fingerprint(F.col("sketch")).alias("fingerprint"),
        sketches.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketches.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketches.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        sketches.containment(F.col("sketch"), F.col("edited_sketch")).alias("held_in_edited"),
        sketches.distinct_shingles(F.col("sketch")).alias("shingles"))


def _license_sql() -> str:
    """Every alignment of every template by joining on all its words, with no index."""
    known = [*licenses.BASE, *licenses.MORE, *licenses.NOTICES]
    words = ", ".join(f"({n}, {k}, '{w}')" for n, t in enumerate(known) for k, w in enumerate(t.words))
    heads = ", ".join(f"({n}, '{t.label}', {str(t.base).lower()}, {t.key_at}, {len(t.key.split())}, "
                      f"{1 if t.base else licenses.COVER})" for n, t in enumerate(known))
    return f"""
WITH heads(t, label, base, key_at, key_size, cover) AS (VALUES {heads}), lexicon(t, k, word) AS (VALUES {words}),
  d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
  w AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM d),
  df AS (
    SELECT l.word, ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT w.r) + 1)) + 1 AS weight
    FROM (SELECT DISTINCT word FROM lexicon) l LEFT JOIN w USING (word) GROUP BY l.word),
  shares AS (SELECT t, k, word, weight / sum(weight) OVER (PARTITION BY t) AS share FROM lexicon JOIN df USING (word)),
  places AS (
    SELECT w.r, s.t, w.i - s.k AS start, sum(share) AS score, count(*) FILTER (k >= key_at AND k < key_at + key_size) AS keys
    FROM w JOIN shares s USING (word) JOIN heads h ON h.t = s.t GROUP BY ALL),
  found AS (
    SELECT p.r, p.start, p.score, h.label, h.base FROM places p JOIN heads h USING (t)
    WHERE p.keys = h.key_size AND p.score >= h.cover - 1e-9),
  sums AS (
    SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
      string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
    FROM found GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, round(coalesce(score, 0), 6) AS score
FROM d LEFT JOIN sums USING (r)"""


@query("op10_licenses", _license_sql())
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(licenses.scan(read_documents(spark, folder), [*licenses.MORE, *licenses.NOTICES]))


@query("op11_line_dedup", """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
  l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
  k AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
  repeated AS (
    SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
  marked AS (SELECT k.*, s.key IS NOT NULL AND doc_id < owner AS gone FROM k LEFT JOIN repeated s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r""")
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.remove_lines(read_documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


# Each step takes all vectors to their nearest centroid and the centroids to the floor of their means. The numbers are
# integers below 2**53, so sums of doubles are exact.
_DISTANCES = """list_transform({cs}, lambda m: list_inner_product({q}, {q}) - 2 * list_inner_product({q}, m) + list_inner_product(m, m))"""


@query("op12_centroids", f"""
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  heads AS (SELECT sha256('3:' || coalesce(vec_id::VARCHAR, '')) AS h, q FROM v ORDER BY h, q LIMIT 8),
  lloyd AS (
    SELECT 0 AS round, list(q ORDER BY h, q) AS cs FROM heads HAVING count(*) > 0
    UNION ALL
    SELECT round + 1, list(mean ORDER BY c) FROM (
      SELECT round, c, list(coalesce(floor(total / n), old) ORDER BY i) AS mean FROM (
        SELECT round, c, i, any_value(cs[c][i]) AS old, sum(q[i]) FILTER (near = c) AS total, count(*) FILTER (near = c) AS n
        FROM (
          SELECT round, cs, q, list_position(ds, list_min(ds)) AS near
          FROM (SELECT round, cs, q, {_DISTANCES.format(cs="cs", q="q")} AS ds FROM lloyd, v WHERE round < 10)),
          range(1, 9) a(c), range(1, 65) b(i)
        WHERE c <= len(cs) GROUP BY round, c, i)
      GROUP BY round, c)
    GROUP BY round),
  ends AS (SELECT vec_id, cs, {_DISTANCES.format(cs="cs", q="q")} AS ds FROM v, (SELECT cs FROM lloyd WHERE round = 10)),
  told AS (
    SELECT vec_id, cs, (list_position(ds, list_min(ds)) - 1)::INTEGER AS cluster, list_min(ds)::BIGINT AS distance FROM ends)
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(cs[cluster + 1], lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM told""")
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(spark.read.parquet(f"{folder}/embeddings.parquet"))


# crc32 by its table, near words by equal texts with one place left out, roots by steps.
@query("op13_spelling", """
WITH RECURSIVE crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
      SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
      FROM range(256) r(i))),
  runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-zÀ-ÿ]+')) AS run FROM documents),
  held AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
  bytes AS (SELECT run, n, hex(coalesce(doc_id::VARCHAR, '') || ':' || run) AS x FROM held),
  hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
      lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM bytes, crc),
  words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
      SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
      FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
  less AS (
    SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
  changed AS (SELECT a.word AS a, b.word AS b FROM less a JOIN less b USING (head, tail) WHERE a.word <> b.word),
  inserted AS (SELECT DISTINCT l.word AS a, w.word AS b FROM less l JOIN words w ON w.word = l.head || l.tail),
  near AS (SELECT a, b FROM changed UNION SELECT a, b FROM inserted UNION SELECT b, a FROM inserted),
  best AS (
    SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS form, max(w.n) AS form_n
    FROM near JOIN words w ON w.word = b GROUP BY a),
  told AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
    CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
  chain AS (
    SELECT word, word AS root FROM told
    UNION ALL
    SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.root WHERE t.form IS NOT NULL)
SELECT t.word, t.form, c.root, t.n, t.n_near, t.form_n
FROM told t JOIN chain c USING (word) JOIN told r ON r.word = c.root WHERE r.form IS NULL""")
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read_documents(spark, folder))
