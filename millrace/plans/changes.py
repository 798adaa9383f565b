"""The changelog and the transaction log, read from the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import epoch_ms
from ..operators import changelog
from ..operators.ordered import Running, running
from ..session import load
from .registry import query

# An event is one log entry: purchases put, errors get, the rest append.
# A client's request id is its hour, so later events of an hour are repeats.
LOG_SQL = r"""
log AS (SELECT event_id AS log_index,
  CASE event_type WHEN 'purchase' THEN 'Put' WHEN 'error' THEN 'Get' ELSE 'Append' END AS op,
  'k' || regexp_extract(props, '\d+') AS key, 'x ' || user_id || ' ' || event_id || ' y' AS value,
  user_id AS client, epoch_us(ts) // 3600000000 - event_id % 3 AS request_id FROM events),
applied AS (SELECT * FROM log QUALIFY coalesce(request_id > max(request_id) OVER (
  PARTITION BY client ORDER BY log_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)),
puts AS (SELECT key, max(log_index) AS p FROM applied WHERE op = 'Put' GROUP BY key),
state AS (SELECT key, a.log_index >> 16 AS segment, 0 AS piece, string_agg(value, '' ORDER BY log_index) AS value
  FROM applied a LEFT JOIN puts USING (key)
  WHERE op <> 'Get' AND (p IS NULL OR log_index >= p) GROUP BY ALL)"""


def log_of(events):
    """Events as log rows."""
    return events.select(
        F.col("event_id").alias("log_index"),
        F.when(F.col("event_type") == "purchase", "Put").when(F.col("event_type") == "error", "Get")
        .otherwise("Append").alias("op"),
        F.concat(F.lit("k"), F.regexp_extract("props", r"(\d+)", 1)).alias("key"),
        F.format_string("x %d %d y", "user_id", "event_id").alias("value"),
        F.col("user_id").alias("client"),
        (F.floor(epoch_ms(F.col("ts")) / 3600000) - F.col("event_id") % 3).alias("request_id"))


@query("changelog_dedupe", f"WITH {LOG_SQL} SELECT log_index, op, key, client, request_id FROM applied")
def changelog_dedupe(spark, sf):
    return changelog.dedupe(log_of(load(spark, sf, "events"))).select(
        "log_index", "op", "key", "client", "request_id")


@query("changelog_fold", f"WITH {LOG_SQL} SELECT * FROM state")
def changelog_fold(spark, sf):
    return changelog.fold(log_of(load(spark, sf, "events")))


@query("changelog_fold_segments", f"WITH {LOG_SQL.replace('>> 16', '>> 6')} SELECT * FROM state")
def changelog_fold_segments(spark, sf):
    """The same with segments of 64 log indexes, so that keys have many."""
    return changelog.fold(log_of(load(spark, sf, "events")), bits=6)


@query("kv_get", f"""
WITH {LOG_SQL}
SELECT DISTINCT w.key, coalesce(segment, 0) AS segment, 0 AS piece, coalesce(value, '') AS value
FROM (SELECT 'k' || p_size * 3 AS key FROM part) w LEFT JOIN state USING (key)""")
def kv_get(spark, sf):
    events, part = load(spark, sf, "events", "part")
    wanted = part.select(F.concat(F.lit("k"), (F.col("p_size") * 3).cast("string")).alias("key")).distinct()
    return changelog.get(log_of(events), wanted)


@query("changelog_compact", f"WITH {LOG_SQL} SELECT * FROM state")
def changelog_compact(spark, sf):
    events = load(spark, sf, "events")
    log = log_of(events)
    middle = events.agg(F.floor(F.avg("event_id"))).first()[0]
    return changelog.replay(spark, changelog.compact(log, middle), log)


@query("committed_changes", r"""
WITH log AS (SELECT event_id AS lsn, user_id || '-' || strftime(ts, '%Y%m%d') AS txn,
  CASE event_type WHEN 'signup' THEN 'begin' WHEN 'purchase' THEN 'commit' WHEN 'error' THEN 'abort'
       ELSE 'update' END AS kind, 'k' || regexp_extract(props, '\d+') AS key, value AS after FROM events),
ends AS (SELECT txn, arg_min(kind, lsn) AS outcome, min(lsn) AS end_lsn FROM log
  WHERE kind IN ('commit', 'abort') GROUP BY txn)
SELECT key, arg_max(after, lsn) AS value, max(lsn) AS lsn FROM log JOIN ends USING (txn)
WHERE kind = 'update' AND outcome = 'commit' AND lsn < end_lsn GROUP BY key""")
def committed_changes(spark, sf):
    kind = (F.when(F.col("event_type") == "signup", "begin").when(F.col("event_type") == "purchase", "commit")
            .when(F.col("event_type") == "error", "abort").otherwise("update"))
    log = load(spark, sf, "events").select(
        F.col("event_id").alias("lsn"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("txn"),
        kind.alias("kind"),
        F.concat(F.lit("k"), F.regexp_extract("props", r"(\d+)", 1)).alias("key"),
        F.col("value").alias("after"))
    return changelog.committed_changes(log)


@query("kv_running_value", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS value FROM events""")
def kv_running_value(spark, sf):
    return changelog.running_value(
        load(spark, sf, "events").select("event_id", "user_id"), "user_id", "event_id")


@query("kv_running_value_buckets", """
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS value FROM events""")
def kv_running_value_buckets(spark, sf):
    """The same in buckets of 256 log indexes, two levels of them and more."""
    events = load(spark, sf, "events").select("event_id", "user_id")
    return running(events, ["user_id"], "event_id", {"value": Running("count")}, bits=8)


@query("append_order_check", f"""
WITH {LOG_SQL}
SELECT key, client, count(*) AS markers, bool_and(coalesce(log_index > before, true)) AS in_order FROM (
  SELECT *, max(log_index) OVER (PARTITION BY key, client ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM (
    SELECT *, log_index + CASE WHEN log_index % 5 <> 0 THEN 4000 ELSE 0 END AS n
    FROM applied LEFT JOIN puts USING (key) WHERE op <> 'Get' AND (p IS NULL OR log_index >= p)))
GROUP BY key, client""")
def append_order_check(spark, sf):
    """Every fifth client number is far too low, so some clients are out of order."""
    log = log_of(load(spark, sf, "events"))
    number = F.col("log_index") + F.when(F.col("log_index") % 5 != 0, 4000).otherwise(0)
    marked = log.withColumn("value", F.format_string("x %d %d y", "client", number))
    return changelog.append_order(marked)
