"""Streaming jobs fed from the test tables; results are read back from files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import epoch_ms
from ..operators import joins
from ..session import cut_lineage, load, scratch_path
from ..sources import envelope, kafka, topics
from ..streaming import jobs, processors, run
from .changes import LOG_SQL, log_of
from .registry import query
from .tables import topic_rows

_RECORD = T.StructType().add("key", "long").add("value", "string")
_JOIN_SQL = """
SELECT o_custkey AS key, o_orderstatus || ' ' || o_orderkey AS value, c_custkey AS s_key, c_name AS s_value
FROM orders JOIN customer ON o_custkey = c_custkey"""


def _records(spark, sf):
    """Orders as key/value JSON files."""
    path = scratch_path(spark, "records")
    load(spark, sf, "orders").selectExpr(
        "o_custkey AS key", "concat(o_orderstatus, ' ', o_orderkey) AS value").write.json(path)
    return path


@query("stream_json", "SELECT o_custkey AS key, o_orderstatus || ' ' || o_orderkey AS value FROM orders")
def stream_json(spark, sf):
    records = jobs.read_json(spark, _RECORD, _records(spark, sf))
    records.createOrReplaceTempView("records_stream")
    view = spark.sql("SELECT key, value FROM records_stream")
    return run.all_batches(spark, run.drain(view, "append"), view.schema).drop("batch_id")


@query("stream_kafka", """
SELECT 'Message_' || event_id AS value, epoch_us(ts) // 1000 AS at_ms FROM events""")
def stream_kafka(spark, sf):
    path = scratch_path(spark, "topic")
    topic_rows(spark, sf).write.parquet(path)
    lines = kafka.topic_lines(kafka.stream_topic(spark, "subscribe", "events", files=path), with_time=True)
    out = run.all_batches(spark, run.drain(lines, "append"), lines.schema)
    return out.select("value", F.unix_millis("timestamp").alias("at_ms"))


@query("topic_source", """
SELECT 'events' AS topic, (user_id % 8)::INTEGER AS partition,
  row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) - 1 AS "offset", 'Message_' || event_id AS value,
  lower(lpad(printf('%X', event_id), 16, '0')) AS key
FROM events WHERE user_id % 8 <> 3""")
def topic_source(spark, sf):
    """A topic written in two commits and read by one stream, which stops in mid-topic and goes on from its checkpoint."""
    topics.register(spark)
    path, out, checkpoint = (scratch_path(spark, n) for n in ("topic", "stream", "checkpoint"))
    middle = load(spark, sf, "events").agg(F.floor(F.avg("event_id"))).first()[0] or 0
    rows = topic_rows(spark, sf).select("key", "value", "partition", "offset")
    for half in (rows.where(F.col("offset") < middle), rows.where(F.col("offset") >= middle)):
        parts = spark.sparkContext.defaultParallelism
        ordered = half.repartitionByRange(parts, "partition", "offset").sortWithinPartitions("partition", "offset")
        ordered.drop("offset").write.format("topic").option("topic", "events").mode("append").save(path)
        stream = (spark.readStream.format("topic").option("assign", '{"events": [0, 1, 2, 4, 5, 6, 7]}')
                  .option("startingOffsets", "earliest").load(path))
        run.drain(stream, "append", checkpoint=checkpoint, out=out)
    return run.all_batches(spark, out, stream.schema).select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("value"), F.lower(F.hex("key")).alias("key"))


@query("stream_text_to_envelope", """
SELECT '{"schema":{"type":"string","optional":false},"payload":"' || c_name || '"}' AS value FROM customer""")
def stream_text_to_envelope(spark, sf):
    path = scratch_path(spark, "lines")
    load(spark, sf, "customer").select("c_name").write.text(path)
    wrapped = spark.readStream.text(path).select(envelope.wrap(F.col("value")).alias("value"))
    return run.all_batches(spark, run.drain(wrapped, "append"), wrapped.schema).drop("batch_id")


@query("stream_envelope_to_text", "SELECT c_name AS value FROM customer")
def stream_envelope_to_text(spark, sf):
    path, out = scratch_path(spark, "topic"), scratch_path(spark, "text")
    load(spark, sf, "customer").select(envelope.wrap(F.col("c_name")).alias("value")).write.text(path)
    lines = spark.readStream.text(path).select(envelope.unwrap(F.col("value")).alias("value"))
    query_ = (lines.writeStream.format("text").outputMode("append").option("path", out)
              .option("checkpointLocation", scratch_path(spark, "checkpoint"))
              .trigger(availableNow=True).start())
    query_.awaitTermination()
    return spark.read.text(out)


@query("console_sink", """
SELECT o_orderstatus AS value, count(*) AS count FROM orders GROUP BY o_orderstatus""")
def console_sink(spark, sf):
    """What the console would show in update mode, kept in files."""
    lines = run.stream_table(spark, f"{sf}/orders.parquet").select(F.col("o_orderstatus").alias("value"))
    counts = jobs.word_counts(lines)
    rows = run.all_batches(spark, run.drain(counts, "update"), counts.schema)
    return run.latest_update(rows, ["value"])


@query("join_stream_static", _JOIN_SQL)
def join_stream_static(spark, sf):
    table = load(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS value")
    path = _records(spark, sf)
    hot = joins.hot_keys(spark.read.schema(_RECORD).json(path), "key", spark.sparkContext.defaultParallelism)
    joined = jobs.join_static(jobs.read_json(spark, _RECORD, path), table, hot)
    return run.all_batches(spark, run.drain(joined, "update"), joined.schema).drop("batch_id")


@query("stream_static_join", _JOIN_SQL)
def stream_static_join(spark, sf):
    """The same join batch by batch, with the hot keys of a batch spread."""
    table = load(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS value")
    out = scratch_path(spark, "joined")
    records = jobs.read_json(spark, _RECORD, _records(spark, sf))
    run.drain(records, "append", jobs.join_static_batches(table, out))
    schema = T.StructType([*_RECORD.fields, T.StructField("s_key", T.LongType()),
                           T.StructField("s_value", T.StringType())])
    return run.all_batches(spark, out, schema).drop("batch_id")


@query("stream_word_count", """
SELECT value, count(*) AS count FROM (
  SELECT unnest(CASE WHEN regexp_full_match(text, ' +') THEN [] ELSE
    string_split(rtrim(text, ' '), ' ') END) AS value FROM conversations) GROUP BY value""")
def stream_word_count(spark, sf):
    lines = run.stream_table(spark, f"{sf}/conversations.parquet").select(F.col("text").alias("value"))
    counts = jobs.word_counts(lines)
    return run.latest_batch(spark, run.drain(counts, "complete"), counts.schema)


_LINES = "concat(event_type, ' u', user_id)"


def _lines(spark, path):
    return run.stream_table(spark, path).selectExpr(f"{_LINES} AS value", "ts AS timestamp")


def _timed(words):
    return words.select("session_id", epoch_ms(F.col("timestamp")).alias("at_ms"))


_SESSIONS = """
SELECT id, max(t_ms) - min(t_ms) AS duration_ms, count(*) AS num_events, {expired} AS expired FROM (
  SELECT unnest([event_type, 'u' || user_id]) AS id, epoch_us(ts) // 1000 AS t_ms FROM events) GROUP BY id"""


@query("stream_flatmap", """
SELECT unnest([event_type, 'u' || user_id]) AS session_id, epoch_us(ts) // 1000 AS at_ms FROM events""")
def stream_flatmap(spark, sf):
    words = _timed(jobs.word_events(_lines(spark, f"{sf}/events.parquet")))
    return run.all_batches(spark, run.drain(words, "append"), words.schema).drop("batch_id")


def _drained(spark, pieces, job, checkpoint=None, settings=None):
    """Feed ``pieces`` one after the other; each time the stream goes on from its checkpoint until it has read all."""
    path, out = (scratch_path(spark, n) for n in ("pieces", "stream"))
    checkpoint = checkpoint or scratch_path(spark, "checkpoint")
    for piece in pieces:
        piece.write.mode("append").parquet(path)
        stream = job(spark.readStream.schema(piece.schema).parquet(path))
        run.drain(stream, "update", checkpoint=checkpoint, out=out, settings=settings)
    return run.all_batches(spark, out, stream.schema)


def _session_job(stream):
    words = jobs.word_events(stream.selectExpr(f"{_LINES} AS value", "ts AS timestamp"))
    return jobs.sessionize(_timed(words), timeout_ms=3_600_000)


@query("stream_sessionize", _SESSIONS.format(expired="false"))
def stream_sessionize(spark, sf):
    """The last update of every session; the events come in three parts, by time."""
    events = load(spark, sf, "events")
    at = epoch_ms(F.col("ts"))
    cuts = events.select(at.alias("at")).approxQuantile("at", [1 / 3, 2 / 3], 0.01) or [0, 0]
    pieces = [events.where(at < cuts[0]), events.where((at >= cuts[0]) & (at < cuts[1])), events.where(at >= cuts[1])]
    return run.latest_update(_drained(spark, pieces, _session_job), ["id"])


_GAP_MS = 7_200_000


@query("session_processor", f"""
WITH e AS (SELECT unnest([event_type, 'u' || user_id]) AS id, epoch_us(ts) // 1000 AS t FROM events),
  cuts AS (SELECT min(t) AS low, (max(t) - min(t)) // 4 + 1 AS width FROM e),
  marks AS (SELECT coalesce(max(t) FILTER ((t - low) // width = 0), 0) AS first_mark,
    coalesce(max(t) FILTER ((t - low) // width = 2), 0) AS last_mark
    FROM e, cuts),
  runs AS (SELECT id, t, sum(fresh) OVER (PARTITION BY id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT id, t, CASE WHEN t - lag(t) OVER (PARTITION BY id ORDER BY t) <= {_GAP_MS} THEN 0 ELSE 1 END AS fresh FROM e)),
  sessions AS (SELECT id, min(t) AS start_ms, max(t) AS end_ms, count(*) AS num_events FROM runs GROUP BY id, run)
SELECT s.*, s.end_ms + {_GAP_MS} <= last_mark AS expired,
  s.end_ms + {_GAP_MS} <= first_mark AS expired_in_first_run
FROM sessions s, marks""")
def session_processor(spark, sf):
    """Sessions by event time over four parts of the events: two in a first run, two in a run that takes its state over."""
    events = load(spark, sf, "events")
    at = epoch_ms(F.col("ts"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    width = ((high or 0) - (low or 0)) // 4 + 1
    part = F.floor((at - F.lit(low or 0)) / width)
    # Dealt out by the rows' hash, as a stretch of time may lie in one split of the table.
    piece = lambda i: events.where(part == i).repartition(spark.sparkContext.defaultParallelism, *events.columns)
    job = lambda initial: lambda stream: processors.session_machine(
        _timed(jobs.word_events(stream.selectExpr(f"{_LINES} AS value", "ts AS timestamp"))), _GAP_MS, initial)
    state, over = None, None
    for i in (0, 2):
        checkpoint = scratch_path(spark, "checkpoint")
        rows = _drained(spark, [piece(i), piece(i + 1)], job(state), checkpoint, processors.ROCKSDB)
        ended = rows.where("expired").select("id", "start_ms", "end_ms", "num_events", "expired", F.lit(i == 0).alias("expired_in_first_run"))
        over = ended if over is None else over.union(ended)
        state = cut_lineage(processors.session_state(spark, checkpoint), "sessions")
    held = state.where("start_ms IS NOT NULL").select("id", "start_ms", "end_ms", F.col("n").alias("num_events"),
                                                      F.lit(False).alias("expired"), F.lit(False).alias("expired_in_first_run"))
    return over.union(held)


def _add_spending(key, parts, old):
    """Events of a user and the cents spent."""
    n, cents = old or (0, 0)
    for part in parts:
        n, cents = n + len(part), cents + int(part["cents"].sum())
    return n, cents


@query("state_fn", """
SELECT user_id AS id, count(*) AS num_events, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
  false AS expired FROM events GROUP BY user_id""")
def state_fn(spark, sf):
    """A user's own state function, over two parts of the events."""
    events = load(spark, sf, "events").selectExpr("event_id", "user_id", "cast(round(value * 100) AS bigint) AS cents")
    middle = events.agg(F.floor(F.avg("event_id"))).first()[0] or 0
    job = lambda stream: jobs.stateful(
        stream.select("user_id", "cents"), "user_id", _add_spending, lambda key, state, expired: (key, *state, expired),
        "id long, num_events long, cents long, expired boolean", "num_events long, cents long", 3_600_000)
    pieces = [events.where(F.col("event_id") < middle), events.where(F.col("event_id") >= middle)]
    return run.latest_update(_drained(spark, pieces, job), ["id"])


@query("session_timeout", _SESSIONS.format(expired="true"))
def session_timeout(spark, sf):
    """The final row of every session, some seconds after its last event; ends when all sessions have ended."""
    words = _timed(jobs.word_events(_lines(spark, f"{sf}/events.parquet")))
    stored = load(spark, sf, "events").selectExpr(f"{_LINES} AS value", "ts AS timestamp")
    sessions = jobs.word_events(stored).select("session_id").distinct().count()
    done = lambda rows: rows.where("expired").count() >= sessions
    rows = run.Until(jobs.sessionize(words, timeout_ms=2000), "update").wait(done).stop()
    return rows.where("expired").drop("batch_id")


@query("session_merge_rule", """
WITH e AS (SELECT unnest([event_type, 'u' || user_id]) AS id, epoch_us(ts) // 1000 AS t_ms,
  event_id >= (SELECT floor(avg(event_id)) FROM events) AS early_batch FROM events)
SELECT id, max(t_ms) - coalesce(min(t_ms) FILTER (early_batch), min(t_ms)) AS duration_ms, count(*) AS num_events,
       false AS expired FROM e GROUP BY id""")
def session_merge_rule(spark, sf):
    """The later half arrives first; earlier events then leave the start alone."""
    events = load(spark, sf, "events")
    middle = events.agg(F.floor(F.avg("event_id"))).first()[0] or 0
    pieces = [events.where(F.col("event_id") >= middle), events.where(F.col("event_id") < middle)]
    return run.latest_update(_drained(spark, pieces, _session_job), ["id"])


@query("stream_changelog", f"WITH {LOG_SQL} SELECT * FROM state")
def stream_changelog(spark, sf):
    """Three batches in log order, the second one twice, and a compaction after it that covers the repeat."""
    log = log_of(load(spark, sf, "events"))
    low, high = log.agg(F.min("log_index"), F.max("log_index")).first()
    third = ((high or 0) - (low or 0)) // 3 + 1
    batches = [log.where(F.col("log_index").between((low or 0) + i * third, (low or 0) + (i + 1) * third - 1)) for i in range(3)]
    table = jobs.ChangelogTable(spark)
    table.apply(batches[0], 0)
    table.apply(batches[1], 1)
    table = table.compact(scratch_path(spark, "compacted"))
    table.apply(batches[1], 1)
    table.apply(batches[2], 2)
    return table.state()


@query("stream_changelog_drained", f"WITH {LOG_SQL} SELECT * FROM state")
def stream_changelog_drained(spark, sf):
    log = log_of(run.stream_table(spark, f"{sf}/events.parquet"))
    table = jobs.ChangelogTable(spark)
    run.drain(log, "append", table.apply)
    return table.state()


@query("stream_kv_sum", """
SELECT user_id AS key, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS val FROM events GROUP BY user_id""")
def stream_kv_sum(spark, sf):
    sums = jobs.key_sums(run.stream_table(spark, f"{sf}/events.parquet").selectExpr(
        "user_id AS key", "cast(round(value * 100) AS bigint) AS val"))
    rows = run.all_batches(spark, run.drain(sums, "update"), sums.schema)
    return run.latest_update(rows, ["key"])


@query("stream_first_seen", """
SELECT user_id || '-' || epoch_us(ts) // 3600000000 AS request, min(event_id) AS event_id FROM events GROUP BY 1""")
def stream_first_seen(spark, sf):
    """The first event of each user and hour, over two parts; a request is known for a day."""
    events = load(spark, sf, "events")
    rows = events.select(F.concat_ws("-", "user_id", F.floor(epoch_ms(F.col("ts")) / 3_600_000)).alias("request"), "event_id")
    middle = events.agg(F.floor(F.avg("event_id"))).first()[0] or 0
    pieces = [rows.where(F.col("event_id") < middle), rows.where(F.col("event_id") >= middle)]
    job = lambda stream: processors.first_seen(stream, "request", 86_400_000)
    return _drained(spark, pieces, job, settings=processors.ROCKSDB).select("request", "event_id")
