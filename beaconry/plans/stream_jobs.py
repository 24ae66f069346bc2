"""Streams over the given tables, run to the end of their input; each writes a table and the job returns it."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed, schemas
from beaconry.operators import normalize
from beaconry.plans import check_sql as sql
from beaconry.plans.context_jobs import OWNED_CRUMBS
from beaconry.plans.registry import job
from beaconry.plans.session_jobs import FOLDED
from beaconry.session import scratch_dir
from beaconry.sources import envelopes as env, tables as t
from beaconry.streaming import run, spool_state, stateful, stateless


def _events(spark, sf_dir):
    stream = run.stream_table(spark, sf_dir, "events.parquet", f"{sf_dir}/events.parquet")
    return stream.withColumn("at", F.col("ts").cast("timestamp"))


def _arriving(spark, df, label, parts, late_ms):
    """The rows of ``df`` as a stream of ``parts`` micro-batches; each row arrives up to ``late_ms`` after its time."""
    arrival = F.col("ts_ms") + F.pmod(F.xxhash64("event_id"), F.lit(late_ms))
    low, high = df.agg(F.min(arrival), F.max(arrival)).first()
    number = F.floor((arrival - F.lit(low or 0)) * parts / ((high or 0) - (low or 0) + 1))
    folder, files = scratch_dir(spark, label), spark.sparkContext.defaultParallelism
    for part in range(parts):  # files are taken in the order in which they were written
        df.where(number == part).repartition(files).write.parquet(f"{folder}/part={part}")
    return (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true")
            .parquet(folder))


def _finish(df, spark, label):
    folder = scratch_dir(spark, label)
    run.to_parquet(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


_MAIL = "regexp_replace(replace({0}, concat('u', user_id, '@example.com'), '[REDACTED]'), 'from [0-9.]+', 'from [REDACTED]')"
_ERRORS = (f"SELECT event_id, user_id, level, raised, raised_message AS message FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'loud' "
           f"ELSE 'error' END AS level FROM ({t.ACCESS.sql()}) WHERE raised IS NOT NULL)")
_BEATS = f"SELECT run_id, slug, lower(status) AS status, 'kept for 10.0.0.1' AS message FROM ({t.HEARTBEATS.sql()})"
_SOUND = "regexp_matches(slug, '^[a-z0-9-]+$') AND status IN ('success', 'failed')"

INGESTED = f"""
SELECT 'logs' AS kind, event_id, level, {_MAIL.format('message')} AS message FROM ({t.LOGS.sql()}) WHERE level <> 'warning'
UNION ALL SELECT 'rejected_logs', event_id, level, {_MAIL.format('message')} FROM ({t.LOGS.sql()}) WHERE level = 'warning'
UNION ALL SELECT CASE WHEN level = 'loud' OR message = '' THEN 'rejected_errors' ELSE 'errors' END, event_id,
  concat(level, '/', raised, '/', CASE WHEN level = 'loud' THEN 'level' WHEN message = '' THEN 'message' ELSE '' END),
  concat({_MAIL.format('message')}, CASE WHEN event_id % 4 = 2 THEN concat(' {{"pwd":"[REDACTED]","n":', event_id, '}}') ELSE '' END) FROM ({_ERRORS})
UNION ALL SELECT 'http_requests', event_id, upper(method), host FROM ({t.ACCESS.sql()}) WHERE upper(method) IN {sql.in_list(fixed.CAPTURED_METHODS)}
UNION ALL SELECT 'spans', o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'ok' END,
  CASE WHEN o_orderkey % 2 = 0 THEN 'order of [REDACTED] {{"token":"[REDACTED]","n":1}}' ELSE 'order of [REDACTED] {{"n":2}}' END FROM orders
UNION ALL SELECT 'db_queries', statement_id, coalesce(status, 'success'), CASE WHEN status = 'error' THEN 'asked by [REDACTED]' ELSE '' END
  FROM ({t.STATEMENTS.sql()})
UNION ALL SELECT 'heartbeats', run_id, concat(slug, '/', status), 'kept for [REDACTED]' FROM ({_BEATS}) WHERE {_SOUND}
UNION ALL SELECT 'rejected_heartbeats', run_id, concat(slug, '/', status), 'kept for [REDACTED]' FROM ({_BEATS}) WHERE NOT ({_SOUND})
UNION ALL SELECT 'replay_events', event_id, session_id, concat('{{"event":', event_id, ',"cookie":"[REDACTED]"}}') FROM ({t.REPLAY_EVENTS.sql()})
UNION ALL SELECT 'session_starts', event_id, release, session_id FROM ({t.SESSION_MARKS.sql()})
UNION ALL SELECT 'session_ends', event_id, 'ok', session_id FROM ({t.SESSION_MARKS.sql()}) WHERE mark = 'end'
UNION ALL SELECT 'releases', deploy_id, 'main', 'by [REDACTED]' FROM ({t.DEPLOYS.sql()})
UNION ALL SELECT 'rejected_envelopes', event_id, CASE event_id % 3 WHEN 0 THEN 'kind' WHEN 1 THEN 'path' ELSE 'document' END,
  CASE event_id % 3 WHEN 1 THEN concat('{{"path":7,"payload":{{}},"ts":', event_id, '}}') WHEN 2 THEN concat('{{"ts":', event_id, ',') END FROM events"""


def _envelopes_of_all_kinds(spark, sf_dir):
    """Envelopes of the ten kinds: texts with addresses in them, and here and there a nested document with a secret."""
    from beaconry.operators import delivery, instrument as ins
    from beaconry.operators.wire import to_wire, wire_item

    never = F.lit(0).cast("bigint")

    def one(kind, rows, payload=None):
        return env.to_envelopes(rows, kind, to_wire(rows, kind) if payload is None else payload, never)

    def batched(kind, rows, by, order, item=None):
        field = schemas.KINDS[kind][2]
        bodies = delivery.chunk_batches(rows, by, order, wire_item(rows, kind) if item is None else item, field)
        return env.to_envelopes(bodies, kind, F.to_json(F.struct(field)), never)

    logs = t.LOGS.frame(spark, sf_dir).withColumn("error_id", F.col("event_id").cast("string"))
    access = t.ACCESS.frame(spark, sf_dir)
    errors = access.where("raised IS NOT NULL").select(
        F.col("raised").alias("exceptionClass"), F.col("raised_message").alias("message"), F.expr("CASE WHEN event_id % 3 = 0 THEN 'loud' ELSE 'error' END AS level"),
        F.struct(F.expr("CASE WHEN event_id % 4 = 2 THEN struct(CAST(user_id AS string) AS pwd, event_id AS n) END AS note")).alias("metadata"),
        F.col("event_id").cast("string").alias("dist"), "trace_id")
    requests = ins.request_rows(ins.asgi_requests(access)).withColumn("error_fingerprint", F.col("event_id").cast("string"))
    spans = t.read(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS string) AS spanId", "'http.server' AS operation", "concat('order of c', o_custkey, '@example.org') AS description",
        "CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'ok' END AS status", "o_custkey % 10 AS part", "o_orderkey AS id",
        "struct(CASE WHEN o_orderkey % 2 = 0 THEN 'abc' END AS token, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS n) AS data")
    queries = normalize.normalize_db(t.STATEMENTS.frame(spark, sf_dir)).withColumns({
        "service": F.col("statement_id").cast("string"), "part": F.col("statement_id") % 10,
        "error_message": F.when(F.col("status") == "error", F.concat(F.lit("asked by c"), "statement_id", F.lit("@example.net"))).otherwise("")})
    beats = t.HEARTBEATS.frame(spark, sf_dir).withColumns({"message": F.lit("kept for 10.0.0.1"), "duration_ms": F.col("run_id")})
    replay = t.REPLAY_EVENTS.frame(spark, sf_dir).withColumn("fingerprint", F.coalesce("fingerprint", F.lit("")))
    replay_item = F.struct(F.col("event_type").alias("eventType"), F.struct(F.col("event_id").alias("event"), F.lit("c=1").alias("cookie")).alias("eventData"))
    replays = delivery.chunk_batches(replay, ["fingerprint", "session_id"], ["event_id"], replay_item, "events").withColumnRenamed("session_id", "sessionId")
    marks = t.SESSION_MARKS.frame(spark, sf_dir)
    starts = marks.select("session_id", "release", F.col("event_id").cast("string").alias("user_id"))
    ends = marks.where("mark = 'end'").select("session_id", F.col("event_id").alias("duration_ms"), F.lit("ok").alias("status"))
    releases = t.DEPLOYS.frame(spark, sf_dir).select(
        F.col("deploy_id").cast("string").alias("version"), F.lit("main").alias("branch"), F.lit("by dev@example.com").alias("message"))
    found = [
        one("logs", logs), one("errors", errors, F.to_json(F.struct("exceptionClass", "message", "level", "metadata", "dist"))),
        batched("http_requests", requests, ["host"], ["ts_ms", "event_id"]),
        batched("spans", spans, ["part"], ["id"], F.struct("spanId", "operation", "description", "status", "data")),
        batched("db_queries", queries, ["part"], ["statement_id"]), one("heartbeats", beats),
        one("replay_events", replays, F.to_json(F.struct("fingerprint", "sessionId", "events"))),
        one("session_starts", starts), one("session_ends", ends), one("releases", releases)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


@job("stream_ingest", INGESTED)
def stream_ingest(spark, sf_dir):
    """A folder of envelopes of all ten kinds to typed, validated, scrubbed tables; what is no envelope of a known path is rejected."""
    spark = run.tune_streams(spark)
    folder = scratch_dir(spark, "ingest")
    entry = F.concat(F.lit('{"path":'), F.to_json(F.col("path").cast("variant")), F.lit(',"payload":'), "payload", F.lit(',"ts":0}'))
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    _envelopes_of_all_kinds(spark, sf_dir).select(entry.alias("value")).write.options(**packed).text(f"{folder}/spool/known")
    strange = """CASE event_id % 3 WHEN 0 THEN concat('{"path":"/ingest/v1/unheard-of","payload":{"password":"p"},"ts":', event_id, '}')
        WHEN 1 THEN concat('{"path":7,"payload":{},"ts":', event_id, '}') ELSE concat('{"ts":', event_id, ',') END AS value"""
    t.read(spark, sf_dir, "events").selectExpr(strange).write.options(**packed).text(f"{folder}/spool/strange")
    incoming = env.read_envelopes(spark, f"{folder}/spool", stream=True, maxBytesPerTrigger=run.INTAKE_PACKED)
    stateless.stream_ingest(incoming, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()

    def table(kind, *columns):
        return spark.read.parquet(f"{folder}/tables/{kind}").selectExpr(f"'{kind}' AS kind", *columns)

    log = ["CAST(error_id AS bigint) AS event_id", "level", "message"]
    error = ["CAST(dist AS bigint) AS event_id", "concat(level, '/', exception_class, '/', {}) AS level",
             "concat(message, coalesce(concat(' ', metadata['note']), '')) AS message"]
    beat = ["duration_ms AS event_id", "concat(slug, '/', status) AS level", "message"]
    found = [
        table("logs", *log), table("rejected_logs", *log),
        table("errors", *(c.format("''") for c in error)), table("rejected_errors", *(c.format("rejected") for c in error)),
        table("http_requests", "CAST(error_fingerprint AS bigint) AS event_id", "method AS level", "host AS message"),
        table("spans", "CAST(span_id AS bigint) AS event_id", "status AS level", "concat(description, ' ', data) AS message"),
        table("db_queries", "CAST(service AS bigint) AS event_id", "status AS level", "error_message AS message"),
        table("heartbeats", *beat), table("rejected_heartbeats", *beat),
        table("replay_events", "CAST(get_json_object(event_data, '$.event') AS bigint) AS event_id", "session_id AS level", "event_data AS message"),
        table("session_starts", "CAST(user_id AS bigint) AS event_id", "release AS level", "session_id AS message"),
        table("session_ends", "duration_ms AS event_id", "status AS level", "session_id AS message"),
        table("releases", "CAST(version AS bigint) AS event_id", "branch AS level", "message"),
        table("rejected_envelopes", "coalesce(ts, try_cast(regexp_extract(value, '\"ts\":([0-9]+)', 1) AS bigint)) AS event_id",
              "rejected AS level", "value AS message")]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


@job("stream_dedupe", "SELECT event_id, user_id FROM events")
def stream_dedupe(spark, sf_dir):
    """Every event sent twice, kept once."""
    twice = _events(spark, sf_dir).select("event_id", "user_id", "at").withColumn(
        "_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return _finish(stateless.stream_dedupe(twice, "at", ["event_id"], "40 days").drop("at"), spark, "dedupe")


_LATEST_MS = "(SELECT epoch_us(max(ts)) // 1000 FROM events)"
_MINUTE_MS, _DAY_MS = 60_000, 86_400_000


@job("stream_breadcrumbs", f"""
SELECT process_id, error_id, event_id, message FROM {OWNED_CRUMBS.format(limit=3)} WHERE error_id IN (
  SELECT event_id FROM events WHERE (epoch_us(ts) // 1000 // {_MINUTE_MS} + 1) * {_MINUTE_MS} <= {_LATEST_MS} - {2 * _DAY_MS})""")
def stream_breadcrumbs(spark, sf_dir):
    """Marks that arrive up to two days late, in four micro-batches; errors of the last two days still wait."""
    spark = run.tune_streams(spark)
    marks = t.CRUMB_MARKS.frame(spark, sf_dir).select("process_id", "ts_ms", "event_id", "is_error", "message")
    arriving = _arriving(spark, marks, "crumb-marks", 4, 2 * _DAY_MS).withColumn("at", F.timestamp_millis("ts_ms"))
    return _finish(stateful.stream_breadcrumbs(arriving, "2 days", limit=3, ttl_ms=400 * _DAY_MS, bucket_ms=_MINUTE_MS), spark, "crumbs")


@job("stream_sessions", f"""
SELECT session_id, CASE WHEN NOT ended AND status IN ('ok', 'errored') THEN 'abnormal' ELSE status END AS status,
  error_count, started_ms, duration_ms, ended FROM {FOLDED}
WHERE started_ms + duration_ms + CASE WHEN ended THEN 0 ELSE 4 * {_DAY_MS} END <= {_LATEST_MS} - {2 * _DAY_MS}""")
def stream_sessions(spark, sf_dir):
    """Sessions as they end, from marks that arrive up to two days late in four micro-batches; those silent for four days end as abnormal."""
    spark = run.tune_streams(spark)
    marks = t.SESSION_MARKS.frame(spark, sf_dir).select("session_id", "ts_ms", "event_id", "mark", "final_status")
    arriving = _arriving(spark, marks, "session-marks", 4, 2 * _DAY_MS).withColumn("at", F.timestamp_millis("ts_ms"))
    return _finish(stateful.stream_sessions(arriving, "2 days", 4 * _DAY_MS), spark, "sessions")


@job("stream_traces", f"""
WITH s AS (SELECT user_id, epoch_us(ts) AS us, event_type FROM events),
g AS (SELECT *, sum(CASE WHEN us - p <= 1800000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY us) AS grp FROM (
  SELECT *, lag(us) OVER (PARTITION BY user_id ORDER BY us) AS p FROM s))
SELECT concat('t', user_id) AS trace_id, min(us) // 1000 AS from_ms, count(*) AS spans, count(*) FILTER (
  WHERE event_type = 'error') AS error_spans, max(us) // 1000 + 5 - min(us) // 1000 AS wall_ms FROM g GROUP BY user_id, grp
HAVING (max(us) + 1800000000) // 1000 <= {_LATEST_MS} - 60000""")
def stream_traces(spark, sf_dir):
    """Traces that are closed by the end of the input, with a gap of half an hour."""
    spans = _events(spark, sf_dir).select(
        "at", F.concat(F.lit("t"), "user_id").alias("trace_id"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        F.unix_millis("at").alias("start_ms"), (F.unix_millis("at") + 5).alias("end_ms"))
    return _finish(stateless.stream_traces(spans, "1 minute", "30 minutes"), spark, "traces")


_SERVICE = "CASE user_id % 3 WHEN 0 THEN 'shop' WHEN 1 THEN 'search' ELSE 'pay' END"


@job("stream_rates", f"""
SELECT f * 3600000 AS from_ms, {_SERVICE} AS service, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS failed
FROM (SELECT *, epoch_us(ts) // 3600000000 AS f FROM events)
WHERE (f + 1) * 3600000 <= {_LATEST_MS} - 600000 GROUP BY 1, 2""")
def stream_rates(spark, sf_dir):
    """Hourly rates per service."""
    requests = _events(spark, sf_dir).select(
        "at", F.expr(_SERVICE).alias("service"), (F.col("event_type") == "error").alias("failed"))
    return _finish(stateless.stream_rates(requests, "10 minutes", "1 hour"), spark, "rates")


@job("stream_rates_sliding", f"""
SELECT f * 1800000 AS from_ms, {_SERVICE} AS service, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS failed
FROM (SELECT *, unnest([epoch_us(ts) // 1800000000, epoch_us(ts) // 1800000000 - 1]) AS f FROM events)
WHERE (f + 2) * 1800000 <= {_LATEST_MS} - 600000 GROUP BY 1, 2""")
def stream_rates_sliding(spark, sf_dir):
    """Hourly rates per service, every half hour."""
    requests = _events(spark, sf_dir).select(
        "at", F.expr(_SERVICE).alias("service"), (F.col("event_type") == "error").alias("failed"))
    return _finish(stateless.stream_rates(requests, "10 minutes", "1 hour", "30 minutes"), spark, "sliding")


@job("stream_correlate", """
SELECT event_id, md5(concat('q', event_id)) AS request_id, event_id % 6 AS minutes FROM events
WHERE event_type = 'error' AND event_id % 6 <= 3""")
def stream_correlate(spark, sf_dir):
    """Requests and the errors that follow within three minutes."""
    requests = _events(spark, sf_dir).select(
        "event_id", "at", F.md5(F.concat(F.lit("q"), "event_id")).alias("request_id"))
    errors = _events(spark, sf_dir).where("event_type = 'error'").select(
        F.md5(F.concat(F.lit("q"), "event_id")).alias("request_id"), (F.col("event_id") % 6).alias("minutes"),
        F.expr("at + make_interval(0, 0, 0, 0, 0, CAST(event_id % 6 AS INT), 0)").alias("error_at"))
    joined = stateless.stream_correlate(requests, errors, "10 minutes", "3 minutes")
    return _finish(joined.select("event_id", "request_id", "minutes"), spark, "correlate")


@job("stream_retention", f"""
SELECT event_id, spool_id, bytes FROM (
  SELECT *, sum(bytes) OVER (PARTITION BY spool_id ORDER BY ts_ms DESC, seq DESC ROWS UNBOUNDED PRECEDING) AS total FROM (
    SELECT *, row_number() OVER (PARTITION BY spool_id ORDER BY ts_ms DESC, seq DESC) AS age
    FROM ({t.SPOOL_ENTRIES.sql()}) WHERE 1706486400000 - ts_ms <= 864000000) WHERE age <= 100) WHERE total <= 2000000""")
def stream_retention(spark, sf_dir):
    """The spool's bounds kept up batch by batch, from entries that come in any order; each batch writes what it changes."""
    spark = run.tune_streams(spark)
    entries = t.SPOOL_ENTRIES.frame(spark, sf_dir).select("event_id", "spool_id", "ts_ms", "seq", "bytes", F.col("event_id").cast("string").alias("entry"))
    folder = scratch_dir(spark, "retention")
    arriving = _arriving(spark, entries, "spool-entries", 4, 40 * _DAY_MS)
    changes = spool_state.stream_retention(arriving, F.lit(1706486400000), max_bytes=2_000_000, max_age_s=864_000)
    spool_state.run_retention(changes, folder, f"{folder}/checkpoint", compact_every=3).awaitTermination()
    return spool_state.kept_entries(spark, folder).select(F.col("entry").cast("bigint").alias("event_id"), "spool_id", "bytes")


@job("stream_chunks", f"""
SELECT spool_id AS flush_key, item // 100 AS chunk, count(*) AS items, 'full' AS flushed FROM (
  SELECT spool_id, row_number() OVER (PARTITION BY spool_id ORDER BY event_id) - 1 AS item, count(*) OVER (PARTITION BY spool_id) AS n
  FROM ({t.SPOOL_ENTRIES.sql()})) WHERE item // 100 < n // 100 GROUP BY 1, 2""")
def stream_chunks(spark, sf_dir):
    """Bodies that are full by the end of the input; the rest of each key still waits for its time."""
    spark = run.tune_streams(spark)
    entries = t.SPOOL_ENTRIES.frame(spark, sf_dir).select("event_id", "ts_ms", F.col("spool_id").alias("flush_key"), F.col("event_id").cast("string").alias("item"))
    bodies = spool_state.stream_chunks(_arriving(spark, entries, "items", 3, _DAY_MS), flush_ms=_DAY_MS)
    folder = scratch_dir(spark, "bodies")
    run.until_read(run.to_parquet(bodies, f"{folder}/out", f"{folder}/checkpoint", every="0 seconds"), entries.count())
    return spark.read.schema(bodies.schema).parquet(f"{folder}/out").select("flush_key", "chunk", F.size("items").cast("bigint").alias("items"), "flushed")
