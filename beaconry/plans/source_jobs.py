"""Wire form, envelopes, spools and registrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.operators import delivery, instrument as ins, normalize, wire
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.session import scratch_dir
from beaconry.sources import envelopes as env, tables as t


def _log_rows(spark, sf_dir, heavy=False):
    return t.LOGS.frame(spark, sf_dir, heavy).withColumn(
        "metadata", F.map_filter(F.create_map(F.lit("password"), F.concat(F.lit("p"), "event_id")),
                                 lambda k, v: F.col("event_id") % 2 == 0))


_LOG_JSON = ("concat('{\"level\":\"', level, '\",\"message\":\"', message, '\"', CASE WHEN service <> '' THEN "
             "concat(',\"service\":\"', service, '\"') ELSE '' END, ',\"traceId\":\"', trace_id, '\",\"userId\":\"', "
             "user_id, '\"', CASE WHEN event_id % 2 = 0 THEN concat(',\"metadata\":{\"password\":\"', {password}, '\"}') "
             "ELSE '' END, '}')")


@job("to_wire", f"""
SELECT event_id, {_LOG_JSON.replace('{password}', "'p', event_id")} AS body FROM ({t.LOGS.sql()})""")
def to_wire(spark, sf_dir):
    """Log rows as wire JSON; empty service and metadata are left out."""
    rows = _log_rows(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("string"))
    return rows.select("event_id", wire.to_wire(rows, "logs").alias("body"))


def _single_envelopes(spark, sf_dir, heavy=False):
    """Logs and heartbeats, one a body, as envelopes."""
    logs = _log_rows(spark, sf_dir, heavy).withColumn("user_id", F.col("user_id").cast("string"))
    beats = t.HEARTBEATS.frame(spark, sf_dir)
    return env.to_envelopes(logs, "logs", wire.to_wire(logs, "logs"), F.col("ts_ms")).unionByName(
        env.to_envelopes(beats, "heartbeats", wire.to_wire(beats, "heartbeats"), F.col("ts_ms")))


def _envelopes(spark, sf_dir):
    """Logs and heartbeats one a body, and request batches of 100, as envelopes."""
    requests = ins.request_rows(ins.asgi_requests(t.ACCESS.frame(spark, sf_dir))).withColumn(
        "host_key", F.col("host"))
    batches = delivery.chunk_batches(requests, ["host_key"], ["ts_ms", "event_id"],
                                     wire.wire_item(requests, "http_requests"), "requests")
    return _single_envelopes(spark, sf_dir).unionByName(
        env.to_envelopes(batches, "http_requests", F.to_json(F.struct("requests")), F.lit(0).cast("bigint")))


@job("route", f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, level, ts_ms AS ts, trace_id FROM ({t.LOGS.sql()})""")
def route(spark, sf_dir):
    """Envelopes back to typed logs."""
    return env.route(_envelopes(spark, sf_dir), "logs").select(
        F.col("userId").alias("user_id"), "level", "ts", F.col("traceId").alias("trace_id"))


@job("explode_batch", f"""
SELECT substring(md5(concat('asgi-', event_id)), 1, 16) AS span_id, upper(method) AS method, host,
  coalesce(status, 500) AS status_code, greatest(duration_ms, 0) AS duration_ms FROM ({t.ACCESS.sql()})
WHERE upper(method) IN {sql.in_list(fixed.CAPTURED_METHODS)}""")
def explode_batch(spark, sf_dir):
    """Batches of requests to one row per request."""
    items = env.explode_batch(env.route(_envelopes(spark, sf_dir), "http_requests"), "http_requests")
    return items.select(F.col("spanId").alias("span_id"), "method", "host", F.col("statusCode").alias("status_code"),
                        F.col("durationMs").alias("duration_ms"))


@job("write_spool", f"""
SELECT ts_ms AS ts, {_LOG_JSON.replace('{password}', "'[REDACTED]'")} AS payload FROM ({t.LOGS.sql()})""")
def write_spool(spark, sf_dir):
    """Envelopes to spool files and back: keys are redacted on the way, heartbeats stay out."""
    folder = scratch_dir(spark, "spool")
    env.write_spool(_single_envelopes(spark, sf_dir, heavy=True), folder)
    return normalize.valid(env.read_envelopes(spark, folder)).select("ts", "payload")


@job("read_envelopes", """
SELECT CASE WHEN event_id % 7 NOT IN (1, 2, 3, 4) THEN '/ingest/v1/logs' END AS path,
  CASE event_id % 7 WHEN 1 THEN 'document' WHEN 2 THEN 'path' WHEN 3 THEN 'payload' WHEN 4 THEN 'document' END AS rejected,
  CASE WHEN event_id % 7 NOT IN (1, 2, 3, 4) THEN concat('{"n":', event_id, '}') END AS payload,
  CASE WHEN event_id % 7 NOT IN (1, 2, 3, 4) THEN event_id END AS ts, 1 AS seq FROM events""")
def read_envelopes(spark, sf_dir):
    """Envelope text of which some is cut off, some has a path that is no string and some a payload that is no object."""
    text = ("CASE event_id % 7 WHEN 1 THEN '{\"path\":\"/ingest/v1/logs\",\"payl' "
            "WHEN 2 THEN '{\"path\":7,\"payload\":{},\"ts\":1}' "
            "WHEN 3 THEN '{\"path\":\"/ingest/v1/logs\",\"payload\":[1],\"ts\":1}' WHEN 4 THEN '[1]' "
            "ELSE concat('{\"path\":\"/ingest/v1/logs\",\"payload\":{\"n\":', event_id, '},\"ts\":', event_id, '}') END AS value")
    lines = t.read(spark, sf_dir, "events").selectExpr(text, "'0000000000001-00000001-aa.json' AS file")
    return env.parse_envelopes(lines).select("path", "rejected", "payload", "ts", "seq")


@job("payload_sizes", f"""
SELECT kind, count(*) AS payloads, CAST(sum(size) AS BIGINT) AS bytes, count(*) FILTER (WHERE size >= 1024) AS compressible,
  round(avg(CASE WHEN size >= 1024 THEN 1.0 ELSE 0.0 END), 6) AS compressible_share FROM (
  SELECT 'logs' AS kind, strlen({_LOG_JSON.replace('{password}', "'p', event_id")}) AS size FROM ({t.LOGS.sql()})
  UNION ALL SELECT 'documents', strlen(text) FROM documents) GROUP BY kind""")
def payload_sizes(spark, sf_dir):
    logs = to_wire(spark, sf_dir).select(F.lit("logs").alias("kind"), "body")
    docs = t.read(spark, sf_dir, "documents").select(F.lit("documents").alias("kind"), F.col("text").alias("body"))
    return delivery.payload_sizes(logs.unionByName(docs)).withColumn(
        "compressible_share", F.round("compressible_share", 6))


@job("register_releases", f"""
SELECT version, environment, commit_sha, branch, 'acme/0.9' AS author FROM (
  SELECT *, row_number() OVER (PARTITION BY version, environment ORDER BY ts_ms, event_id) AS k FROM (
    SELECT event_id, ts_ms, release AS version, CASE WHEN event_id % 3 = 0 THEN 'production' ELSE 'staging' END AS environment,
      md5(CAST(event_id AS VARCHAR)) AS commit_sha, CASE WHEN event_id % 2 = 0 THEN 'main' END AS branch
    FROM ({t.SESSION_MARKS.sql()}))) WHERE k = 1""")
def register_releases(spark, sf_dir):
    seen = t.SESSION_MARKS.frame(spark, sf_dir).selectExpr(
        "event_id", "ts_ms", "release", "CASE WHEN event_id % 3 = 0 THEN '' ELSE 'staging' END AS environment",
        "md5(CAST(event_id AS STRING)) AS commit_sha", "CASE WHEN event_id % 2 = 0 THEN 'main' END AS branch",
        "'acme' AS sdk_name", "'0.9' AS sdk_version")
    return env.register_releases(seen)
