"""Validation and normalization jobs, one per record kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.operators import normalize as n
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.sources import tables as t

_ERRORS = ("SELECT event_id, CASE event_type WHEN 'click' THEN 'warning' WHEN 'view' THEN 'critical' "
           "WHEN 'signup' THEN NULL ELSE event_type END AS level, CASE WHEN event_id % 10 = 0 THEN ' ' ELSE 'E' END "
           "AS exception_class, CASE WHEN event_id % 12 = 0 THEN NULL ELSE 'm' END AS message FROM events")


def _errors(spark, sf_dir):
    events = t.read(spark, sf_dir, "events")
    return events.selectExpr(
        "event_id", "CASE event_type WHEN 'click' THEN 'warning' WHEN 'view' THEN 'critical' WHEN 'signup' THEN NULL "
        "ELSE event_type END AS level", "CASE WHEN event_id % 10 = 0 THEN ' ' ELSE 'E' END AS exception_class",
        "CASE WHEN event_id % 12 = 0 THEN NULL ELSE 'm' END AS message")


@job("validate_errors", f"""
SELECT event_id, CASE WHEN level IS NULL OR level NOT IN {sql.in_list(fixed.ERROR_LEVELS)} THEN 'level'
  WHEN trim(exception_class) = '' THEN 'exception_class' WHEN message IS NULL THEN 'message' END AS rejected
FROM ({_ERRORS})""")
def validate_errors(spark, sf_dir):
    return n.validate_errors(_errors(spark, sf_dir)).select("event_id", "rejected")


@job("validate_logs", f"""
SELECT level, count(*) AS logs, CASE WHEN level NOT IN {sql.in_list(fixed.LOG_LEVELS)} THEN 'level' END AS rejected
FROM ({t.LOGS.sql()}) GROUP BY level""")
def validate_logs(spark, sf_dir):
    return n.validate_logs(t.LOGS.frame(spark, sf_dir)).groupBy("level", "rejected").agg(
        F.count(F.lit(1)).alias("logs"))


@job("normalize_http", f"""
SELECT event_id, upper(method) AS method, {sql.stripped_path('path')} AS path, greatest(duration_ms, 0) AS duration_ms,
  CASE WHEN event_id % 6 = 0 THEN md5(CAST(event_id AS VARCHAR)) ELSE trace_id END AS trace_id, '1.0' AS release
FROM ({t.ACCESS.sql()}) WHERE event_id % 15 <> 0""")
def normalize_http(spark, sf_dir):
    rows = t.ACCESS.frame(spark, sf_dir).selectExpr(
        "event_id", "event_id AS event_key", "method", "host", "path", "status AS status_code", "duration_ms",
        "CASE WHEN event_id % 6 = 0 THEN '' ELSE trace_id END AS trace_id",
        "CASE WHEN event_id % 15 = 0 THEN 'sideways' ELSE 'inbound' END AS direction")
    return n.valid(n.normalize_http(rows, release="1.0")).select(
        "event_id", "method", "path", "duration_ms", "trace_id", "release")


_TAGGED = "CASE WHEN event_id % 4 = 0 THEN 'own' WHEN event_id % 4 < 3 THEN '0.9' END"


@job("http_items", f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '2020-01-01T00:00:00Z' WHEN event_id % 3 = 1 THEN strftime(epoch_ms(ts_ms), '%Y-%m-%dT%H:%M:%S.%fZ')
    ELSE '2024-06-01T00:00:00.000000Z' END AS timestamp, {_TAGGED} AS sdk_version, CASE WHEN event_id % 4 = 0 THEN 'y' END AS own_tag,
  CASE WHEN event_id % 4 = 3 THEN 0 ELSE 1 + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END END AS tags FROM ({t.ACCESS.sql()})""")
def http_items(spark, sf_dir):
    """Times and release tags of http rows: given ones stay, missing ones are filled in."""
    rows = t.ACCESS.frame(spark, sf_dir).selectExpr(
        "event_id", "event_id AS event_key", "method", "host", "path", "status AS status_code", "duration_ms", "trace_id", "'inbound' AS direction",
        "CASE WHEN event_id % 3 = 0 THEN '2020-01-01T00:00:00Z' WHEN event_id % 3 = 1 THEN '' END AS timestamp",
        "CASE WHEN event_id % 3 <> 2 THEN ts_ms END AS ts_ms",
        "CASE WHEN event_id % 4 = 0 THEN map('sdk.version', 'own', 'x', 'y') WHEN event_id % 4 = 1 THEN map() END AS metadata")
    tags = {"sdk.version": F.when(F.col("event_id") % 4 < 3, "0.9"), "dist": F.lit("")}
    out = n.normalize_http(rows, release="1.0", tags=tags, now_ms=F.lit(1717200000000))
    return out.select("event_id", "timestamp", F.col("metadata")["sdk.version"].alias("sdk_version"), F.col("metadata")["x"].alias("own_tag"),
                      F.coalesce(F.size("metadata"), F.lit(0)).alias("tags"))


@job("validate_http_items", f"""
SELECT event_id, 'duration_ms' AS rejected FROM ({t.ACCESS.sql()}) WHERE duration_ms < 0""")
def validate_http_items(spark, sf_dir):
    rows = t.ACCESS.frame(spark, sf_dir).select("event_id", "duration_ms", F.lit("inbound").alias("direction"))
    return n.rejected(n.validate_http_items(rows)).select("event_id", "rejected")


@job("outbound_from_url", f"""
SELECT call_id, coalesce(nullif({sql.url_netloc('url')}, ''), {sql.url_path('url')}) AS host,
  {sql.url_path('url')} AS path, coalesce(status, 0) AS status_code,
  raised AS error_fingerprint, greatest(duration_ms, 0) AS duration_ms, upper(method) AS method
FROM ({t.OUTBOUND_CALLS.sql()})""")
def outbound_from_url(spark, sf_dir):
    calls = t.OUTBOUND_CALLS.frame(spark, sf_dir).withColumnRenamed("status", "status_code")
    return n.outbound_from_url(calls).select(
        "call_id", "host", "path", "status_code", "error_fingerprint", "duration_ms", "method")


@job("validate_heartbeats", f"""
SELECT run_id, lower(status) AS status, message, CASE WHEN NOT regexp_matches(slug, '^[a-z0-9-]+$') THEN 'slug'
  WHEN lower(status) NOT IN ('success', 'failed') THEN 'status' END AS rejected FROM ({t.HEARTBEATS.sql()})""")
def validate_heartbeats(spark, sf_dir):
    return n.validate_heartbeats(t.HEARTBEATS.frame(spark, sf_dir)).select("run_id", "status", "message", "rejected")


@job("normalize_breadcrumbs", f"""
SELECT event_id, 'default' AS type, CASE WHEN level = 'warn' THEN 'warn' ELSE 'info' END AS level,
  CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS data_user FROM ({t.CRUMB_MARKS.sql()})""")
def normalize_breadcrumbs(spark, sf_dir):
    data = F.map_filter(F.create_map(F.lit("user"), F.col("user_id").cast("string")),
                        lambda k, v: F.col("event_id") % 3 != 0)
    return n.normalize_breadcrumbs(t.CRUMB_MARKS.frame(spark, sf_dir).withColumn("data", data)).select(
        "event_id", "type", "level", F.col("data")["user"].alias("data_user"))


_AS_OF = 1893456000000


@job("normalize_spans", f"""
SELECT span_id, coalesce(inbound_parent, '') AS parent_span_id, start_ms, coalesce(finish_ms, {_AS_OF}) AS end_ms,
  coalesce(finish_ms, {_AS_OF}) - start_ms AS duration_ms,
  CASE WHEN finish_ms IS NOT NULL AND status IN ('ok', 'error', 'timeout') THEN status ELSE 'ok' END AS status
FROM ({t.SPAN_MARKS.sql()})""")
def normalize_spans(spark, sf_dir):
    """Every span with a second, later finish call that must not count."""
    once = t.SPAN_MARKS.frame(spark, sf_dir).withColumnRenamed("inbound_parent", "parent_span_id")
    late = once.where("finish_ms IS NOT NULL").withColumn("finish_ms", F.col("finish_ms") + 1000).withColumn(
        "status", F.lit("timeout"))
    return n.normalize_spans(once.unionByName(late), F.lit(_AS_OF)).drop("trace_id")


@job("span_exit_status", f"""
SELECT event_id, coalesce(CASE WHEN event_id % 4 = 0 THEN 'timeout' END, CASE WHEN raised IS NOT NULL THEN 'error' ELSE
  'ok' END) AS status FROM ({t.ACCESS.sql()})""")
def span_exit_status(spark, sf_dir):
    finished = F.when(F.col("event_id") % 4 == 0, "timeout")
    return t.ACCESS.frame(spark, sf_dir).select(
        "event_id", n.span_exit_status(finished, F.col("raised")).alias("status"))


@job("normalize_db", f"""
SELECT statement_id, n AS normalized_query, substring(md5(n), 1, 16) AS query_hash,
  coalesce(query_type, {sql.query_type('n')}) AS query_type, greatest(0, CAST(trunc(duration_ms) AS BIGINT)) AS duration_ms,
  coalesce(error_message, '') AS error_message, coalesce(rows_affected, -1) AS rows_affected,
  coalesce(status, 'success') AS status, coalesce(nullif(trace_id, ''), active_trace_id, '') AS trace_id,
  coalesce(nullif(span_id, ''), active_span_id, '') AS span_id, nullif(parent_span_id, '') AS parent_span_id
FROM (SELECT *, {sql.normalized_query('statement')} AS n FROM ({t.STATEMENTS.sql()}))""")
def normalize_db(spark, sf_dir):
    return n.normalize_db(t.STATEMENTS.frame(spark, sf_dir)).select(
        "statement_id", "normalized_query", "query_hash", "query_type", "duration_ms", "error_message",
        "rows_affected", "status", "trace_id", "span_id", "parent_span_id")


@job("flatten_mechanism", """
SELECT event_id, CASE WHEN event_id % 4 = 1 THEN 'hook' WHEN event_id % 4 = 2 THEN 'named' END AS mechanism,
  CASE WHEN event_id % 5 = 0 THEN true WHEN event_id % 4 IN (1, 3) THEN event_id % 2 = 0 END AS handled FROM events""")
def flatten_mechanism(spark, sf_dir):
    e = F.col("event_id")
    mechanism = F.when(e % 4 != 0, F.struct(
        F.when(e % 4 == 1, "hook").when(e % 4 == 2, "").alias("type"), F.when(e % 4 == 2, "named").alias("name"),
        F.when(e % 4 != 2, e % 2 == 0).alias("handled")))
    events = t.read(spark, sf_dir, "events").select(
        "event_id", mechanism.alias("mechanism"), F.when(e % 5 == 0, F.lit(True)).alias("handled"))
    return n.flatten_mechanism(events)


@job("error_defaults", f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'dev' ELSE 'production' END AS environment, '1.0' AS release,
  CASE WHEN raised IS NOT NULL THEN coalesce(nullif(raised_message, ''), concat(raised, '()')) ELSE raised_message
  END AS message, CASE WHEN raised IS NOT NULL THEN 'acme-python' END AS sdk_name FROM ({t.ACCESS.sql()})""")
def error_defaults(spark, sf_dir):
    raised = F.col("raised").isNotNull()
    rows = t.ACCESS.frame(spark, sf_dir).select(
        "event_id", raised.alias("from_exception"), F.col("raised_message").alias("message"),
        F.concat("raised", F.lit("()")).alias("exception_repr"),
        F.when(F.col("event_id") % 3 == 0, "dev").otherwise("").alias("environment"),
        F.lit(None).cast("string").alias("release"))
    return n.error_defaults(rows, "production", "1.0", "acme-python", "0.9").select(
        "event_id", "environment", "release", "message", "sdk_name")


@job("validate_session_states", f"""
SELECT event_id, CASE WHEN version <> 1 THEN 'version' WHEN session_id = '' THEN 'session_id'
  WHEN started_at IS NULL THEN 'started_at' WHEN status NOT IN {sql.in_list(fixed.SESSION_STATUSES)} THEN 'status'
  END AS rejected FROM ({t.SESSION_STATES.sql()})""")
def validate_session_states(spark, sf_dir):
    return n.validate_session_states(t.SESSION_STATES.frame(spark, sf_dir)).select("event_id", "rejected")


@job("enrich_release_tags", """
SELECT event_id, 'acme' AS sdk_name, CASE WHEN event_id % 2 = 0 THEN 'mine' ELSE '0.9' END AS sdk_version,
  CASE WHEN event_id % 3 = 0 THEN 'abc' END AS commit_sha, CAST(CASE WHEN event_id % 2 = 0 THEN 4 ELSE 3 END
  + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END - CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS INT) AS tags
FROM events""")
def enrich_release_tags(spark, sf_dir):
    e = F.col("event_id")
    own = F.when(e % 2 == 0, F.create_map(F.lit("sdk.version"), F.lit("mine")))
    rows = n.enrich_release_tags(
        t.read(spark, sf_dir, "events").select("event_id", own.alias("metadata")),
        {"sdk.name": F.lit("acme"), "sdk.version": F.lit("0.9"), "platform": F.lit("python"), "dist": F.lit(""),
         "commit.sha": F.when(e % 3 == 0, "abc")})
    m = F.col("metadata")
    return rows.select("event_id", m["sdk.name"].alias("sdk_name"), m["sdk.version"].alias("sdk_version"),
                       m["commit.sha"].alias("commit_sha"), F.size(m).alias("tags"))


@job("resolve_release", f"""
SELECT deploy_id, coalesce(nullif(release, ''), nullif(own_release, ''), nullif(substring(ci_sha_1, 1, 12), ''),
    substring(ci_sha_2, 1, 12), substring(ci_sha_3, 1, 12), git_release, '0.9') AS release,
  coalesce(commit_sha, own_commit_sha, nullif(git_commit, ''), nullif(ci_sha_1, ''), ci_sha_2, ci_sha_3) AS commit_sha,
  coalesce(branch, own_branch, git_branch, ci_ref_1, ci_ref_2) AS branch,
  coalesce(nullif(environment, ''), own_environment, app_env, 'production') AS environment
FROM ({t.DEPLOYS.sql()})""")
def resolve_release(spark, sf_dir):
    return n.resolve_release(t.DEPLOYS.frame(spark, sf_dir), sdk_version="0.9")
