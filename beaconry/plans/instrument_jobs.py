"""Raw operational logs to telemetry tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.operators import context, instrument as ins
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.sources import tables as t

_CAPTURED = f"upper(method) IN {sql.in_list(fixed.CAPTURED_METHODS)}"
_ASGI = f"""(SELECT *, coalesce(status, CASE WHEN raised IS NOT NULL THEN 500 ELSE 0 END) AS code,
  coalesce(route, '{fixed.UNMATCHED_ROUTE}') AS name FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED})"""
_DJANGO_NAME = "coalesce('/' || ltrim(route, '/'), path)"


@job("asgi_requests", f"""
SELECT event_id, upper(method) AS method, {sql.stripped_path('path')} AS path, code AS status_code,
  greatest(duration_ms, 0) AS duration_ms, request_size, response_size,
  substring(md5(concat('asgi-', event_id)), 1, 16) AS span_id, trace_id, request_id FROM {_ASGI}""")
def asgi_requests(spark, sf_dir):
    rows = ins.request_rows(ins.asgi_requests(t.ACCESS.frame(spark, sf_dir)))
    return rows.select("event_id", "method", "path", "status_code", "duration_ms", "request_size", "response_size",
                       "span_id", "trace_id", "request_id")


@job("asgi_spans", f"""
SELECT event_id, 'http.server' AS operation, concat(upper(method), ' ', {sql.stripped_path('path')}) AS description,
  CASE WHEN code BETWEEN 500 AND 599 THEN 'error' ELSE 'ok' END AS status, coalesce(parent_span_id, '') AS parent_span_id,
  ts_ms + duration_ms AS end_ms, name AS route, CAST(code AS VARCHAR) AS status_tag, name AS transaction FROM {_ASGI}""")
def asgi_spans(spark, sf_dir):
    spans = ins.request_spans(ins.asgi_requests(t.ACCESS.frame(spark, sf_dir)))
    tags = F.col("tags")
    return spans.select("event_id", "operation", "description", "status", "parent_span_id", "end_ms",
                        tags["http.route"].alias("route"), tags["http.status_code"].alias("status_tag"),
                        tags["transaction"].alias("transaction"))


@job("asgi_errors", f"""
SELECT event_id, coalesce(raised, 'HTTPServerError') AS exception_class, CASE WHEN raised IS NOT NULL THEN
  coalesce(nullif(raised_message, ''), raised) ELSE concat(upper(method), ' ', name, ' responded with ', code) END AS message,
  CASE WHEN raised IS NOT NULL THEN name END AS context_path, CASE WHEN raised IS NOT NULL THEN 'fastapi' END AS mechanism,
  CASE WHEN raised IS NOT NULL THEN true END AS handled, CAST(code AS VARCHAR) AS http_status
FROM {_ASGI} WHERE code BETWEEN 500 AND 599""")
def asgi_errors(spark, sf_dir):
    errors = ins.asgi_errors(ins.asgi_requests(t.ACCESS.frame(spark, sf_dir)))
    return errors.select(
        "event_id", "exception_class", "message", F.col("request_context.path").alias("context_path"),
        F.col("mechanism.type").alias("mechanism"), F.col("mechanism.handled").alias("handled"),
        F.col("metadata")["http.status"].alias("http_status"))


@job("django_requests", f"""
SELECT event_id, upper(method) AS method, coalesce(status, 500) AS status_code, raised AS error_fingerprint,
  {_DJANGO_NAME} AS route, CASE WHEN coalesce(status, 500) >= 500 OR raised IS NOT NULL THEN 'error' ELSE 'ok' END
  AS status FROM ({t.ACCESS.sql()})""")
def django_requests(spark, sf_dir):
    records = ins.request_telemetry(ins.django_requests(t.ACCESS.frame(spark, sf_dir)))
    return records.select("event_id", "request.method", "request.status_code", "request.error_fingerprint",
                          F.col("span.tags")["http.route"].alias("route"), "span.status")


@job("django_errors", f"""
SELECT event_id, raised AS exception_class, coalesce(nullif(raised_message, ''), raised) AS message,
  'django' AS mechanism, false AS handled, 500 AS status_code FROM ({t.ACCESS.sql()})
WHERE raised IS NOT NULL AND raised NOT IN {sql.in_list(fixed.FRAMEWORK_4XX)}""")
def django_errors(spark, sf_dir):
    errors = ins.framework_errors(ins.django_requests(t.ACCESS.frame(spark, sf_dir)))
    return errors.select("event_id", "exception_class", "message", F.col("mechanism.type").alias("mechanism"),
                         F.col("mechanism.handled").alias("handled"),
                         F.col("request_context.status_code").alias("status_code"))


@job("flask_requests", f"""
SELECT event_id, upper(method) AS method, coalesce(status, 0) AS status_code, path AS route,
  CASE WHEN status >= 500 THEN 'error' ELSE 'ok' END AS status, raised AS exception_class FROM ({t.ACCESS.sql()})""")
def flask_requests(spark, sf_dir):
    records = ins.request_telemetry(ins.flask_requests(t.ACCESS.frame(spark, sf_dir)))
    return records.select("event_id", "request.method", "request.status_code", F.col("span.tags")["http.route"].alias("route"),
                          "span.status", "error.exception_class")


_CALLS = (f"(SELECT *, upper(coalesce(method, 'GET')) AS m, {sql.url_path('url')} AS p FROM ({t.OUTBOUND_CALLS.sql()}) "
          "WHERE NOT starts_with(url, 'https://ingest.example.net'))")
_INGEST = "https://ingest.example.net"


@job("outbound_requests", f"""
SELECT call_id, m AS method, {sql.url_netloc('url')} AS host, p AS path, coalesce(status, 0) AS status_code, greatest(0, duration_ms) AS duration_ms
FROM {_CALLS} WHERE raised IS NULL""")
def outbound_requests(spark, sf_dir):
    rows = ins.outbound_rows(ins.outbound_requests(t.OUTBOUND_CALLS.frame(spark, sf_dir), _INGEST))
    return rows.select("call_id", "method", "host", "path", "status_code", "duration_ms")


@job("outbound_spans", f"""
SELECT call_id, concat(m, ' ', p) AS description, CASE WHEN raised IS NOT NULL OR status >= 500 THEN 'error' ELSE 'ok'
  END AS status, CASE WHEN raised IS NULL THEN CAST(coalesce(status, 0) AS VARCHAR) END AS status_tag FROM {_CALLS}""")
def outbound_spans(spark, sf_dir):
    spans = ins.outbound_spans(ins.outbound_requests(t.OUTBOUND_CALLS.frame(spark, sf_dir), _INGEST))
    return spans.select("call_id", "description", "status", F.col("tags")["http.status_code"].alias("status_tag"))


@job("http_crumbs", f"""
SELECT call_id, concat(m, ' ', string_split(url, '?')[1], ' -> ', CASE WHEN raised IS NOT NULL THEN
  concat('failed: ', raised) ELSE CAST(status AS VARCHAR) END) AS message,
  CASE WHEN raised IS NOT NULL OR status >= 400 THEN 'error' ELSE 'info' END AS level,
  CASE WHEN raised IS NOT NULL THEN raised_message END AS error FROM {_CALLS}""")
def http_crumbs(spark, sf_dir):
    crumbs = ins.outbound_crumbs(ins.outbound_requests(t.OUTBOUND_CALLS.frame(spark, sf_dir), _INGEST))
    return crumbs.select("call_id", "message", "level", F.col("data")["error"].alias("error"))


@job("db_statements", f"""
SELECT statement_id, n AS description, CASE WHEN status = 'error' THEN 'error' ELSE 'ok' END AS status,
  coalesce(query_type, {sql.query_type('n')}) AS operation_tag, 'postgresql' AS system_tag
FROM (SELECT *, {sql.normalized_query('statement')} AS n FROM ({t.STATEMENTS.sql()}))""")
def db_statements(spark, sf_dir):
    spans = ins.statement_spans(ins.db_statements(t.STATEMENTS.frame(spark, sf_dir)))
    tags = F.col("tags")
    return spans.select("statement_id", "description", "status", tags["db.operation"].alias("operation_tag"),
                        tags["db.system"].alias("system_tag"))


_CONTROL = f"coalesce(exception_class IN {sql.in_list(fixed.FRAMEWORK_4XX)}, false)"
_RECORDS = f"(SELECT * FROM ({t.LOG_RECORDS.sql()}) WHERE NOT starts_with(logger, 'ownsdk') AND NOT captured)"
_REQUEST_ID = "coalesce(nullif(request_id_1, ''), nullif(request_id_2, ''), nullif(request_id_3, ''))"


@job("log_errors", f"""
SELECT record_id, coalesce(exception_class, logger) AS exception_class, message,
  CASE WHEN levelno >= 50 THEN 'fatal' ELSE 'error' END AS level, {_REQUEST_ID} AS request_id, span_id,
  CASE WHEN exception_class IS NOT NULL THEN 'logging' END AS mechanism FROM {_RECORDS}
WHERE levelno >= 40 AND NOT {_CONTROL}""")
def log_errors(spark, sf_dir):
    errors = ins.log_errors(ins.log_records(t.LOG_RECORDS.frame(spark, sf_dir), "ownsdk"))
    m = F.col("metadata")
    return errors.select("record_id", "exception_class", "message", "level", m["requestId"].alias("request_id"),
                         m["spanId"].alias("span_id"), "mechanism")


@job("log_crumbs", f"""
SELECT record_id, message, CASE WHEN levelno >= 40 THEN 'error' WHEN levelno >= 30 THEN 'warn' ELSE 'info' END AS level,
  {_REQUEST_ID} AS request_id FROM {_RECORDS} WHERE levelno >= 20 AND (levelno < 40 OR {_CONTROL})""")
def log_crumbs(spark, sf_dir):
    crumbs = ins.log_crumbs(ins.log_records(t.LOG_RECORDS.frame(spark, sf_dir), "ownsdk"))
    return crumbs.select("record_id", "message", "level", F.col("data")["requestId"].alias("request_id"))


@job("warn_log_crumbs", f"""
SELECT log_id, message, CASE WHEN level = 'warn' THEN 'warn' ELSE 'error' END AS level, level AS log_level,
  nullif(service, '') AS service FROM ({t.LOGS.sql()}) WHERE level IN ('warn', 'error', 'fatal')""")
def warn_log_crumbs(spark, sf_dir):
    crumbs = ins.warn_log_crumbs(t.LOGS.frame(spark, sf_dir))
    return crumbs.select("log_id", "message", "level", F.col("data")["logLevel"].alias("log_level"),
                         F.col("data")["service"].alias("service"))


@job("task_runs", f"""
SELECT task_id, coalesce(task, 'celery.task') AS description, CASE WHEN state = 'FAILURE' THEN 'error' ELSE 'ok' END AS status,
  concat('celery task started: ', coalesce(task, 'celery.task')) AS crumb FROM ({t.TASK_RUNS.sql()})""")
def task_runs(spark, sf_dir):
    records = ins.task_telemetry(t.TASK_RUNS.frame(spark, sf_dir))
    return records.select("task_id", "span.description", "span.status", F.col("crumb.message").alias("crumb"))


@job("task_errors", f"""
SELECT task_id, exception_class, coalesce(nullif(raised_message, ''), exception_class) AS message,
  CASE WHEN args IS NOT NULL THEN concat('[', run_id, ',{{"password":"[REDACTED]","n":1}}]') END AS args, false AS handled
FROM ({t.TASK_RUNS.sql()}) WHERE exception_class IS NOT NULL""")
def task_errors(spark, sf_dir):
    from beaconry.operators.scrubbing import scrub_task_args

    failed = t.TASK_RUNS.frame(spark, sf_dir).where("exception_class IS NOT NULL")
    errors = ins.task_errors(scrub_task_args(failed))
    return errors.select("task_id", "exception_class", "message", F.col("metadata")["celery.args"].alias("args"),
                         "handled")


@job("uncaught_exceptions", f"""
SELECT task_id AS crash_id, exception_class, CASE WHEN in_thread THEN 'threading_excepthook' ELSE 'excepthook' END AS
  mechanism, false AS handled FROM ({t.TASK_RUNS.sql()}) WHERE exception_class NOT IN ('KeyboardInterrupt', 'SystemExit')""")
def uncaught_exceptions(spark, sf_dir):
    crashes = t.TASK_RUNS.frame(spark, sf_dir).withColumnRenamed("task_id", "crash_id").withColumn(
        "message", F.col("raised_message"))
    return ins.uncaught_exceptions(crashes).select("crash_id", "exception_class", "mechanism", "handled")


@job("cron_runs", f"""
SELECT run_id, 'daily' AS slug, CASE WHEN exception_class IS NOT NULL THEN 'failed' ELSE 'success' END AS status,
  duration_ms, CASE WHEN exception_class IS NOT NULL THEN raised_message END AS message FROM ({t.TASK_RUNS.sql()})""")
def cron_runs(spark, sf_dir):
    runs = t.TASK_RUNS.frame(spark, sf_dir).select(
        "run_id", F.lit("daily").alias("slug"), F.col("ts_ms").alias("start_ms"),
        (F.col("ts_ms") + F.col("duration_ms")).alias("end_ms"),
        F.when(F.col("exception_class").isNotNull(), F.col("raised_message")).alias("exception_message"),
        F.lit(None).cast("string").alias("success_message"))
    return ins.cron_runs(runs)


@job("framework_4xx_filter", f"""
SELECT event_id, 'request' AS origin, CASE WHEN raised NOT IN {sql.in_list(fixed.FRAMEWORK_4XX)} AND
  coalesce(status, 500) NOT BETWEEN 400 AND 499 THEN 'error' END AS becomes FROM ({t.ACCESS.sql()})
UNION ALL SELECT record_id, 'log', CASE WHEN levelno >= 40 AND NOT {_CONTROL} THEN 'error' WHEN levelno >= 20 THEN 'crumb'
  END FROM ({t.LOG_RECORDS.sql()})""")
def framework_4xx_filter(spark, sf_dir):
    requests = t.ACCESS.frame(spark, sf_dir).select(
        "event_id", F.lit("request").alias("origin"), F.col("raised").alias("exception_class"),
        F.col("status").alias("status_code"), F.lit(None).cast("int").alias("levelno"))
    logs = t.LOG_RECORDS.frame(spark, sf_dir).select(
        F.col("record_id").alias("event_id"), F.lit("log").alias("origin"), "exception_class",
        F.lit(None).cast("bigint").alias("status_code"), "levelno")
    return context.route_errors(requests.unionByName(logs)).select("event_id", "origin", "becomes")
