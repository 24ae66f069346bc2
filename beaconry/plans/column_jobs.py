"""Jobs over the scalar rules: statements, headers, routes, tracebacks, URLs, levels, flags, users."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import records as rec, trace_context as tc
from beaconry.operators import reports
from beaconry.operators.spans import request_ids
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.sources import tables as t

VENDOR = "acme"


@job("statement_catalog", f"""
SELECT substring(md5(n), 1, 16) AS query_hash, {sql.query_type('n')} AS query_type, n AS normalized_query,
  count(*) AS statements
FROM (SELECT {sql.normalized_query('statement')} AS n FROM ({t.STATEMENTS.sql()})) GROUP BY n""")
def statement_catalog(spark, sf_dir):
    return reports.statement_catalog(t.STATEMENTS.frame(spark, sf_dir, heavy=True))


@job("trace_headers", f"""
SELECT event_id, {sql.trace_id('own_trace_header')} AS own_trace, tp_trace, tp_parent, tp_sampled,
  coalesce(CASE WHEN length(string_split(traceparent, '-')[2]) = 32 THEN string_split(traceparent, '-')[2] END,
    nullif(own_trace_header, ''), nullif(generic_header, '')) AS lenient
FROM ({sql.with_traceparent(t.HEADERS.sql())})""")
def trace_headers(spark, sf_dir):
    parsed = tc.parse_traceparent(F.col("traceparent"))
    return t.HEADERS.frame(spark, sf_dir, heavy=True).withColumn("tp", parsed).select(
        "event_id", tc.normalize_trace_id(F.col("own_trace_header")).alias("own_trace"),
        F.col("tp.trace_id").alias("tp_trace"), F.col("tp.parent_span_id").alias("tp_parent"),
        F.col("tp.sampled").alias("tp_sampled"),
        tc.lenient_trace_id(F.col("traceparent"), F.col("own_trace_header"), F.col("generic_header")).alias("lenient"))


@job("baggage_members", f"""
SELECT event_id, concat(regexp_extract(baggage, 'ACME-trace_id=([^,]*)', 1), CASE WHEN event_id % 2 = 0 THEN '=b==' ELSE '' END)
    AS own_trace_id, CASE WHEN event_id % 3 = 0 THEN 'new=' ELSE 'old' END AS own_span_id,
  concat('vendor=value,k', user_id % 7, '=v') AS preserved
FROM ({t.HEADERS.sql()}) WHERE baggage IS NOT NULL""")
def baggage_members(spark, sf_dir):
    """Some ids hold the sign that ends a name, some members come twice."""
    trace = F.when(F.col("event_id") % 2 == 0, F.regexp_replace("baggage", "(ACME-trace_id=[^,]*)", "$1=b==")).otherwise(F.col("baggage"))
    members = tc.baggage_members(F.when(F.col("event_id") % 3 == 0, F.concat(trace, F.lit(", acme-span_id=new="))).otherwise(trace), VENDOR)
    return t.HEADERS.frame(spark, sf_dir).where("baggage IS NOT NULL").withColumn("m", members).select(
        "event_id", F.col("m.own")["trace_id"].alias("own_trace_id"), F.col("m.own")["span_id"].alias("own_span_id"),
        F.col("m.preserved").alias("preserved"))


@job("route_names", f"""
SELECT event_id, coalesce(nullif(route, ''), '{fixed.UNMATCHED_ROUTE}') AS by_url,
  coalesce(nullif(endpoint, ''), nullif(route, ''), '{fixed.UNMATCHED_ROUTE}') AS by_endpoint,
  coalesce('/' || ltrim(nullif(route, ''), '/'), path) AS by_route,
  CASE WHEN module = '' THEN view ELSE module || '.' || view END AS by_function,
  coalesce(raised IS NOT NULL OR status BETWEEN 500 AND 599, false) AS failed
FROM ({t.ACCESS.sql()})""")
def route_names(spark, sf_dir):
    c = F.col
    django = (c("route"), c("path"), c("module"), c("view"))
    return t.ACCESS.frame(spark, sf_dir).select(
        "event_id", rec.asgi_transaction(c("route"), c("endpoint")).alias("by_url"),
        rec.asgi_transaction(c("route"), c("endpoint"), "endpoint").alias("by_endpoint"),
        rec.django_transaction(*django).alias("by_route"),
        rec.django_transaction(*django, style="function_name").alias("by_function"),
        rec.is_failed_request(c("status"), c("raised").isNotNull()).alias("failed"))


@job("request_ids", f"""
SELECT event_id, coalesce(nullif(x_request_id, ''), nullif(own_request_header, ''),
  md5(concat('request-', event_id))) AS request_id FROM ({t.HEADERS.sql()})""")
def request_id_pick(spark, sf_dir):
    return request_ids(t.HEADERS.frame(spark, sf_dir)).select("event_id", "request_id")


@job("request_users", f"""
SELECT event_id, coalesce(nullif(login, ''), nullif(username, '')) AS id, email, ip FROM (
  SELECT *, CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(login_id AS VARCHAR) END AS login, coalesce(nullif(trim(string_split(forwarded_for, ',')[1]), ''), nullif(remote_addr, '')) AS ip
  FROM ({t.HEADERS.sql()})) WHERE coalesce(nullif(login, ''), nullif(username, ''), email, ip) IS NOT NULL""")
def request_users(spark, sf_dir):
    ip = rec.client_ip(F.col("forwarded_for"), F.col("remote_addr"), send_default_pii=True)
    login = F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("login_id").cast("string"))
    user = rec.pick_user([login, F.col("username")], F.col("email"), [ip])
    return t.HEADERS.frame(spark, sf_dir).select("event_id", user.alias("u")).where("u IS NOT NULL").select(
        "event_id", "u.*")


@job("traceback_frames", f"""
SELECT event_id, CAST(i AS INT) AS frame, f[i] AS filename, n[i] AS function, CAST(l[i] AS INT) AS lineno,
  NOT (f[i][1] = '<' OR contains(f[i], 'site-packages')) AS in_app, lines FROM (
  SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (
    SELECT event_id, regexp_extract_all(traceback, 'File "([^"]+)", line (\\d+), in (\\S+)', 1) AS f,
      regexp_extract_all(traceback, 'File "([^"]+)", line (\\d+), in (\\S+)', 2) AS l,
      regexp_extract_all(traceback, 'File "([^"]+)", line (\\d+), in (\\S+)', 3) AS n,
      CAST(len(list_filter(string_split(traceback, chr(10)), lambda x: trim(x) <> '')) AS INT) AS lines
    FROM ({t.TRACEBACKS.sql()})))""")
def traceback_frames(spark, sf_dir):
    text = F.col("traceback")
    frames = t.TRACEBACKS.frame(spark, sf_dir).select(
        "event_id", F.size(rec.traceback_lines(text)).alias("lines"),
        F.posexplode(rec.traceback_frames(text)).alias("pos", "f"))
    return frames.select("event_id", (F.col("pos") + 1).alias("frame"), "f.filename", "f.function", "f.lineno",
                         F.col("f.inApp").alias("in_app"), "lines")


@job("url_paths", f"""
SELECT page_id, {sql.stripped_path('url')} AS stripped, coalesce(nullif({sql.url_netloc('url')}, ''),
  {sql.url_path('url')}) AS host, {sql.url_path('url')} AS path
FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN replace(url, '?', ';id=1;v=2?') WHEN 1 THEN replace(url, '/en/', '/en;a=1/') ELSE url END AS url FROM pages)""")
def url_paths(spark, sf_dir):
    """Some urls hold parameters in their last segment, which go, some in another one, which stay."""
    url = F.col("url")
    changed = F.when(F.col("page_id") % 3 == 0, F.replace(url, F.lit("?"), F.lit(";id=1;v=2?"))).when(
        F.col("page_id") % 3 == 1, F.replace(url, F.lit("/en/"), F.lit("/en;a=1/"))).otherwise(url)
    return t.read(spark, sf_dir, "pages").withColumn("url", changed).select(
        "page_id", rec.strip_query(url).alias("stripped"), rec.url_host(url).alias("host"),
        rec.url_path(url).alias("path"))


@job("log_levels", f"""
SELECT levelno, CASE WHEN levelno >= 40 THEN 'error' WHEN levelno >= 30 THEN 'warn' WHEN levelno >= 20 THEN 'info'
  ELSE 'debug' END AS crumb_level, CASE WHEN levelno >= 50 THEN 'fatal' WHEN levelno >= 40 THEN 'error' ELSE 'warn'
  END AS event_level, count(*) AS records FROM ({t.LOG_RECORDS.sql()}) GROUP BY levelno""")
def log_levels(spark, sf_dir):
    level = F.col("levelno")
    return t.LOG_RECORDS.frame(spark, sf_dir).groupBy("levelno").agg(F.count(F.lit(1)).alias("records")).select(
        "levelno", rec.crumb_level_of(level).alias("crumb_level"), rec.event_level_of(level).alias("event_level"),
        "records")


@job("status_classes", f"""
SELECT status, CASE WHEN status = 401 THEN 'auth_stop' WHEN status IN (429, 503) THEN 'retry_after'
  WHEN status BETWEEN 400 AND 499 THEN 'rejected' WHEN status >= 500 OR status = 0 THEN 'retry' ELSE 'sent' END AS meaning,
  (status BETWEEN 200 AND 299 OR (status BETWEEN 400 AND 499 AND status <> 429)) AS terminal, count(*) AS attempts
FROM ({t.ATTEMPTS.sql()}) GROUP BY status""")
def status_classes(spark, sf_dir):
    status = F.col("status")
    return t.ATTEMPTS.frame(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("attempts")).select(
        "status", rec.status_class(status).alias("meaning"), rec.spool_terminal(status).alias("terminal"), "attempts")


def retry_after_sql(value: str, at_ms: str) -> str:
    return (f"least(greatest(coalesce(CAST(CASE WHEN regexp_matches(trim({value}), '^[+-]?[0-9]+$') THEN trim({value}) "
            f"END AS DOUBLE), (epoch_ms(try_strptime({value}, '%a, %d %b %Y %H:%M:%S GMT')) - {at_ms}) / 1000.0, "
            f"0.0), 0.0), 300.0)")


@job("retry_after", f"""
SELECT event_id, attempt, round({retry_after_sql('retry_after', 'ts_ms')}, 3) AS wait_seconds
FROM ({t.ATTEMPTS.sql()})""")
def retry_after(spark, sf_dir):
    at = F.timestamp_millis(F.col("ts_ms"))
    return t.ATTEMPTS.frame(spark, sf_dir).select(
        "event_id", "attempt", F.round(rec.retry_after_seconds(F.col("retry_after"), at), 3).alias("wait_seconds"))


@job("flag_values", f"""
SELECT order_key, lower(value) IN ('true', '1', 'yes') AS as_bool, TRY_CAST(CASE WHEN
  regexp_matches(trim(value), '^[+-]?[0-9]+$') THEN trim(value) END AS BIGINT) AS as_int, TRY_CAST(trim(value) AS DOUBLE) AS as_float
FROM ({t.FLAGS.sql()})""")
def flag_values(spark, sf_dir):
    value = F.col("value")
    return t.FLAGS.frame(spark, sf_dir).select(
        "order_key", rec.flag_as_bool(value).alias("as_bool"), rec.flag_as_int(value).alias("as_int"),
        rec.flag_as_float(value).alias("as_float"))
