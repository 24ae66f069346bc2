"""Read-side reports over the telemetry tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import scrub
from beaconry.operators import instrument as ins, normalize, reports, sessions, sketches
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.plans.session_jobs import FOLDED
from beaconry.session import scratch_dir
from beaconry.sources import tables as t, trace_store

_CAPTURED = "upper(method) IN ('CONNECT','DELETE','GET','PATCH','POST','PUT','TRACE')"
_CODE = "coalesce(status, CASE WHEN raised IS NOT NULL THEN 500 ELSE 0 END)"


@job("trace_summary", f"""
WITH s AS ({t.SPANS.sql()}), c AS (SELECT trace_id, parent_span_id AS span_id, sum(duration_ms) AS children_ms FROM s
  WHERE parent_span_id <> '' GROUP BY ALL)
SELECT s.trace_id, max(CASE WHEN parent_span_id = '' THEN operation END) AS root_operation, count(*) AS spans,
  count(*) FILTER (WHERE status = 'error') AS error_spans, max(end_ms) - min(start_ms) AS wall_ms,
  CAST(sum(greatest(duration_ms - coalesce(children_ms, 0), 0)) AS BIGINT) AS self_ms
FROM s LEFT JOIN c USING (trace_id, span_id) GROUP BY s.trace_id""")
def trace_summary(spark, sf_dir):
    return reports.trace_summary(t.SPANS.frame(spark, sf_dir))


@job("trace_linked", f"""
SELECT event_id, a.trace_id, coalesce(s.n, 0) AS linked_spans, coalesce(l.n, 0) AS linked_logs,
  coalesce(r.n, 0) AS linked_requests, coalesce(q.n, 0) AS linked_queries
FROM ({t.ACCESS.sql()}) a
LEFT JOIN (SELECT trace_id, count(*) AS n FROM ({t.SPANS.sql()}) GROUP BY trace_id) s ON a.trace_id = s.trace_id
LEFT JOIN (SELECT trace_id, count(*) AS n FROM ({t.LOGS.sql()}) GROUP BY trace_id) l ON a.trace_id = l.trace_id
LEFT JOIN (SELECT trace_id, count(*) AS n FROM ({t.ACCESS.sql()}) GROUP BY trace_id) r ON a.trace_id = r.trace_id
LEFT JOIN (SELECT trace_id, count(*) AS n FROM ({t.STATEMENTS.sql()}) GROUP BY trace_id) q ON a.trace_id = q.trace_id
WHERE raised IS NOT NULL""")
def trace_linked(spark, sf_dir):
    access = t.ACCESS.frame(spark, sf_dir)
    errors = access.where("raised IS NOT NULL").select("event_id", "trace_id")
    return reports.trace_linked(errors, t.SPANS.frame(spark, sf_dir), t.LOGS.frame(spark, sf_dir), access,
                                t.STATEMENTS.frame(spark, sf_dir))


@job("orphan_spans", f"""
WITH s AS MATERIALIZED (SELECT trace_id, span_id, parent_span_id FROM ({t.SPANS.sql()})),
p AS MATERIALIZED (SELECT DISTINCT trace_id, span_id FROM s)
SELECT s.* FROM s ANTI JOIN p ON p.trace_id = s.trace_id AND p.span_id = s.parent_span_id WHERE s.parent_span_id <> ''""")
def orphan_spans(spark, sf_dir):
    return reports.orphan_spans(t.SPANS.frame(spark, sf_dir).select("trace_id", "span_id", "parent_span_id"))


@job("errors_without_trace", f"""
SELECT event_id, trace_id FROM ({t.ACCESS.sql()}) WHERE raised IS NOT NULL AND trace_id NOT IN (
  SELECT trace_id FROM ({t.SPANS.sql()}) WHERE status = 'error')""")
def errors_without_trace(spark, sf_dir):
    errors = t.ACCESS.frame(spark, sf_dir).where("raised IS NOT NULL").select("event_id", "trace_id")
    return reports.errors_without_trace(errors, t.SPANS.frame(spark, sf_dir).where("status = 'error'"))


@job("requests_with_errors", f"""
SELECT event_id, request_id FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED} AND {_CODE} BETWEEN 500 AND 599""")
def requests_with_errors(spark, sf_dir):
    requests = ins.asgi_requests(t.ACCESS.frame(spark, sf_dir))
    return reports.requests_with_errors(ins.request_rows(requests).select("event_id", "request_id"),
                                        ins.asgi_errors(requests))


_QUERIES = (f"(SELECT *, substring(md5(n), 1, 16) AS query_hash, greatest(0, CAST(trunc(duration_ms) AS BIGINT)) AS ms "
            f"FROM (SELECT *, {sql.normalized_query('statement')} AS n FROM ({t.STATEMENTS.sql()})))")


@job("query_stats", f"""
SELECT query_hash, n AS normalized_query, count(*) AS calls, count(*) FILTER (WHERE status = 'error') AS errors,
  round(avg(ms), 3) AS mean_ms, round(quantile_cont(ms, 0.5), 3) AS p50_ms, round(quantile_cont(ms, 0.95), 3) AS p95_ms,
  CAST(sum(greatest(coalesce(rows_affected, -1), 0)) AS BIGINT) AS rows FROM {_QUERIES} GROUP BY query_hash, n""")
def query_stats(spark, sf_dir):
    stats = reports.query_stats(normalize.normalize_db(t.STATEMENTS.frame(spark, sf_dir, heavy=True)))
    return stats.withColumns({c: F.round(c, 3) for c in ("mean_ms", "p50_ms", "p95_ms")})


def _quantile_fits(stats, rows, keys, q):
    """Per key whether ``p95_ms`` is a quantile of the rows within the error that its sketch allows."""
    share, error = F.lit(q), sketches.rank_error()
    held = rows.join(stats, keys).groupBy(*[c for c in stats.columns if c != "p95_ms"]).agg(
        F.avg((F.col("_ms") <= F.col("p95_ms")).cast("double")).alias("_upto"), F.avg((F.col("_ms") < F.col("p95_ms")).cast("double")).alias("_below"))
    return held.withColumn("p95_fits", (F.col("_upto") >= share - error) & (F.col("_below") <= share + error)).drop("_upto", "_below")


@job("query_stats_sketched", f"""
SELECT query_hash, count(*) AS calls, count(*) FILTER (WHERE status = 'error') AS errors, round(avg(ms), 3) AS mean_ms,
  CAST(sum(greatest(coalesce(rows_affected, -1), 0)) AS BIGINT) AS rows, true AS p95_fits FROM {_QUERIES} GROUP BY query_hash""")
def query_stats_sketched(spark, sf_dir):
    """Statistics of statements merged from hourly sketches, whose 95th percentile is then held against all rows."""
    queries = normalize.normalize_db(t.STATEMENTS.frame(spark, sf_dir, heavy=True))
    stats = sketches.stats_between(sketches.hourly_query_stats(queries), ["query_hash"], ["errors", "rows"], quantiles={"p95": 0.95})
    fits = _quantile_fits(stats, queries.select("query_hash", F.col("duration_ms").alias("_ms")), ["query_hash"], 0.95)
    return fits.withColumn("mean_ms", F.round("mean_ms", 3))


_HALF = (1704067200000 + 5 * 86_400_000, 1704067200000 + 20 * 86_400_000)


@job("endpoint_stats_sketched", f"""
SELECT upper(method) AS method, coalesce(route, 'generic ASGI request') AS route, count(*) AS calls, count(*) FILTER (WHERE {_CODE} >= 500) AS failed,
  CAST(sum(response_size) AS BIGINT) AS bytes, true AS p95_fits FROM ({t.ACCESS.sql()})
WHERE {_CAPTURED} AND ts_ms >= {_HALF[0]} AND ts_ms < {_HALF[1]} GROUP BY 1, 2""")
def endpoint_stats_sketched(spark, sf_dir):
    """Statistics of endpoints over fifteen days of hourly sketches."""
    requests = served_requests(spark, sf_dir)
    keys = ["method", "route"]
    stats = sketches.stats_between(sketches.hourly_endpoint_stats(requests), keys, ["failed", "bytes"], *_HALF, quantiles={"p95": 0.95})
    inside = requests.where(F.col("ts_ms").between(_HALF[0], _HALF[1] - 1)).select(*keys, F.col("duration_ms").alias("_ms"))
    return _quantile_fits(stats.drop("mean_ms"), inside, keys, 0.95)


def served_requests(spark, sf_dir):
    """Requests of the access log, normalized, with the route of their span."""
    requests = ins.asgi_requests(t.ACCESS.frame(spark, sf_dir, heavy=True)).withColumns({
        "event_key": F.col("event_id"), "direction": F.lit("inbound"), "route": F.col("transaction")})
    return normalize.valid(normalize.normalize_http(requests, release="1.0"))


@job("endpoint_stats", f"""
SELECT upper(method) AS method, coalesce(route, 'generic ASGI request') AS route, count(*) AS calls,
  round(avg(CASE WHEN {_CODE} >= 500 THEN 1.0 ELSE 0.0 END), 6) AS failed_share,
  round(quantile_cont(greatest(duration_ms, 0), 0.95), 3) AS p95_ms, CAST(sum(response_size) AS BIGINT) AS bytes,
  CAST(count(raised) AS BIGINT) AS raised, count(*) FILTER (WHERE raised_message <> '') AS redacted
FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED} GROUP BY 1, 2""")
def endpoint_stats(spark, sf_dir):
    """The flagship: access log to telemetry, normalized and scrubbed, to endpoint statistics."""
    rows = served_requests(spark, sf_dir).withColumn("raised_message", scrub.scrub_text(F.col("raised_message")))
    stats = reports.endpoint_stats(rows, {
        "raised": F.col("raised").isNotNull(), "redacted": F.col("raised_message").contains(fixed.REDACTED)})
    return stats.withColumns({"failed_share": F.round("failed_share", 6), "p95_ms": F.round("p95_ms", 3)})


@job("endpoint_totals", f"""
SELECT service, coalesce(route, 'generic ASGI request') AS route, count(*) AS calls, count(*) FILTER (WHERE {_CODE} >= 500)
  AS failed FROM (SELECT * REPLACE (coalesce(route, 'generic ASGI request') AS route) FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED})
GROUP BY service, route
UNION ALL SELECT service, NULL, count(*), count(*) FILTER (WHERE {_CODE} >= 500) FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED}
GROUP BY service
UNION ALL SELECT NULL, NULL, count(*), count(*) FILTER (WHERE {_CODE} >= 500) FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED}""")
def endpoint_totals(spark, sf_dir):
    return reports.endpoint_totals(served_requests(spark, sf_dir))


@job("release_health", f"""
WITH u AS (SELECT release, user_id, count(*) AS n, count(*) FILTER (WHERE status = 'crashed') AS c FROM {FOLDED} GROUP BY 1, 2)
SELECT release, CAST(sum(n) AS BIGINT) AS sessions, round(1 - sum(c) / sum(n), 6) AS crash_free_sessions, count(*) AS users,
  round(1 - count(*) FILTER (WHERE c > 0) / count(*), 6) AS crash_free_users FROM u GROUP BY release""")
def release_health(spark, sf_dir):
    folded = sessions.fold_sessions(t.SESSION_MARKS.frame(spark, sf_dir), carry=("release", "user_id"))
    health = reports.release_health(folded)
    return health.withColumns({c: F.round(c, 6) for c in ("crash_free_sessions", "crash_free_users")})


_FAMILY = "CASE WHEN release IN ('1.0', '1.1') THEN 'old' ELSE 'new' END"


@job("release_family_health", f"""
WITH u AS (SELECT {_FAMILY} AS releases, user_id, count(*) AS n, count(*) FILTER (WHERE status = 'crashed') AS c FROM {FOLDED} GROUP BY 1, 2)
SELECT releases, CAST(sum(n) AS BIGINT) AS sessions, round(1 - sum(c) / sum(n), 6) AS crash_free_sessions, count(*) AS users,
  round(count(*) FILTER (WHERE c = 0) / count(*), 6) AS crash_free_users FROM u GROUP BY releases""")
def release_family_health(spark, sf_dir):
    """Health of two families of releases, merged from the sketches of each release; a sketch of this size counts a million users exactly."""
    folded = sessions.fold_sessions(t.SESSION_MARKS.frame(spark, sf_dir), carry=("release", "user_id"))
    health = sketches.health_of(sketches.release_sketches(folded, lg_entries=20), F.expr(_FAMILY), lg_entries=20)
    return health.withColumns({c: F.round(c, 6) for c in ("crash_free_sessions", "crash_free_users")})


_GROUPED_ERRORS = ("SELECT event_id, ts_ms, user_id, coalesce(raised, 'HTTPServerError') AS exception_class, "
                   "concat(module, '.', view) AS top_frame, concat('1.', CAST(floor((ts_ms - 1704067200000) / 864000000) "
                   f"AS BIGINT)) AS release FROM ({t.ACCESS.sql()}) WHERE {_CODE} >= 500")


def _grouped_errors(spark, sf_dir):
    return t.ACCESS.frame(spark, sf_dir).where(f"{_CODE} >= 500").selectExpr(
        "event_id", "ts_ms", "user_id", "coalesce(raised, 'HTTPServerError') AS exception_class",
        "concat(module, '.', view) AS top_frame",
        "concat('1.', CAST(floor((ts_ms - 1704067200000) / 864000000) AS BIGINT)) AS release")


@job("error_groups", f"""
SELECT exception_class, top_frame, count(*) AS events, count(DISTINCT user_id) AS users, min(ts_ms) AS first_seen_ms,
  max(ts_ms) AS last_seen_ms, arg_min(release, (ts_ms, event_id)) AS new_in_release FROM ({_GROUPED_ERRORS}) GROUP BY 1, 2""")
def error_groups(spark, sf_dir):
    return reports.error_groups(_grouped_errors(spark, sf_dir))


@job("error_group_users", f"""
SELECT exception_class, top_frame, count(*) AS events, count(DISTINCT user_id) AS users,
  count(DISTINCT CASE WHEN release >= '1.2' AND old IS NULL THEN user_id END) AS new_users
FROM ({_GROUPED_ERRORS}) e LEFT JOIN (SELECT DISTINCT exception_class AS c, top_frame AS f, user_id AS old FROM ({_GROUPED_ERRORS}) WHERE release < '1.2') o
  ON c = exception_class AND f = top_frame AND old = user_id GROUP BY 1, 2""")
def error_group_users(spark, sf_dir):
    """Users of each error group and those that met it in releases from 1.2 on only, from one sketch per group and release."""
    kept = sketches.group_sketches(_grouped_errors(spark, sf_dir), lg_entries=20)
    late = F.col("release") >= "1.2"
    return sketches.users_of_groups(kept, 20).join(sketches.new_users_of_groups(kept, ~late, late, 20), ["exception_class", "top_frame"])


@job("error_group_releases", f"""
SELECT exception_class, top_frame, release, count(*) AS events, min(ts_ms) AS first_ms, lag(release) OVER (
  PARTITION BY exception_class, top_frame ORDER BY min(ts_ms), release) AS previous_release
FROM ({_GROUPED_ERRORS}) GROUP BY exception_class, top_frame, release""")
def error_group_releases(spark, sf_dir):
    return reports.error_group_releases(_grouped_errors(spark, sf_dir))


_BEATS = (f"(SELECT *, lower(status) AS st FROM ({t.HEARTBEATS.sql()}) WHERE regexp_matches(slug, '^[a-z0-9-]+$') "
          "AND lower(status) IN ('success', 'failed'))")


@job("cron_status", f"""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY ts_ms DESC, run_id DESC) AS age FROM {_BEATS}),
s AS (SELECT slug, any_value(st) FILTER (WHERE age = 1) AS latest_status, max(ts_ms) AS latest_ms,
  coalesce(min(age) FILTER (WHERE st = 'success') - 1, count(*)) AS failure_streak FROM b GROUP BY slug),
m AS (SELECT DISTINCT concat(regexp_replace(lower(o_orderpriority), '[^a-z0-9-]', '-', 'g'), '-', o_custkey % 33) AS slug
  FROM orders WHERE o_custkey % 33 > 5)
SELECT coalesce(s.slug, m.slug) AS slug, latest_status, latest_ms, failure_streak, m.slug IS NOT NULL AS known
FROM s FULL JOIN m ON s.slug = m.slug""")
def cron_status(spark, sf_dir):
    beats = normalize.valid(normalize.validate_heartbeats(t.HEARTBEATS.frame(spark, sf_dir)))
    monitors = t.read(spark, sf_dir, "orders").where("o_custkey % 33 > 5").selectExpr(
        "concat(regexp_replace(lower(o_orderpriority), '[^a-z0-9-]', '-'), '-', o_custkey % 33) AS slug").distinct()
    return reports.cron_status(beats, monitors)


@job("slowest_spans", f"""
SELECT operation, trace_id, span_id, duration_ms FROM (SELECT *, row_number() OVER (PARTITION BY operation
  ORDER BY duration_ms DESC, trace_id DESC, span_id DESC) AS k FROM ({t.SPANS.sql()})) WHERE k <= 10""")
def slowest_spans(spark, sf_dir):
    spans = t.SPANS.frame(spark, sf_dir).select("operation", "trace_id", "span_id", "duration_ms")
    return reports.slowest_spans(spans, 10)


@job("n_plus_one", f"""
SELECT user_trace AS trace_id, parent_span_id, query_hash, count(*) AS calls, CAST(sum(ms) AS BIGINT) AS total_ms FROM (
  SELECT *, md5(concat('t', o.o_custkey % 40)) AS user_trace FROM {_QUERIES} q JOIN orders o ON o.o_orderkey = q.statement_id)
WHERE parent_span_id <> '' GROUP BY 1, 2, 3 HAVING count(*) >= 5""")
def n_plus_one(spark, sf_dir):
    statements = t.Projection("orders", {**t.STATEMENTS.columns, "trace_id": "md5(concat('t', o_custkey % 40))"})
    queries = normalize.normalize_db(statements.frame(spark, sf_dir)).where("parent_span_id IS NOT NULL")
    return reports.n_plus_one(queries, 5)


@job("flag_lookup", f"""
WITH f AS (SELECT user_id, flag_key, arg_max(enabled, order_key) AS enabled, arg_max(value, order_key) AS value
  FROM ({t.FLAGS.sql()}) GROUP BY 1, 2)
SELECT c_custkey AS user_id, 'flag-p' AS flag_key, coalesce(enabled, false) AS enabled, coalesce(value, 'off') AS value,
  lower(coalesce(value, 'off')) IN ('true', '1', 'yes') AS as_bool, TRY_CAST(CASE WHEN regexp_matches(value,
  '^[+-]?[0-9]+$') THEN value END AS BIGINT) AS as_int, TRY_CAST(value AS DOUBLE) AS as_float
FROM customer LEFT JOIN f ON f.user_id = c_custkey AND f.flag_key = 'flag-p'""")
def flag_lookup(spark, sf_dir):
    flags = t.FLAGS.frame(spark, sf_dir).groupBy("user_id", "flag_key").agg(
        F.max_by("enabled", "order_key").alias("enabled"), F.max_by("value", "order_key").alias("value"))
    users = t.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit("flag-p").alias("flag_key"))
    return reports.flag_lookup(users, flags, "off")


_TIMELINE = f"""
  SELECT 'log' AS kind, trace_id, ts_ms, message AS detail, level, NULL AS status FROM ({t.LOGS.sql()})
  UNION ALL SELECT 'request', trace_id, ts_ms, host, NULL, CAST({_CODE} AS VARCHAR) FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED}
  UNION ALL SELECT 'span', trace_id, start_ms, operation, NULL, status FROM ({t.SPANS.sql()})
  UNION ALL SELECT 'query', coalesce(nullif(trace_id, ''), active_trace_id), ts_ms, n, NULL, coalesce(status, 'success')
    FROM {_QUERIES}"""


@job("telemetry_timeline", f"SELECT kind, trace_id, ts_ms, detail, level, status FROM ({_TIMELINE})")
def telemetry_timeline(spark, sf_dir):
    """All kinds of all traces in one table; trace_store clusters it by trace and time for lookups."""
    requests = ins.request_rows(ins.asgi_requests(t.ACCESS.frame(spark, sf_dir)))
    return reports.telemetry_timeline({
        "log": t.LOGS.frame(spark, sf_dir).select("trace_id", "ts_ms", F.col("message").alias("detail"), "level"),
        "request": requests.select("trace_id", "ts_ms", F.col("host").alias("detail"),
                                   F.col("status_code").cast("string").alias("status")),
        "span": t.SPANS.frame(spark, sf_dir).select(
            "trace_id", F.col("start_ms").alias("ts_ms"), F.col("operation").alias("detail"), "status"),
        "query": normalize.normalize_db(t.STATEMENTS.frame(spark, sf_dir)).select(
            "trace_id", "ts_ms", F.col("normalized_query").alias("detail"), "status"),
    })


@job("trace_timeline", f"""
SELECT kind, trace_id, ts_ms, detail, level, status FROM ({_TIMELINE}) WHERE trace_id IN (
  SELECT trace_id FROM ({t.ACCESS.sql()}) ORDER BY duration_ms DESC, event_id LIMIT 20)""")
def trace_timeline(spark, sf_dir):
    """The timelines of the traces of the 20 slowest requests, looked up in a store clustered by trace."""
    folder = scratch_dir(spark, "traces")
    trace_store.write_trace_store(telemetry_timeline(spark, sf_dir), folder)
    slowest = t.ACCESS.frame(spark, sf_dir).orderBy(F.col("duration_ms").desc(), "event_id").limit(20).select("trace_id").collect()
    return trace_store.timeline(spark, folder, [r.trace_id for r in slowest]).drop("part")
