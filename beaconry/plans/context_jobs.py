"""Breadcrumbs, users and duplicates around errors; span parents and continued traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.operators import context, spans
from beaconry.operators.hot_keys import newest
from beaconry.operators.delivery import evictions
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.sources import tables as t

OWNED_CRUMBS = f"""(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY process_id, error_id ORDER BY ts_ms DESC, event_id DESC) AS age FROM (
    SELECT *, first(CASE WHEN is_error THEN event_id END IGNORE NULLS) OVER (PARTITION BY process_id
      ORDER BY ts_ms, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS error_id
    FROM ({t.CRUMB_MARKS.sql()})) WHERE NOT is_error AND error_id IS NOT NULL) WHERE age <= {{limit}})"""


@job("attach_breadcrumbs", f"""
SELECT process_id, error_id, CAST(count(*) AS INT) AS crumbs, string_agg(message, '|' ORDER BY ts_ms, event_id) AS messages
FROM {OWNED_CRUMBS.format(limit=50)} GROUP BY process_id, error_id""")
def attach_breadcrumbs(spark, sf_dir):
    taken = context.attach_breadcrumbs(t.CRUMB_MARKS.frame(spark, sf_dir), F.col("message"))
    return taken.select("process_id", "error_id", F.size("breadcrumbs").alias("crumbs"),
                        F.array_join("breadcrumbs", "|").alias("messages"))


@job("crumb_owners", f"""
SELECT event_id, process_id, error_id FROM {OWNED_CRUMBS.format(limit=3)}""")
def crumb_owners(spark, sf_dir):
    """With a small buffer, so that older crumbs fall out."""
    return context.crumb_owners(t.CRUMB_MARKS.frame(spark, sf_dir), limit=3).select(
        "event_id", "process_id", "error_id")


@job("user_at_error", f"""
SELECT event_id, coalesce(explicit_user_id, CASE WHEN state = '-' THEN NULL ELSE state END) AS error_user_id FROM (
  SELECT *, last(CASE kind WHEN 'set_user' THEN user_id WHEN 'clear_user' THEN '-' END IGNORE NULLS) OVER (
    PARTITION BY process_id ORDER BY ts_ms, event_id) AS state FROM ({t.USER_MARKS.sql()})) WHERE kind = 'error'""")
def user_at_error(spark, sf_dir):
    return context.user_at_error(t.USER_MARKS.frame(spark, sf_dir)).select("event_id", "error_user_id")


@job("newest_n", f"""
SELECT event_id, process_id FROM (SELECT *, row_number() OVER (PARTITION BY process_id ORDER BY ts_ms DESC, event_id DESC)
  AS age FROM ({t.CRUMB_MARKS.sql()})) WHERE age <= 20""")
def newest_n(spark, sf_dir):
    return newest(t.CRUMB_MARKS.frame(spark, sf_dir).select("event_id", "ts_ms", "process_id"), ["process_id"],
                  ["ts_ms", "event_id"], 20).select("event_id", "process_id")


@job("buffer_evictions", f"""
SELECT process_id, greatest(count(*) - 20, 0) AS evicted FROM ({t.CRUMB_MARKS.sql()}) GROUP BY process_id""")
def buffer_evictions(spark, sf_dir):
    return evictions(t.CRUMB_MARKS.frame(spark, sf_dir), ["process_id"], 20)


_REQUEST_ERRORS = (f"SELECT event_id, md5(concat('q', user_id)) AS request_id, concat(raised, '-', user_id % 7) AS "
                   f"exception_id FROM ({t.ACCESS.sql()}) WHERE raised IS NOT NULL")
_LOG_ERRORS = (f"SELECT event_id, md5(concat('q', user_id)) AS request_id, concat(coalesce(exception_class, '?'), '-', "
               f"user_id % 7) AS exception_id FROM ({t.LOG_RECORDS.sql()}) WHERE levelno >= 40")


@job("dedupe_captured", f"""
WITH r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY event_id) AS k
  FROM ({_REQUEST_ERRORS})) WHERE k = 1), l AS ({_LOG_ERRORS})
SELECT event_id, request_id, exception_id, 'request' AS origin FROM r UNION ALL
SELECT event_id, request_id, exception_id, 'log' FROM l WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.request_id = l.request_id AND r.exception_id = l.exception_id)""")
def dedupe_captured(spark, sf_dir):
    requests = t.ACCESS.frame(spark, sf_dir).where("raised IS NOT NULL").selectExpr(
        "event_id", "md5(concat('q', user_id)) AS request_id", "concat(raised, '-', user_id % 7) AS exception_id")
    logs = t.LOG_RECORDS.frame(spark, sf_dir).where("levelno >= 40").selectExpr(
        "event_id", "md5(concat('q', user_id)) AS request_id",
        "concat(coalesce(exception_class, '?'), '-', user_id % 7) AS exception_id")
    return context.dedupe_captured(requests, logs)


@job("dedupe_crumbs", f"""
SELECT record_id, CASE WHEN levelno >= 20 THEN 'bridge' ELSE 'handler' END AS source, CASE WHEN levelno >= 40 THEN 'error'
  WHEN levelno >= 30 THEN 'warn' WHEN levelno >= 20 THEN 'info' ELSE 'warn' END AS level, message
FROM ({t.LOG_RECORDS.sql()})""")
def dedupe_crumbs(spark, sf_dir):
    from beaconry.functions.records import crumb_level_of

    records = t.LOG_RECORDS.frame(spark, sf_dir)
    bridge = records.where("levelno >= 20").select(
        "record_id", F.lit("bridge").alias("source"), crumb_level_of(F.col("levelno")).alias("level"), "message")
    handler = records.select("record_id", F.lit("handler").alias("source"), F.lit("warn").alias("level"), "message")
    return context.dedupe_crumbs(bridge.unionByName(handler))


@job("infer_parent_spans", f"""
WITH s AS ({t.SPAN_MARKS.sql()})
SELECT c.span_id, coalesce(max_by(p.span_id, (p.start_ms, p.start_seq)) FILTER (WHERE p.span_id IS NOT NULL),
  any_value(c.inbound_parent), '') AS parent_span_id
FROM s c LEFT JOIN s p ON c.context_id = p.context_id AND c.trace_id = p.trace_id
  AND (p.start_ms < c.start_ms OR (p.start_ms = c.start_ms AND p.start_seq < c.start_seq))
  AND (p.finish_ms IS NULL OR p.finish_ms > c.start_ms OR (p.finish_ms = c.start_ms AND p.finish_seq > c.start_seq))
GROUP BY c.span_id""")
def infer_parent_spans(spark, sf_dir):
    return spans.infer_parent_spans(t.SPAN_MARKS.frame(spark, sf_dir)).select("span_id", "parent_span_id")


@job("continue_traces", f"""
SELECT event_id, coalesce(tp_trace, {sql.trace_id('own_trace_header')}, md5(concat('q', event_id))) AS trace_id,
  tp_parent AS parent_span_id, tp_sampled AS inbound_sampled FROM ({sql.with_traceparent(t.HEADERS.sql())})""")
def continue_traces(spark, sf_dir):
    requests = t.HEADERS.frame(spark, sf_dir).selectExpr(
        "event_id", "concat('q', event_id) AS request_id", "traceparent", "own_trace_header")
    return spans.continue_traces(requests).select("event_id", "trace_id", "parent_span_id", "inbound_sampled")
