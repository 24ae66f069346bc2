"""Release-health session jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.functions.records import session_mark_of
from beaconry.operators import normalize, sessions
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.sources import tables as t

FOLDED = f"""(
WITH m AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts_ms, event_id) AS k FROM ({t.SESSION_MARKS.sql()})),
e AS (SELECT session_id, min(k) AS end_k FROM m WHERE mark = 'end' GROUP BY session_id),
j AS (SELECT m.*, e.end_k FROM m LEFT JOIN e USING (session_id) WHERE e.end_k IS NULL OR m.k <= e.end_k)
SELECT session_id, coalesce(max(CASE WHEN k = end_k THEN final_status END), CASE WHEN bool_or(mark = 'crash') THEN 'crashed'
    WHEN bool_or(mark = 'abnormal') THEN 'abnormal' WHEN bool_or(mark = 'error') THEN 'errored' ELSE 'ok' END) AS status,
  CAST(sum(CASE WHEN mark IN ('error', 'crash') THEN 1 ELSE 0 END) AS BIGINT) AS error_count, min(ts_ms) AS started_ms,
  max(ts_ms) - min(ts_ms) AS duration_ms, bool_or(end_k IS NOT NULL) AS ended, any_value(release) AS release,
  any_value(user_id) AS user_id FROM j GROUP BY session_id)"""


@job("fold_sessions", f"SELECT session_id, status, error_count, started_ms, duration_ms, ended FROM {FOLDED}")
def fold_sessions(spark, sf_dir):
    return sessions.fold_sessions(t.SESSION_MARKS.frame(spark, sf_dir))


@job("session_summary", f"""
SELECT status, ended, count(*) AS sessions, CAST(sum(error_count) AS BIGINT) AS errors, max(duration_ms) AS longest_ms
FROM {FOLDED} GROUP BY status, ended""")
def session_summary(spark, sf_dir):
    return sessions.fold_sessions(t.SESSION_MARKS.frame(spark, sf_dir)).groupBy("status", "ended").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("error_count").alias("errors"),
        F.max("duration_ms").alias("longest_ms"))


@job("session_mark", """
SELECT event_id, CASE WHEN event_id % 5 = 0 OR lower(l) = 'fatal' THEN 'crash' WHEN lower(l) = 'error' THEN 'error' END AS mark
FROM (SELECT event_id, coalesce(CASE event_id % 6 WHEN 0 THEN 'FATAL' WHEN 1 THEN 'warning' WHEN 2 THEN 'error' END,
  'error') AS l FROM events)""")
def session_mark(spark, sf_dir):
    e = F.col("event_id")
    level = F.when(e % 6 == 0, "FATAL").when(e % 6 == 1, "warning").when(e % 6 == 2, "error").when(e % 6 == 3, "")
    handled = F.when(e % 5 == 0, F.lit(False)).when(e % 5 == 1, F.lit(True))
    return t.read(spark, sf_dir, "events").select("event_id", session_mark_of(level, handled).alias("mark"))


_NOW = 1706572800000  # 2024-01-30


@job("recover_sessions", f"""
WITH v AS (SELECT * FROM ({t.SESSION_STATES.sql()}) WHERE version = 1 AND session_id <> '' AND started_at IS NOT NULL
  AND status IN {sql.in_list(fixed.SESSION_STATUSES)}),
l AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY updated_at DESC, started_at DESC) AS k FROM v)
SELECT session_id, CASE WHEN status = 'crashed' THEN 'crashed' ELSE 'abnormal' END AS status,
  greatest(0, least(9007199254740991, updated_at - started_at)) AS duration_ms FROM l
WHERE k = 1 AND NOT closed AND {_NOW} - started_at <= 604800000 AND coalesce(recovery_attempts, 0) < 3
  AND lock_until <= {_NOW} AND coalesce(nullif(release, ''), sdk_version) IS NOT NULL""")
def recover_sessions(spark, sf_dir):
    states = normalize.valid(normalize.validate_session_states(t.SESSION_STATES.frame(spark, sf_dir)))
    return sessions.recover_sessions(states, F.lit(_NOW))


@job("session_starts", f"""
SELECT session_id, r AS release, environment, user_id, ts_ms FROM (
  SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts_ms, event_id) AS k FROM (
    SELECT session_id, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN '' ELSE release END, ''), CASE WHEN event_id % 2 = 0
      THEN '0.9' END) AS r, 'production' AS environment, CAST(user_id AS VARCHAR) AS user_id, ts_ms, event_id
    FROM ({t.SESSION_MARKS.sql()})) WHERE r IS NOT NULL) WHERE k = 1""")
def session_starts(spark, sf_dir):
    opens = t.SESSION_MARKS.frame(spark, sf_dir).selectExpr(
        "session_id", "ts_ms", "event_id", "CASE WHEN event_id % 3 = 0 THEN '' ELSE release END AS release",
        "CASE WHEN event_id % 2 = 0 THEN '0.9' END AS sdk_version", "'production' AS environment",
        "CAST(user_id AS STRING) AS user_id")
    return sessions.session_starts(opens)
