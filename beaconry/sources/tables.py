"""The given tables and the telemetry logs projected from them.

A projection is plain SQL expressions over one given table, so that a job and its check read the same rows. Where
the two SQL dialects differ, a column holds a pair (Spark, DuckDB).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from beaconry.session import spread, tune


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{table}.parquet")


@dataclass(frozen=True)
class Projection:
    """Columns computed from one given table."""

    table: str
    columns: dict[str, str | tuple[str, str]]
    where: str = field(default="true")

    def frame(self, spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
        """``heavy`` spreads a scan of few splits, for jobs whose column work outweighs that."""
        source = read(spark, sf_dir, self.table)
        return self.over(spread(source) if heavy else source)

    def over(self, source: DataFrame) -> DataFrame:
        exprs = [f"{e if isinstance(e, str) else e[0]} AS {n}" for n, e in self.columns.items()]
        return source.where(self.where).selectExpr(*exprs)

    def sql(self) -> str:
        exprs = ", ".join(f"{e if isinstance(e, str) else e[1]} AS {n}" for n, e in self.columns.items())
        return f"SELECT {exprs} FROM {self.table} WHERE {self.where}"


def ms(column: str) -> tuple[str, str]:
    return f"unix_millis(CAST({column} AS timestamp))", f"epoch_us({column}) // 1000"


_EVENT = {"event_id": "event_id", "ts_ms": ms("ts"), "user_id": "user_id"}

ACCESS = Projection("events", {
    **_EVENT,
    "method": "CASE event_type WHEN 'click' THEN 'get' WHEN 'view' THEN 'OPTIONS' WHEN 'purchase' THEN 'post' "
              "WHEN 'signup' THEN 'put' ELSE 'delete' END",
    "path": "concat('/api/', event_type, '/', user_id, '?token=', event_id)",
    "route": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat('/api/', event_type, '/{id}') END",
    "endpoint": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('handle_', event_type) END",
    "module": "CASE WHEN event_id % 4 = 0 THEN '' ELSE 'shop.views' END",
    "view": "concat('view_', event_type)",
    "host": "concat('api', user_id % 5, '.example.com')",
    "service": "CASE user_id % 3 WHEN 0 THEN 'shop' WHEN 1 THEN 'search' ELSE 'pay' END",
    "status": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN NULL WHEN event_type = 'error' "
              "THEN 500 + event_id % 4 WHEN event_id % 7 = 0 THEN 404 ELSE 200 END",
    "raised": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN CASE event_id % 3 WHEN 0 THEN 'ValueError' "
              "WHEN 1 THEN 'Http404' ELSE 'KeyError' END END",
    "raised_message": "CASE WHEN event_id % 4 = 0 THEN '' ELSE "
                      "concat('no u', user_id, '@example.com from 10.0.0.', user_id % 256) END",
    "duration_ms": "CAST(floor(value) AS BIGINT) - 2",
    "request_size": "CAST(user_id % 1000 AS BIGINT)",
    "response_size": "CAST(floor(value * 10) AS BIGINT)",
    "trace_id": "md5(concat('t', event_id))",
    "request_id": "md5(concat('q', event_id))",
    "parent_span_id": "CASE WHEN event_id % 3 = 0 THEN substring(md5(concat('p', event_id)), 1, 16) END",
    "user_agent": "concat('agent/', event_id % 3)",
})

LOGS = Projection("events", {
    **_EVENT,
    "log_id": "event_id",
    "level": "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warning' WHEN 'click' THEN 'debug' "
             "WHEN 'view' THEN 'warn' ELSE 'info' END",
    "message": "concat('user u', user_id, '@example.com from 10.0.0.', user_id % 256, ' did ', event_type)",
    "service": "CASE WHEN event_id % 6 = 0 THEN '' ELSE 'shop' END",
    "trace_id": "md5(concat('t', event_id))",
})

LOG_RECORDS = Projection("events", {
    **_EVENT,
    "record_id": "event_id",
    "logger": "CASE event_id % 4 WHEN 0 THEN 'ownsdk.core' WHEN 1 THEN 'django.request' ELSE 'shop.orders' END",
    "module": "event_type",
    "levelno": "CAST(CASE event_type WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 50 ELSE 40 END "
               "WHEN 'signup' THEN 30 WHEN 'click' THEN 10 WHEN 'view' THEN 20 ELSE 25 END AS INT)",
    "levelname": "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END",
    "message": "concat(event_type, ' of user ', user_id)",
    "exception_class": "CASE WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 'PermissionDenied' "
                       "WHEN 1 THEN 'ValueError' WHEN 2 THEN 'KeyError' END END",
    "captured": "event_id % 11 = 0",
    "request_id_1": "CASE WHEN event_id % 3 = 0 THEN concat('r', event_id) ELSE '' END",
    "request_id_2": "CASE WHEN event_id % 2 = 0 THEN concat('s', event_id) END",
    "request_id_3": "CAST(NULL AS STRING)",
    "trace_id": "md5(concat('t', event_id))",
    "span_id": "CASE WHEN event_id % 3 = 0 THEN substring(md5(concat('p', event_id)), 1, 16) END",
})

STATEMENTS = Projection("orders", {
    "statement_id": "o_orderkey",
    "ts_ms": ms("o_orderdate"),
    "statement": "CASE o_orderkey % 5 "
                 "WHEN 0 THEN concat('UPDATE  orders SET note = ', chr(39), 'it', chr(39), chr(39), 's', chr(39), "
                 "' WHERE o_totalprice > ', CAST(floor(o_totalprice) AS BIGINT), '.5') "
                 "WHEN 1 THEN concat(' with t1 as (select -5) SELECT * from t1 where k = ', o_custkey, ' ') "
                 "ELSE concat('SELECT *  FROM orders WHERE o_orderkey = ', o_orderkey, ' AND o_orderpriority = ', "
                 "chr(39), o_orderpriority, chr(39)) END",
    "query_type": "CAST(CASE WHEN o_orderkey % 9 = 0 THEN 'OTHER' END AS STRING)",
    "duration_ms": "o_totalprice / 1000 - 5",
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'error' WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'success' END",
    "error_message": "CASE WHEN o_orderstatus = 'F' THEN repeat(concat('deadlock on row ', o_orderkey, '. '), 30) END",
    "rows_affected": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey % 20 END",
    "database_type": "'postgresql'",
    "database_name": "'shop'",
    "trace_id": "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE md5(concat('t', o_orderkey)) END",
    "span_id": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE substring(md5(concat('s', o_orderkey)), 1, 16) END",
    "parent_span_id": "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE substring(md5(concat('c', o_custkey % 50)), 1, 16) END",
    "active_trace_id": "md5(concat('a', o_custkey))",
    "active_span_id": "CASE WHEN o_orderkey % 2 = 0 THEN substring(md5(concat('b', o_custkey)), 1, 16) END",
})

_ROOT_SPANS = Projection("orders", {
    "trace_id": "md5(concat('t', o_orderkey))",
    "span_id": "substring(md5(concat('r', o_orderkey)), 1, 16)",
    "parent_span_id": "''",
    "operation": "'http.server'",
    "description": "concat('POST /orders/', o_orderkey)",
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'ok' END",
    "start_ms": ms("o_orderdate"),
    "duration_ms": "CAST(floor(o_totalprice / 100) AS BIGINT)",
})
_CHILD_SPANS = Projection("lineitem", {
    "trace_id": "md5(concat('t', l_orderkey))",
    "span_id": "substring(md5(concat('c', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', "
               "CAST(floor(l_extendedprice) AS BIGINT))), 1, 16)",
    "parent_span_id": "CASE WHEN l_partkey % 17 = 0 THEN substring(md5(concat('gone', l_orderkey)), 1, 16) "
                      "ELSE substring(md5(concat('r', l_orderkey)), 1, 16) END",
    "operation": "CASE l_linenumber % 3 WHEN 0 THEN 'db.query' WHEN 1 THEN 'http.client' ELSE 'celery.task' END",
    "description": "concat('INSERT INTO lineitem VALUES (', l_partkey, ', ', l_suppkey, ')')",
    "status": "CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'ok' END",
    "start_ms": ms("l_shipdate"),
    "duration_ms": "CAST(floor(l_quantity) AS BIGINT) * 10",
})


class SPANS:
    """Spans: one root per order, one child per line; some children name a parent that is not there."""

    @staticmethod
    def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
        both = [p.over(spread(read(spark, sf_dir, p.table))) for p in (_ROOT_SPANS, _CHILD_SPANS)]
        return both[0].unionByName(both[1]).selectExpr("*", "start_ms + duration_ms AS end_ms")

    @staticmethod
    def sql() -> str:
        return f"SELECT *, start_ms + duration_ms AS end_ms FROM ({_ROOT_SPANS.sql()} UNION ALL {_CHILD_SPANS.sql()})"


# Marks of one process per user: crumbs between errors, and the user set or cleared now and then.
CRUMB_MARKS = Projection("events", {
    **_EVENT,
    "process_id": "concat('p', user_id)",
    "is_error": "event_type = 'error'",
    "type": "event_type",
    "level": "CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'warning' ELSE 'warn' END",
    "message": "concat(event_type, ' ', event_id)",
})
USER_MARKS = Projection("events", {
    "event_id": "event_id",
    "ts_ms": ms("ts"),
    "process_id": "concat('p', user_id % 40)",
    "kind": "CASE event_type WHEN 'signup' THEN 'set_user' WHEN 'purchase' THEN 'clear_user' "
            "WHEN 'error' THEN 'error' ELSE 'other' END",
    "user_id": "CASE WHEN event_type = 'signup' THEN concat('u', user_id) END",
    "explicit_user_id": "CASE WHEN event_type = 'error' AND event_id % 9 = 0 THEN concat('x', user_id) END",
})
SESSION_MARKS = Projection("events", {
    **_EVENT,
    "session_id": ("md5(concat(user_id, '-', date_format(ts, 'yyyyMM'), '-', CAST(floor(dayofmonth(ts) / 3) AS INT)))",
                   "md5(concat(user_id, '-', strftime(ts, '%Y%m'), '-', CAST(floor(day(ts) / 3) AS INT)))"),
    "mark": "CASE WHEN event_id % 37 = 0 THEN 'abnormal' WHEN event_type = 'error' AND event_id % 17 = 0 THEN 'crash' "
            "WHEN event_type = 'error' THEN 'error' WHEN event_type = 'purchase' AND user_id % 5 <> 0 THEN 'end' "
            "ELSE 'start' END",
    "final_status": "CASE WHEN event_type = 'purchase' AND event_id % 19 = 0 THEN 'ok' END",
    "release": "concat('1.', user_id % 4)",
})
SESSION_STATES = Projection("events", {
    **_EVENT,
    "version": "CASE WHEN event_id % 23 = 0 THEN 2 ELSE 1 END",
    "session_id": "CASE WHEN event_id % 29 = 0 THEN '' ELSE concat('s', user_id) END",
    "started_at": ("CASE WHEN event_id % 31 = 0 THEN NULL ELSE unix_millis(CAST(ts AS timestamp)) - 60000 * (event_id % 50) END",
                   "CASE WHEN event_id % 31 = 0 THEN NULL ELSE (epoch_us(ts) // 1000) - 60000 * (event_id % 50) END"),
    "updated_at": ms("ts"),
    "status": "CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'errored' WHEN 2 THEN 'crashed' WHEN 3 THEN 'abnormal' "
              "WHEN 4 THEN 'ok' ELSE 'exited' END",
    "closed": "event_id % 4 = 0",
    "recovery_attempts": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 5 END",
    "lock_until": "CASE WHEN event_id % 13 = 0 THEN 4102444800000 ELSE 0 END",
    "release": "CASE WHEN event_id % 7 = 0 THEN '' ELSE '1.0' END",
    "sdk_version": "CASE WHEN event_id % 2 = 0 THEN '0.9' END",
})
HEARTBEATS = Projection("orders", {
    "run_id": "o_orderkey",
    "ts_ms": ms("o_orderdate"),
    "slug": ("CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority ELSE "
             "concat(regexp_replace(lower(o_orderpriority), '[^a-z0-9-]', '-'), '-', o_custkey % 30) END",
             "CASE WHEN o_orderkey % 8 = 0 THEN o_orderpriority ELSE "
             "concat(regexp_replace(lower(o_orderpriority), '[^a-z0-9-]', '-', 'g'), '-', o_custkey % 30) END"),
    "status": "CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'success' ELSE "
              "CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE 'Success' END END",
    "duration_ms": "CAST(floor(o_totalprice) AS BIGINT)",
    "message": "CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 'done' END",
})
REPLAY_EVENTS = Projection("events", {
    "event_id": "event_id",
    "session_id": "concat('s', user_id)",
    "fingerprint": "CASE WHEN user_id % 3 = 0 THEN NULL ELSE concat('f', user_id % 50) END",
    "event_type": "event_type",
    "k": ("get_json_object(props, '$.k')", "json_extract_string(props, '$.k')"),
    "url": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('/page/', event_id % 9) END",
    "timestamp_millis": ("CASE WHEN event_id % 11 = 0 THEN NULL ELSE unix_millis(CAST(ts AS timestamp)) END",
                         "CASE WHEN event_id % 11 = 0 THEN NULL ELSE (epoch_us(ts) // 1000) END"),
})
_ATTEMPT_BASE = Projection("events", {
    **_EVENT,
    "client_id": "concat('c', user_id % 20)",
    "path": "CASE event_id % 4 WHEN 0 THEN '/ingest/v1/errors' WHEN 1 THEN '/ingest/v1/heartbeat' "
            "WHEN 2 THEN '/ingest/v1/logs' ELSE '/ingest/v1/db' END",
    "is_drain": "event_id % 5 = 0",
    "tries": "CAST(1 + event_id % 5 AS INT)",
    "raw_bytes": "CAST(200 + event_id % 3000 AS BIGINT)",
    "wire_bytes": "CAST(CASE WHEN event_id % 3000 >= 824 THEN 700 ELSE 200 + event_id % 3000 END AS BIGINT)",
})


class ATTEMPTS:
    """Delivery attempts: 1 to 5 per event; only the last may settle it, and 401 is rare."""

    _STATUS = ("CASE WHEN attempt < tries THEN CASE (event_id + attempt) % 4 WHEN 0 THEN 500 WHEN 1 THEN 429 "
               "WHEN 2 THEN 503 ELSE 0 END ELSE CASE WHEN event_id % 997 = 5 THEN 401 "
               "WHEN event_id % 10 = 3 THEN 400 WHEN event_id % 10 IN (4, 9) THEN 503 ELSE 202 END END")
    _RETRY_AFTER = ("CASE (event_id + attempt) % 7 WHEN 0 THEN '2' WHEN 1 THEN '999' WHEN 2 THEN '-5' "
                    "WHEN 3 THEN 'soon' WHEN 4 THEN 'Tue, 16 Jan 2024 00:00:00 GMT' WHEN 5 THEN '' END")

    @classmethod
    def frame(cls, spark: SparkSession, sf_dir: str) -> DataFrame:
        return (_ATTEMPT_BASE.frame(spark, sf_dir)
                .selectExpr("*", "explode(sequence(1, tries)) AS attempt")
                .selectExpr("*", f"{cls._STATUS} AS status", f"{cls._RETRY_AFTER} AS retry_after"))

    @classmethod
    def sql(cls) -> str:
        return (f"SELECT *, {cls._STATUS} AS status, {cls._RETRY_AFTER} AS retry_after FROM "
                f"(SELECT *, unnest(range(1, tries + 1)) AS attempt FROM ({_ATTEMPT_BASE.sql()}))")


SPOOL_ENTRIES = Projection("events", {
    **_EVENT,
    "seq": "event_id",
    "spool_id": "concat('spool', user_id % 12)",
    "path": "CASE event_id % 9 WHEN 0 THEN '/ingest/v1/errors' WHEN 1 THEN '/ingest/v1/logs' "
            "WHEN 2 THEN '/ingest/v1/spans' WHEN 3 THEN '/ingest/v1/http-requests' WHEN 4 THEN '/ingest/v1/db' "
            "WHEN 5 THEN '/ingest/v1/sessions/start' WHEN 6 THEN '/ingest/v1/heartbeat' "
            "WHEN 7 THEN '/ingest/v1/releases' ELSE '/ingest/v1/replay' END",
    "bytes": "CAST(length(props) * 1000 + event_id % 97 * 1000 AS BIGINT)",
    "corrupt": "event_id % 31 = 0",
    "status": "CAST(CASE WHEN event_id % 503 = 7 THEN 401 WHEN event_id % 6 = 0 THEN 429 WHEN event_id % 6 = 1 THEN 500 "
              "WHEN event_id % 6 = 2 THEN 422 WHEN event_id % 6 = 3 THEN 0 ELSE 202 END AS INT)",
})
HEADERS = Projection("events", {
    **_EVENT,
    "traceparent": "CASE WHEN event_id % 8 = 0 THEN NULL WHEN event_id % 9 = 0 THEN upper(concat(' 00-', "
                   "md5(concat('t', user_id)), '-', substring(md5(concat('s', event_id)), 1, 16), '-01')) "
                   "WHEN event_id % 10 = 0 THEN concat('01-', md5(concat('t', user_id)), '-', "
                   "substring(md5(concat('s', event_id)), 1, 16), '-01') "
                   "WHEN event_id % 11 = 0 THEN concat('00-', md5(concat('t', user_id)), '-0000000000000000-01') "
                   "WHEN event_id % 12 = 0 THEN concat('00-', repeat('g', 32), '-', "
                   "substring(md5(concat('s', event_id)), 1, 16), '-01') "
                   "WHEN event_id % 13 = 0 THEN concat('00-', md5(concat('t', user_id)), '-', "
                   "substring(md5(concat('s', event_id)), 1, 16), '-01 tail') "
                   "ELSE concat('00-', md5(concat('t', user_id)), '-', substring(md5(concat('s', event_id)), 1, 16), "
                   "'-0', event_id % 4) END",
    "own_trace_header": "CASE WHEN event_id % 2 = 0 THEN upper(md5(concat('o', user_id))) WHEN event_id % 3 = 0 "
                        "THEN 'not-a-trace' END",
    "generic_header": "CASE WHEN event_id % 5 = 0 THEN concat('x', event_id) END",
    "x_request_id": "CASE WHEN event_id % 4 = 0 THEN concat('q', event_id) WHEN event_id % 4 = 1 THEN '' END",
    "own_request_header": "CASE WHEN event_id % 3 = 0 THEN concat('w', event_id) END",
    "baggage": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('vendor=value, , ACME-trace_id=', "
               "substring(md5(concat('t', user_id)), 1, 8), ',acme-span_id=old ,k', user_id % 7, '=v') END",
    "forwarded_for": "CASE WHEN event_id % 3 = 0 THEN concat(' 10.1.0.', user_id % 256, ' , 10.2.0.1') "
                     "WHEN event_id % 3 = 1 THEN '' END",
    "remote_addr": "CASE WHEN event_id % 7 = 0 THEN '' ELSE concat('10.9.0.', user_id % 256) END",
    "email": "CASE WHEN event_id % 4 = 0 THEN concat('u', user_id, '@example.com') END",
    "login_id": "CASE WHEN event_id % 5 = 0 THEN user_id END",
    "username": "CASE WHEN event_id % 7 = 0 THEN concat('name', user_id) END",
})
TRACEBACKS = Projection("events", {
    **_EVENT,
    "traceback": "concat('Traceback (most recent call last):', chr(10), '  File \"/srv/app/', event_type, '.py\", line ', "
                 "1 + event_id % 90, ', in handle', chr(10), '    run(', user_id, ')', chr(10), chr(10), "
                 "CASE WHEN event_id % 3 = 0 THEN concat('  File \"/usr/lib/site-packages/lib', user_id % 5, "
                 "'.py\", line 7, in call', chr(10)) WHEN event_id % 3 = 1 THEN concat('  File \"<string>\", line 1, "
                 "in <module>', chr(10)) ELSE '' END, 'ValueError: bad')",
})
OUTBOUND_CALLS = Projection("pages", {
    "call_id": "page_id",
    "ts_ms": "1704067200000 + page_id * 1000",
    "method": "CASE page_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'post' ELSE 'get' END",
    "url": "CASE WHEN page_id % 20 = 0 THEN concat('https://ingest.example.net/v1/', page_id) "
           "WHEN page_id % 20 = 1 THEN concat('https://shop', page_id, '.example.org:8443') ELSE url END",
    "status": "CAST(CASE WHEN page_id % 6 = 0 THEN NULL WHEN page_id % 6 = 1 THEN 503 WHEN page_id % 6 = 2 THEN 404 "
              "ELSE 200 END AS INT)",
    "raised": "CASE WHEN page_id % 6 = 0 THEN 'ConnectTimeout' END",
    "raised_message": "CASE WHEN page_id % 6 = 0 THEN concat('timed out after ', page_id) END",
    "duration_ms": "CAST(length(html) % 700 AS BIGINT) - 3",
    "trace_id": "md5(concat('t', page_id))",
})
TASK_RUNS = Projection("orders", {
    "task_id": "concat('task-', o_orderkey)",
    "run_id": "o_orderkey",
    "ts_ms": ms("o_orderdate"),
    "task": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat('jobs.', lower(o_orderstatus)) END",
    "duration_ms": "CAST(floor(o_totalprice / 10) AS BIGINT)",
    "state": "CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'O' THEN 'SUCCESS' ELSE 'RETRY' END",
    "exception_class": "CASE WHEN o_orderstatus = 'F' THEN CASE o_orderkey % 5 WHEN 0 THEN 'SystemExit' "
                       "WHEN 1 THEN 'KeyboardInterrupt' ELSE 'OSError' END END",
    "raised_message": "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE concat('failed for order ', o_orderkey) END",
    "args": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('[', o_orderkey, ',{\"password\":\"x', o_custkey, "
            "'\",\"n\":1}]') END",
    "kwargs": "concat('{\"order\":', o_orderkey, ',\"api_key\":\"k', o_custkey, '\",\"nested\":{\"Cookie\":1,\"ok\":true}}')",
    "in_thread": "o_orderkey % 2 = 0",
    "trace_id": "md5(concat('t', o_orderkey))",
})
SPAN_MARKS = Projection("events", {
    "context_id": "concat('ctx', user_id)",
    "trace_id": ("md5(concat(user_id, '-', CAST(floor(dayofmonth(ts) / 7) AS INT)))",
                 "md5(concat(user_id, '-', CAST(floor(day(ts) / 7) AS INT)))"),
    "span_id": "substring(md5(concat('span', event_id)), 1, 16)",
    "event_id": "event_id",
    "start_ms": ms("ts"),
    "start_seq": "event_id * 2",
    "finish_ms": (
        "CASE WHEN event_id % 41 = 0 THEN NULL ELSE unix_millis(CAST(ts AS timestamp)) + CAST(floor(value * 400000) AS BIGINT) END",
        "CASE WHEN event_id % 41 = 0 THEN NULL ELSE (epoch_us(ts) // 1000) + CAST(floor(value * 400000) AS BIGINT) END"),
    "finish_seq": "event_id * 2 + 1",
    "inbound_parent": "CASE WHEN user_id % 2 = 0 THEN substring(md5(concat('in', user_id)), 1, 16) END",
    "status": "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'cancelled' WHEN 'view' THEN 'timeout' "
              "ELSE 'ok' END",
})
DEPLOYS = Projection("customer", {
    "deploy_id": "c_custkey",
    "release": "CASE WHEN c_custkey % 2 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN '' ELSE concat('v', c_custkey) END",
    "own_release": "CASE WHEN c_custkey % 5 = 0 THEN concat('own', c_custkey) ELSE '' END",
    "ci_sha_1": "CASE WHEN c_custkey % 7 = 0 THEN md5(concat('a', c_custkey)) ELSE '' END",
    "ci_sha_2": "CASE WHEN c_custkey % 8 = 0 THEN md5(concat('b', c_custkey)) END",
    "ci_sha_3": "CASE WHEN c_custkey % 9 = 0 THEN md5(concat('c', c_custkey)) END",
    "git_release": "CASE WHEN c_custkey % 4 = 0 THEN substring(md5(concat('g', c_custkey)), 1, 12) END",
    "commit_sha": "CASE WHEN c_custkey % 10 = 0 THEN md5(concat('d', c_custkey)) END",
    "own_commit_sha": "CASE WHEN c_custkey % 11 = 0 THEN md5(concat('e', c_custkey)) END",
    "git_commit": "CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN md5(concat('f', c_custkey)) END",
    "branch": "CASE WHEN c_custkey % 6 = 0 THEN 'main' END",
    "own_branch": "CAST(NULL AS STRING)",
    "git_branch": "CASE WHEN c_custkey % 5 = 0 THEN concat('feature-', c_custkey) END",
    "ci_ref_1": "CASE WHEN c_custkey % 7 = 0 THEN 'ref' END",
    "ci_ref_2": "CASE WHEN c_custkey % 8 = 0 THEN 'rail' END",
    "environment": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'staging' ELSE '' END",
    "own_environment": "CASE WHEN c_custkey % 13 = 0 THEN 'canary' END",
    "app_env": "CASE WHEN c_custkey % 2 = 0 THEN 'dev' END",
})
FLAGS = Projection("orders", {
    "order_key": "o_orderkey",
    "user_id": "o_custkey",
    "flag_key": "concat('flag-', lower(o_orderstatus))",
    "enabled": "o_orderkey % 3 <> 0",
    "value": "CASE o_orderkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'yes' WHEN 2 THEN CAST(o_orderkey AS STRING) "
             "WHEN 3 THEN '2.5' WHEN 4 THEN 'blue' ELSE '1' END",
})
