"""Raw operational logs to telemetry: requests, calls, statements, log records, task runs, crashes and cron runs.

Each job reads one log once and marks its rows; the typed tables are projections of the marked rows, so Catalyst
prunes and pushes what a projection does not need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import records as rec
from beaconry.operators.normalize import normalize_db


def _span_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("-", *parts)), 1, 16)


def _tags(**named: Column) -> Column:
    """A tag map; double underscores stand for dots."""
    flat = [item for name, value in named.items() for item in (F.lit(name.replace("__", ".")), value)]
    return F.create_map(*flat)


# ---- requests served ----

def asgi_requests(access: DataFrame, style: str = "url", failed_codes: list[int] | None = None,
                  methods: list[str] | None = None) -> DataFrame:
    """Reads event_id, ts_ms, method, path, route, endpoint, host, status (null: none sent), raised, duration_ms,
    request_size, response_size, trace_id, request_id, parent_span_id, user_agent.

    Adds status_code, transaction, failed, span_id. Methods that are not captured (OPTIONS, HEAD) leave no rows.
    """
    captured = methods or fixed.CAPTURED_METHODS
    method = F.upper(F.coalesce(F.col("method"), F.lit("GET")))
    raised = F.col("raised").isNotNull()
    status = F.coalesce(F.nullif("status", F.lit(0)), F.when(raised, 500), F.lit(0)).cast("int")
    return (
        access.withColumn("method", method)
        .where(F.col("method").isin([m.upper() for m in captured]))
        .withColumn("path", F.coalesce(rec.non_empty(F.col("path")), F.lit("/")))
        .withColumn("status_code", status)
        .withColumn("transaction", rec.asgi_transaction(F.col("route"), F.col("endpoint"), style))
        .withColumn("failed", rec.is_failed_request(F.col("status_code"), raised, failed_codes))
        .withColumn("span_id", _span_id(F.lit("asgi"), F.col("event_id")))
        .withColumn("framework", F.lit("fastapi"))
    )


def django_requests(access: DataFrame, style: str = "route") -> DataFrame:
    """Like asgi_requests; also reads module, view. Only raised exceptions that are no 4xx become errors."""
    raised = F.col("raised").isNotNull()
    return (
        access.withColumn("method", F.coalesce(rec.non_empty(F.col("method")), F.lit("GET")))
        .withColumn("status_code", F.coalesce("status", F.lit(500)).cast("int"))
        .withColumn("transaction", rec.django_transaction(
            F.col("route"), F.col("path"), F.col("module"), F.col("view"), style))
        .withColumn("failed", (F.col("status_code") >= 500) | raised)
        .withColumn("is_error_event", raised & ~F.coalesce(
            F.col("raised").isin(fixed.FRAMEWORK_4XX + fixed.INTERPRETER_EXITS), F.lit(False)))
        .withColumn("span_id", _span_id(F.lit("django"), F.col("event_id")))
        .withColumn("framework", F.lit("django"))
    )


def flask_requests(access: DataFrame) -> DataFrame:
    """Like asgi_requests, with the raw path as route; an exception at teardown is an error event."""
    raised = F.col("raised").isNotNull()
    return (
        access.withColumn("status_code", F.coalesce("status", F.lit(0)).cast("int"))
        .withColumn("transaction", F.col("path"))
        .withColumn("failed", F.col("status_code") >= 500)
        .withColumn("is_error_event", raised)
        .withColumn("span_id", _span_id(F.lit("flask"), F.col("event_id")))
        .withColumn("framework", F.lit("flask"))
    )


def _request_fields() -> list[Column]:
    fingerprint = F.when(F.col("framework") == "django", F.col("raised"))
    return [
        F.col("event_id"), F.col("ts_ms"), F.col("trace_id"), F.col("request_id"), F.col("span_id"), F.lit("inbound").alias("direction"),
        F.upper("method").alias("method"), F.col("host"), rec.strip_query(F.col("path")).alias("path"), F.col("status_code"),
        F.greatest("duration_ms", F.lit(0)).alias("duration_ms"), F.col("request_size"), F.col("response_size"), fingerprint.alias("error_fingerprint")]


def _span_fields() -> list[Column]:
    status = F.col("status_code").cast("string")
    named = {"http__method": F.col("method"), "http__route": F.col("transaction"), "http__status_code": status}
    tags = F.when(F.col("framework") == "fastapi", _tags(**named, transaction=F.col("transaction"))).otherwise(
        _tags(**named))
    return [
        F.col("event_id"), F.col("trace_id"), F.col("span_id"), F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"),
        F.lit("http.server").alias("operation"),
        F.concat_ws(" ", "method", rec.strip_query(F.col("path"))).alias("description"),
        F.when(F.col("failed"), "error").otherwise("ok").alias("status"),
        F.col("ts_ms").alias("start_ms"), (F.col("ts_ms") + F.col("duration_ms")).alias("end_ms"), F.col("duration_ms"),
        tags.alias("tags")]


def request_rows(requests: DataFrame) -> DataFrame:
    """The http_requests rows of any of the three jobs."""
    return requests.select(*_request_fields())


def request_spans(requests: DataFrame) -> DataFrame:
    """The http.server spans of any of the three jobs."""
    return requests.select(*_span_fields())


def request_telemetry(requests: DataFrame) -> DataFrame:
    """All records of a request side by side, in one pass: event_id and the structs request, span and error (null if none).

    For django_requests and flask_requests; the fields are those of request_rows, request_spans and framework_errors.
    """
    error = F.when(F.col("is_error_event"), F.struct(*_error_fields()))
    return requests.select("event_id", F.struct(*_request_fields()).alias("request"), F.struct(*_span_fields()).alias("span"), error.alias("error"))


def asgi_errors(requests: DataFrame) -> DataFrame:
    """Error events of asgi_requests: the exception, or HTTPServerError for a 5xx response without one."""
    raised = F.col("raised").isNotNull()
    responded = F.concat(F.col("method"), F.lit(" "), F.col("transaction"), F.lit(" responded with "),
                         F.col("status_code").cast("string"))
    context = F.when(raised, F.struct(
        "method", F.col("transaction").alias("path"), "host", "status_code", "user_agent"))
    mechanism = F.when(raised, F.struct(F.lit("fastapi").alias("type"), F.lit(None).cast("string").alias("name"),
                                        F.lit(True).alias("handled")))
    return requests.where("failed").select(
        "event_id", "ts_ms", "trace_id", "request_id",
        F.coalesce("raised", F.lit("HTTPServerError")).alias("exception_class"),
        F.when(raised, F.coalesce(rec.non_empty(F.col("raised_message")), F.col("raised"))).otherwise(responded)
        .alias("message"),
        F.lit("error").alias("level"), context.alias("request_context"),
        _tags(http__method=F.col("method"), http__path=F.col("path"), http__route=F.col("transaction"),
              http__host=F.col("host"), http__status=F.col("status_code").cast("string"),
              traceId=F.col("trace_id"), requestId=F.col("request_id")).alias("metadata"),
        mechanism.alias("mechanism"), F.lit(None).cast("boolean").alias("handled"))


def _error_fields() -> list[Column]:
    is_django = F.col("framework") == "django"
    mechanism = F.when(is_django, F.struct(
        F.lit("django").alias("type"), F.lit(None).cast("string").alias("name"), F.lit(False).alias("handled")))
    return [
        F.col("event_id"), F.col("ts_ms"), F.col("trace_id"), F.col("request_id"), F.col("raised").alias("exception_class"),
        F.coalesce(rec.non_empty(F.col("raised_message")), F.col("raised")).alias("message"),
        F.lit("error").alias("level"),
        F.struct("method", "path", "host", F.when(is_django, F.lit(500)).alias("status_code"), "user_agent")
        .alias("request_context"),
        mechanism.alias("mechanism"), F.lit(None).cast("boolean").alias("handled")]


def framework_errors(requests: DataFrame) -> DataFrame:
    """Error events of django_requests (unhandled) and flask_requests (no mechanism)."""
    return requests.where("is_error_event").select(*_error_fields())


# ---- requests made ----

def outbound_requests(calls: DataFrame, ingest_host: str) -> DataFrame:
    """Reads call_id, ts_ms, method, url, status, raised, raised_message, duration_ms, trace_id.

    Calls to the telemetry backend itself are left out.
    """
    return (
        calls.where(~F.col("url").startswith(ingest_host))
        .withColumn("method", F.upper(F.coalesce("method", F.lit("GET"))))
        .withColumn("path", rec.url_path(F.col("url")))
        .withColumn("span_id", _span_id(F.lit("call"), F.col("call_id")))
    )


def outbound_rows(calls: DataFrame) -> DataFrame:
    """http_requests rows; a call that raised leaves none. Durations are clamped, as those of requests received are."""
    host = F.regexp_extract("url", r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)
    return calls.where(F.col("raised").isNull()).select(
        "call_id", "ts_ms", "trace_id", "span_id", F.lit("outbound").alias("direction"), "method",
        host.alias("host"), "path", F.coalesce("status", F.lit(0)).alias("status_code"),
        F.greatest(F.lit(0), F.col("duration_ms")).alias("duration_ms"))


def outbound_spans(calls: DataFrame) -> DataFrame:
    raised = F.col("raised").isNotNull()
    return calls.select(
        "call_id", "trace_id", "span_id", F.lit("http.client").alias("operation"),
        F.concat_ws(" ", "method", "path").alias("description"),
        F.when(raised | (F.col("status") >= 500), "error").otherwise("ok").alias("status"),
        F.col("ts_ms").alias("start_ms"), (F.col("ts_ms") + F.col("duration_ms")).alias("end_ms"), "duration_ms",
        F.when(raised, _tags(http__method=F.col("method"), http__url=F.col("url"))).otherwise(
            _tags(http__method=F.col("method"), http__url=F.col("url"),
                  http__status_code=F.coalesce(F.col("status"), F.lit(0)).cast("string"))).alias("tags"))


def outbound_crumbs(calls: DataFrame) -> DataFrame:
    url = F.substring_index("url", "?", 1)
    raised = F.col("raised").isNotNull()
    common = {"method": F.col("method"), "url": url}
    duration = F.col("duration_ms").cast("string")
    return calls.select(
        "call_id", "ts_ms", F.lit("http").alias("type"),
        rec.http_crumb_message(F.col("method"), F.col("url"), F.col("status"), F.col("raised")).alias("message"),
        rec.http_crumb_level(F.col("status"), F.col("raised")).alias("level"),
        F.when(raised, _tags(**common, error=F.coalesce("raised_message", F.lit("")), durationMs=duration)).otherwise(
            _tags(**common, statusCode=F.col("status").cast("string"), durationMs=duration)).alias("data"))


# ---- statements ----

def db_statements(executed: DataFrame) -> DataFrame:
    """Executed statements as db_queries rows; see normalize_db. Also reads statement_id, ts_ms, database_type,
    database_name."""
    return normalize_db(executed)


def statement_spans(queries: DataFrame, description_chars: int | None = None) -> DataFrame:
    """``description_chars`` cuts the statement, which the contract's clients do at ``fixed.SPAN_DESCRIPTION_CHARS``."""
    statement = F.col("normalized_query")
    return queries.select(
        "statement_id", "trace_id", "span_id", F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"),
        F.lit("db.query").alias("operation"),
        (statement if description_chars is None else F.substring(statement, 1, description_chars)).alias("description"),
        F.when(F.col("status") == "error", "error").otherwise("ok").alias("status"),
        F.col("ts_ms").alias("start_ms"), (F.col("ts_ms") + F.col("duration_ms")).alias("end_ms"), "duration_ms",
        _tags(db__system=F.col("database_type"), db__operation=F.col("query_type"), db__name=F.col("database_name"))
        .alias("tags"))


# ---- log records ----

def log_records(records: DataFrame, own_logger: str, event_level: int = 40, crumb_level: int = 20) -> DataFrame:
    """Reads record_id, ts_ms, logger, module, levelno, levelname, message, exception_class, captured,
    request_id_1..3, trace_id, span_id. Adds becomes (error or crumb), level and request_id.

    Records of the SDK's own loggers and of exceptions already captured leave nothing.
    """
    control_flow = F.coalesce(F.col("exception_class").isin(fixed.FRAMEWORK_4XX), F.lit(False))
    is_event = F.col("levelno") >= event_level
    becomes = F.when(is_event & ~control_flow, "error").when(F.col("levelno") >= crumb_level, "crumb")
    return (
        records.where(~F.col("logger").startswith(own_logger) & ~F.coalesce(F.col("captured"), F.lit(False)))
        .withColumn("becomes", becomes).where(F.col("becomes").isNotNull())
        .withColumn("level", F.when(F.col("becomes") == "error", rec.event_level_of(F.col("levelno")))
                    .otherwise(rec.crumb_level_of(F.col("levelno"))))
        .withColumn("request_id", rec.first_non_empty(*[F.col(f"request_id_{i}") for i in (1, 2, 3)]))
    )


def log_errors(records: DataFrame) -> DataFrame:
    """Error events of log_records: the exception, else an error whose class is the logger."""
    has_exception = F.col("exception_class").isNotNull()
    return records.where(F.col("becomes") == "error").select(
        "record_id", "ts_ms", F.coalesce("exception_class", "logger").alias("exception_class"), "message", "level",
        F.map_filter(_tags(logger=F.col("logger"), module=F.col("module"), level=F.col("levelname"),
                           traceId=F.col("trace_id"), spanId=F.col("span_id"), requestId=F.col("request_id")),
                     lambda _, v: v.isNotNull()).alias("metadata"),
        F.when(has_exception, "logging").alias("mechanism"), F.when(has_exception, F.lit(True)).alias("handled"))


def log_crumbs(records: DataFrame) -> DataFrame:
    return records.where(F.col("becomes") == "crumb").select(
        "record_id", "ts_ms", F.lit("log").alias("type"), "message", "level",
        F.map_filter(_tags(logger=F.col("logger"), module=F.col("module"), requestId=F.col("request_id")),
                     lambda _, v: v.isNotNull()).alias("data"))


def warn_log_crumbs(logs: DataFrame) -> DataFrame:
    """The crumb every log call at warn, error or fatal leaves. Reads log_id, ts_ms, level, message, service."""
    return logs.where(F.col("level").isin("warn", "error", "fatal")).select(
        "log_id", "ts_ms", F.lit("log").alias("type"), "message",
        F.when(F.col("level") == "warn", "warn").otherwise("error").alias("level"),
        F.map_filter(_tags(logLevel=F.col("level"), service=rec.non_empty(F.col("service"))),
                     lambda _, v: v.isNotNull()).alias("data"))


# ---- jobs ----

def _task_name() -> Column:
    return F.coalesce(rec.non_empty(F.col("task")), F.lit("celery.task"))


def _task_span_fields() -> list[Column]:
    return [
        F.col("task_id"), F.col("trace_id"), _span_id(F.lit("task"), F.col("task_id")).alias("span_id"),
        F.lit("celery.task").alias("operation"), _task_name().alias("description"),
        F.when(F.col("state") == "FAILURE", "error").otherwise("ok").alias("status"),
        F.col("ts_ms").alias("start_ms"), (F.col("ts_ms") + F.col("duration_ms")).alias("end_ms"), F.col("duration_ms"),
        _tags(celery__task=_task_name(), celery__task_id=F.coalesce("task_id", F.lit("")),
              celery__state=F.coalesce("state", F.lit(""))).alias("tags")]


def _task_crumb_fields() -> list[Column]:
    return [
        F.col("task_id"), F.col("ts_ms"), F.lit("task").alias("type"), F.concat(F.lit("celery task started: "), _task_name()).alias("message"),
        F.lit("info").alias("level"), _tags(task=_task_name(), taskId=F.coalesce("task_id", F.lit(""))).alias("data")]


def task_spans(runs: DataFrame) -> DataFrame:
    """Reads task_id, task, ts_ms, duration_ms, state, trace_id."""
    return runs.select(*_task_span_fields())


def task_crumbs(runs: DataFrame) -> DataFrame:
    return runs.select(*_task_crumb_fields())


def task_telemetry(runs: DataFrame) -> DataFrame:
    """Span and breadcrumb of every run side by side, in one pass: task_id and the structs span and crumb."""
    return runs.select("task_id", F.struct(*_task_span_fields()).alias("span"), F.struct(*_task_crumb_fields()).alias("crumb"))


def task_errors(runs: DataFrame) -> DataFrame:
    """Reads exception_class, raised_message, args, kwargs (already scrubbed JSON text; see scrub_task_args)."""
    name = F.coalesce(rec.non_empty(F.col("task")), F.lit("celery.task"))
    return runs.where(F.col("exception_class").isNotNull()).select(
        "task_id", "ts_ms", "exception_class",
        F.coalesce(rec.non_empty(F.col("raised_message")), F.col("exception_class")).alias("message"),
        F.map_filter(_tags(celery__task=name, celery__task_id=F.coalesce("task_id", F.lit("")),
                           celery__args=F.col("args"), celery__kwargs=F.col("kwargs")),
                     lambda _, v: v.isNotNull()).alias("metadata"),
        F.lit("celery").alias("mechanism"), F.lit(False).alias("handled"))


def uncaught_exceptions(crashes: DataFrame) -> DataFrame:
    """Reads crash_id, ts_ms, exception_class, message, in_thread. Interpreter exits are no crashes."""
    return crashes.where(
        F.col("exception_class").isNotNull() & ~F.col("exception_class").isin(fixed.INTERPRETER_EXITS)
    ).select(
        "crash_id", "ts_ms", "exception_class", "message", F.lit("error").alias("level"),
        F.when(F.col("in_thread"), "threading_excepthook").otherwise("excepthook").alias("mechanism"),
        F.lit(False).alias("handled"))


def cron_runs(runs: DataFrame) -> DataFrame:
    """Reads slug, start_ms, end_ms, exception_message (null: went well), success_message."""
    failed = F.col("exception_message").isNotNull()
    return runs.select(
        "run_id", "slug", F.when(failed, "failed").otherwise("success").alias("status"),
        (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"),
        F.when(failed, F.col("exception_message")).otherwise(F.col("success_message")).alias("message"))
