"""Per-kind validation and normalization.

Validators add a ``rejected`` column: null for a valid row, else the reason. Split on it, so that one scan feeds
both outcomes; nothing is dropped silently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import records as rec


def _verdict(*checks: tuple[Column, str]) -> Column:
    """The reason of the first check that does not hold; a null check does not hold."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), reason) for ok, reason in checks])


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("rejected").isNull()).drop("rejected")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("rejected").isNotNull())


def validate_errors(df: DataFrame) -> DataFrame:
    """Reads level, exception_class, message."""
    return df.withColumn("rejected", _verdict(
        (F.col("level").isin(fixed.ERROR_LEVELS), "level"),
        (F.trim("exception_class") != "", "exception_class"),
        (F.trim("message") != "", "message")))


def validate_logs(df: DataFrame) -> DataFrame:
    """Reads level, message. ``warning`` is no log level."""
    return df.withColumn("rejected", _verdict(
        (F.col("level").isin(fixed.LOG_LEVELS), "level"), (F.col("message").isNotNull(), "message")))


def normalize_http(df: DataFrame, release: str | None = None, environment: str = "production", tags: dict[str, Column] | None = None,
                   now_ms: Column | None = None) -> DataFrame:
    """Reads event_key, direction, method, host, path, status_code, duration_ms, trace_id and, where there are, ts_ms, timestamp
    (ISO-8601 text) and metadata (a map of text).

    Durations are clamped, paths lose their query, missing trace ids become a hash of the event key. A missing timestamp is
    that of ts_ms, else of ``now_ms``, the present of the caller; there is no such column where neither is known. Release
    ``tags`` go into the metadata, where what the caller set wins; empty metadata is null.
    """
    known = [c for c in (F.col("ts_ms") if "ts_ms" in df.columns else None, now_ms) if c is not None]
    if known:
        at = F.date_format(F.timestamp_millis(F.coalesce(*known)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        own = rec.non_empty(F.col("timestamp")) if "timestamp" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("timestamp", F.coalesce(own, at))
    if tags is not None:
        if "metadata" not in df.columns:
            df = df.withColumn("metadata", F.lit(None).cast("map<string,string>"))
        df = enrich_release_tags(df, tags)
        df = df.withColumn("metadata", F.when(F.size("metadata") > 0, F.col("metadata")))
    return (
        df.withColumn("rejected", _verdict((F.col("direction").isin("inbound", "outbound"), "direction")))
        .withColumn("method", F.upper("method"))
        .withColumn("path", rec.strip_query(F.col("path")))
        .withColumn("duration_ms", F.greatest(F.lit(0), F.col("duration_ms")))
        .withColumn("trace_id", F.coalesce(rec.non_empty(F.col("trace_id")), F.md5(F.col("event_key").cast("string"))))
        .withColumn("release", F.lit(release))
        .withColumn("environment", F.lit(environment))
    )


def validate_http_items(df: DataFrame) -> DataFrame:
    """The rule for ready-made items: a negative duration is refused, not clamped."""
    return df.withColumn("rejected", _verdict(
        (F.col("direction").isin("inbound", "outbound"), "direction"), (F.col("duration_ms") >= 0, "duration_ms")))


def outbound_from_url(df: DataFrame) -> DataFrame:
    """Reads url, method, status_code, raised, duration_ms; adds host, path, error_fingerprint. A status that came before
    the exception stays."""
    return (
        df.withColumn("direction", F.lit("outbound"))
        .withColumn("method", F.upper("method"))
        .withColumn("host", rec.url_host(F.col("url")))
        .withColumn("path", rec.url_path(F.col("url")))
        .withColumn("status_code", F.coalesce("status_code", F.lit(0)))
        .withColumn("error_fingerprint", F.col("raised"))
        .withColumn("duration_ms", F.greatest(F.lit(0), F.col("duration_ms").cast("bigint")))
    )


def validate_heartbeats(df: DataFrame) -> DataFrame:
    """Reads slug, status."""
    status = F.lower("status")
    return df.withColumn("rejected", _verdict(
        (F.col("slug").rlike(fixed.SLUG_PATTERN), "slug"), (status.isin("success", "failed"), "status"))
    ).withColumn("status", status)


def normalize_breadcrumbs(df: DataFrame) -> DataFrame:
    """Reads type, level, data (a map); empty data becomes null."""
    return (
        df.withColumn("type", F.when(F.col("type").isin(fixed.CRUMB_TYPES), F.col("type")).otherwise("default"))
        .withColumn("level", F.when(F.col("level").isin(fixed.CRUMB_LEVELS), F.col("level")).otherwise("info"))
        .withColumn("data", F.when(F.size("data") > 0, F.col("data")))
    )


def normalize_spans(finishes: DataFrame, as_of_ms: Column) -> DataFrame:
    """Reads span marks: trace_id, span_id, parent_span_id, start_ms, finish_ms, status (one row per finish call).

    The first finish counts. A span without one is open and ends ``as_of_ms`` with status ok.
    """
    first = F.min_by(F.struct("finish_ms", "status"), "finish_ms")
    spans = finishes.groupBy("trace_id", "span_id").agg(
        F.first("parent_span_id", ignorenulls=True).alias("parent_span_id"), F.min("start_ms").alias("start_ms"),
        first.alias("_finish"))
    end = F.coalesce(F.col("_finish.finish_ms"), as_of_ms)
    status = F.col("_finish.status")
    return spans.select(
        "trace_id", "span_id", F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"), "start_ms",
        end.alias("end_ms"), (end - F.col("start_ms")).alias("duration_ms"),
        F.when(status.isin(fixed.SPAN_STATUSES), status).otherwise("ok").alias("status"))


def span_exit_status(status: Column, raised: Column) -> Column:
    return F.coalesce(status, F.when(raised.isNotNull(), "error").otherwise("ok"))


def normalize_db(df: DataFrame, message_chars: int | None = None) -> DataFrame:
    """``message_chars`` cuts error messages, which the contract's clients do at ``fixed.ERROR_MESSAGE_CHARS``.

    Reads statement, duration_ms, status, error_message, query_type, rows_affected, trace_id, span_id,
    parent_span_id, active_trace_id, active_span_id."""
    normalized = rec.normalize_query(F.col("statement"))
    blank = F.lit("")
    message = F.coalesce(F.col("error_message"), blank)
    return (
        df.withColumn("normalized_query", normalized)
        .withColumn("query_hash", rec.hash_query(normalized))
        .withColumn("query_type", F.coalesce(F.col("query_type"), rec.detect_query_type(normalized)))
        .withColumn("duration_ms", F.greatest(F.lit(0), F.col("duration_ms").cast("bigint")))
        .withColumn("error_message", message if message_chars is None else F.substring(message, 1, message_chars))
        .withColumn("rows_affected", F.coalesce(F.col("rows_affected"), F.lit(-1)))
        .withColumn("status", F.coalesce(F.col("status"), F.lit("success")))
        .withColumn("trace_id", F.coalesce(rec.non_empty(F.col("trace_id")), F.col("active_trace_id"), blank))
        .withColumn("span_id", F.coalesce(rec.non_empty(F.col("span_id")), F.col("active_span_id"), blank))
        .withColumn("parent_span_id", rec.non_empty(F.col("parent_span_id")))
        .drop("active_trace_id", "active_span_id")
    )


def flatten_mechanism(df: DataFrame) -> DataFrame:
    """Reads mechanism struct<type, name, handled> and handled; mechanism becomes a string, handled a top field."""
    kind = rec.first_non_empty(F.col("mechanism.type"), F.col("mechanism.name"))
    return df.withColumn("handled", F.coalesce(F.col("handled"), F.col("mechanism.handled"))).withColumn(
        "mechanism", kind)


def error_defaults(df: DataFrame, environment: str, release: str, sdk_name: str, sdk_version: str,
                   platform: str = "python") -> DataFrame:
    """Reads from_exception, environment, release, message, exception_repr. Fills what the capture left open."""
    def for_exceptions(value: str) -> Column:
        return F.when(F.col("from_exception"), F.lit(value))

    return (
        df.withColumn("environment", F.coalesce(rec.non_empty(F.col("environment")), F.lit(environment)))
        .withColumn("release", F.coalesce(rec.non_empty(F.col("release")), F.lit(release)))
        .withColumn("message", F.when(F.col("from_exception"), F.coalesce(
            rec.non_empty(F.col("message")), F.col("exception_repr"))).otherwise(F.col("message")))
        .withColumn("sdk_name", for_exceptions(sdk_name))
        .withColumn("sdk_version", for_exceptions(sdk_version))
        .withColumn("platform", for_exceptions(platform))
    )


def validate_session_states(df: DataFrame) -> DataFrame:
    """Reads version, session_id, started_at, updated_at (null when not numeric), status."""
    return df.withColumn("rejected", _verdict(
        (F.col("version") == 1, "version"), (F.col("session_id") != "", "session_id"),
        (F.col("started_at").isNotNull(), "started_at"), (F.col("updated_at").isNotNull(), "updated_at"),
        (F.col("status").isin(fixed.SESSION_STATUSES), "status")))


def enrich_release_tags(df: DataFrame, tags: dict[str, Column], metadata: str = "metadata") -> DataFrame:
    """Merge release tags into a metadata map; what the caller set wins, unset tags are left out."""
    entries = F.filter(
        F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in tags.items()]),
        lambda e: F.coalesce(e["value"] != "", F.lit(False)))
    present = F.coalesce(F.col(metadata), F.create_map().cast("map<string,string>"))
    missing = F.map_filter(F.map_from_entries(entries), lambda k, _: ~F.map_contains_key(present, k))
    return df.withColumn(metadata, F.map_concat(missing, present))


def resolve_release(df: DataFrame, sdk_version: str) -> DataFrame:
    """Reads the deploy attributes release, own_release, ci_sha_1..3, git_release, commit_sha, own_commit_sha,
    git_commit, branch, own_branch, git_branch, ci_ref_1..2, environment, own_environment, app_env."""
    c = F.col
    short = [F.substring(c(f"ci_sha_{i}"), 1, 12) for i in (1, 2, 3)]
    return df.select(
        "deploy_id",
        F.coalesce(rec.first_non_empty(c("release"), c("own_release"), *short, c("git_release")),
                   F.lit(sdk_version)).alias("release"),
        rec.first_non_empty(c("commit_sha"), c("own_commit_sha"), c("git_commit"),
                            *[c(f"ci_sha_{i}") for i in (1, 2, 3)]).alias("commit_sha"),
        rec.first_non_empty(c("branch"), c("own_branch"), c("git_branch"), c("ci_ref_1"), c("ci_ref_2"))
        .alias("branch"),
        F.coalesce(rec.first_non_empty(c("environment"), c("own_environment"), c("app_env")),
                   F.lit("production")).alias("environment"))
