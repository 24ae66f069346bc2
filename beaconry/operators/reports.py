"""Read-side questions about the telemetry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from beaconry.functions import records as rec
from beaconry.operators.hot_keys import newest


def trace_summary(spans: DataFrame) -> DataFrame:
    """Per trace: root operation, spans, failed spans, wall time and time no child accounts for.

    Reads trace_id, span_id, parent_span_id, operation, status, start_ms, end_ms, duration_ms.
    """
    children = spans.where(F.col("parent_span_id") != "").groupBy(
        "trace_id", F.col("parent_span_id").alias("span_id")).agg(F.sum("duration_ms").alias("_children_ms"))
    self_ms = F.greatest(F.col("duration_ms") - F.coalesce("_children_ms", F.lit(0)), F.lit(0))
    numbers = spans.select("trace_id", "span_id", "status", "start_ms", "end_ms", "duration_ms").join(
        children, ["trace_id", "span_id"], "left").groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"),
        F.count_if(F.col("status") == "error").alias("error_spans"),
        (F.max("end_ms") - F.min("start_ms")).alias("wall_ms"),
        F.sum(self_ms).alias("self_ms"))
    # names apart from numbers: an aggregate with text in it must sort, and only the rows of roots have to
    roots = spans.where(F.col("parent_span_id") == "").groupBy("trace_id").agg(
        F.min(F.struct("start_ms", "span_id", "operation"))["operation"].alias("root_operation"))
    return numbers.join(roots, "trace_id", "left").select("trace_id", "root_operation", "spans", "error_spans", "wall_ms", "self_ms")


def trace_linked(errors: DataFrame, spans: DataFrame, logs: DataFrame, requests: DataFrame,
                 queries: DataFrame) -> DataFrame:
    """Every error with how many spans, logs, requests and statements share its trace.

    All tables have trace_id. Of the others only rows of the errors' traces are counted, all in one aggregate per
    trace, before they meet the errors: a task then sorts rows for one join, however many tables there are.
    """
    others = {"spans": spans, "logs": logs, "requests": requests, "queries": queries}
    wanted = errors.select("trace_id").distinct()
    rows = None
    for name, table in others.items():
        some = table.select("trace_id", F.lit(name).alias("_table"))
        rows = some if rows is None else rows.unionByName(some)
    counted = rows.join(wanted, "trace_id", "left_semi").groupBy("trace_id").agg(
        *[F.count_if(F.col("_table") == name).alias(f"linked_{name}") for name in others])
    return errors.join(counted, "trace_id", "left").withColumns(
        {f"linked_{name}": F.coalesce(f"linked_{name}", F.lit(0)) for name in others})


def orphan_spans(spans: DataFrame) -> DataFrame:
    """Spans that name a parent their trace does not have.

    Ids in either role, a span's or a parent's, are folded to one row before they shuffle, once; only the lost parents then
    meet the spans again. Spans without a trace have no parent there.
    """
    own = F.struct(F.col("span_id").alias("_id"), F.col("trace_id").isNotNull().alias("_known"))
    named = F.struct(F.col("parent_span_id").alias("_id"), F.lit(False).alias("_known"))
    both = F.when(F.col("parent_span_id") != "", F.array(own, named)).otherwise(F.array(own))
    lost = (spans.select(F.col("trace_id").alias("_trace"), F.inline(both)).groupBy("_trace", "_id").agg(F.max("_known").alias("_known"))
            .where("NOT _known").select("_trace", "_id"))
    return spans.where(F.col("parent_span_id") != "").join(
        lost, F.col("trace_id").eqNullSafe(F.col("_trace")) & (F.col("parent_span_id") == F.col("_id")), "left_semi")


def errors_without_trace(errors: DataFrame, spans: DataFrame) -> DataFrame:
    return errors.join(spans.select("trace_id").distinct(), "trace_id", "left_anti")  # distinct: a hot trace is one row here


def requests_with_errors(requests: DataFrame, errors: DataFrame) -> DataFrame:
    return requests.join(errors.select("request_id").distinct(), "request_id", "left_semi")


def _percentile(p: float, exact: bool) -> Column:
    """Of duration_ms, over rows that each stand for ``_calls`` calls."""
    if exact:
        return F.percentile("duration_ms", F.lit(p), F.col("_calls"))
    return F.percentile_approx(F.col("duration_ms"), F.lit(p), F.lit(10000))


def _by_duration(df: DataFrame, keys: list[str], sums: dict[str, Column], exact: bool) -> DataFrame:
    """Fold to one row per key and whole millisecond before percentiles are taken.

    A key with a third of all calls then brings as many rows as it has distinct durations, and the shuffle carries
    those. ``exact=False`` takes the approximate percentile of the calls themselves.
    """
    if not exact:
        return df.select(*keys, "duration_ms", F.lit(1).cast("bigint").alias("_calls"),
                         *[c.alias(n) for n, c in sums.items()])
    return df.groupBy(*keys, "duration_ms").agg(
        F.count(F.lit(1)).alias("_calls"), *[F.sum(c).alias(n) for n, c in sums.items()])


def query_stats(queries: DataFrame, exact: bool = True) -> DataFrame:
    """Per statement: calls, errors, mean, p50, p95 and rows."""
    folded = _by_duration(queries, ["query_hash", "normalized_query"], {
        "_errors": (F.col("status") == "error").cast("bigint"),
        "_rows": F.greatest("rows_affected", F.lit(0)).cast("bigint")}, exact)
    return folded.groupBy("query_hash", "normalized_query").agg(
        F.sum("_calls").alias("calls"),
        F.sum("_errors").alias("errors"),
        (F.sum(F.col("duration_ms") * F.col("_calls")) / F.sum("_calls")).alias("mean_ms"),
        _percentile(0.5, exact).alias("p50_ms"),
        _percentile(0.95, exact).alias("p95_ms"),
        F.sum("_rows").alias("rows"))


def endpoint_stats(requests: DataFrame, counts: dict[str, Column] | None = None, exact: bool = True) -> DataFrame:
    """Per method and route: calls, share of 5xx, p95, bytes and how many requests meet each of ``counts``."""
    counts = {name: condition.cast("bigint") for name, condition in (counts or {}).items()}
    folded = _by_duration(requests, ["method", "route"], {
        "_failed": (F.col("status_code") >= 500).cast("bigint"), "bytes": F.col("response_size"), **counts}, exact)
    return folded.groupBy("method", "route").agg(
        F.sum("_calls").alias("calls"),
        (F.sum("_failed") / F.sum("_calls")).alias("failed_share"),
        _percentile(0.95, exact).alias("p95_ms"),
        F.sum("bytes").alias("bytes"),
        *[F.sum(name).alias(name) for name in counts])


def endpoint_totals(requests: DataFrame) -> DataFrame:
    """Calls and 5xx per service and route, with totals per service and over all."""
    return requests.rollup("service", "route").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status_code") >= 500).alias("failed"))


def release_health(sessions: DataFrame, exact: bool = True) -> DataFrame:
    """Per release: sessions, crash-free share of sessions and of users. Reads release, status, user_id.

    The exact form folds to one row per release and user first, so users are counted without a set per release.
    """
    crashed = F.col("status") == "crashed"
    if not exact:
        return sessions.groupBy("release").agg(
            F.count(F.lit(1)).alias("sessions"), (1 - F.avg(crashed.cast("double"))).alias("crash_free_sessions"),
            (1 - F.approx_count_distinct(F.when(crashed, F.col("user_id"))) / F.approx_count_distinct("user_id"))
            .alias("crash_free_users"))
    users = sessions.groupBy("release", "user_id").agg(
        F.count(F.lit(1)).alias("_sessions"), F.sum(crashed.cast("bigint")).alias("_crashed"))
    named = F.col("user_id").isNotNull()
    return users.groupBy("release").agg(
        F.sum("_sessions").alias("sessions"),
        (1 - F.sum("_crashed") / F.sum("_sessions")).alias("crash_free_sessions"),
        F.count_if(named).alias("users"),
        (1 - F.count_if(named & (F.col("_crashed") > 0)) / F.nullif(F.count_if(named), F.lit(0)))
        .alias("crash_free_users"))


def error_groups(errors: DataFrame, release_order: str = "ts_ms") -> DataFrame:
    """Per fingerprint (class and top frame): events, users, first and last seen, and the release it came in with.

    Reads exception_class, top_frame, user_id, ts_ms, event_id, release. Users are folded before they are counted.
    """
    keys = ["exception_class", "top_frame"]
    users = errors.groupBy(*keys, "user_id").agg(
        F.count(F.lit(1)).alias("_events"), F.min(release_order).alias("_first"), F.max(release_order).alias("_last"),
        F.min(F.struct(release_order, "event_id", "release")).alias("_came"))
    return users.groupBy(*keys).agg(
        F.sum("_events").alias("events"), F.count_if(F.col("user_id").isNotNull()).alias("users"),
        F.min("_first").alias("first_seen_ms"), F.max("_last").alias("last_seen_ms"),
        F.min("_came")["release"].alias("new_in_release"))


def error_group_releases(errors: DataFrame) -> DataFrame:
    """Per fingerprint and release: events, and the release of the group before it (null: new with this one)."""
    keys = ["exception_class", "top_frame"]
    per_release = errors.groupBy(*keys, "release").agg(
        F.count(F.lit(1)).alias("events"), F.min("ts_ms").alias("first_ms"))
    in_order = Window.partitionBy(*keys).orderBy("first_ms", "release")
    return per_release.withColumn("previous_release", F.lag("release").over(in_order))


def cron_status(heartbeats: DataFrame, monitors: DataFrame) -> DataFrame:
    """Per known slug its latest heartbeat and the failures in a row; heartbeats of unknown slugs show as such.

    Reads heartbeats: slug, ts_ms, run_id, status; monitors: slug. A streak is counted from the last success.
    """
    order = F.struct("ts_ms", "run_id")
    ok = F.col("status") == "success"
    # the last success is found first, then the failures after it are counted: two aggregates, no window
    last_ok = heartbeats.groupBy("slug").agg(F.max(F.when(ok, order)).alias("_last_ok"))
    streaks = (
        heartbeats.join(last_ok, "slug")
        .groupBy("slug").agg(
            F.max_by("status", order).alias("latest_status"), F.max("ts_ms").alias("latest_ms"),
            F.count_if(~ok & (F.col("_last_ok").isNull() | (order > F.col("_last_ok")))).alias("failure_streak")))
    named = monitors.select("slug", F.lit(True).alias("known"))
    return streaks.join(named, "slug", "full").withColumn("known", F.coalesce("known", F.lit(False)))


def slowest_spans(spans: DataFrame, k: int) -> DataFrame:
    """The ``k`` slowest spans per operation."""
    return newest(spans, ["operation"], ["duration_ms", "trace_id", "span_id"], k)


def n_plus_one(queries: DataFrame, k: int) -> DataFrame:
    """Statements that ran at least ``k`` times below one parent span."""
    return queries.groupBy("trace_id", "parent_span_id", "query_hash").agg(
        F.count(F.lit(1)).alias("calls"), F.sum("duration_ms").alias("total_ms")).where(F.col("calls") >= k)


def flag_lookup(users: DataFrame, flags: DataFrame, default: str = "") -> DataFrame:
    """Users with a flag's value, typed; a user without one gets the default, not enabled. Reads user_id, flag_key."""
    value = F.coalesce("value", F.lit(default))
    return users.join(flags, ["user_id", "flag_key"], "left").select(
        "user_id", "flag_key", F.coalesce("enabled", F.lit(False)).alias("enabled"), value.alias("value"),
        rec.flag_as_bool(value).alias("as_bool"), rec.flag_as_int(value).alias("as_int"),
        rec.flag_as_float(value).alias("as_float"))


def telemetry_timeline(tables: dict[str, DataFrame]) -> DataFrame:
    """All kinds together with their kind, each bringing the columns it has; sort or filter by trace_id and ts_ms."""
    out = None
    for kind, table in tables.items():
        tagged = table.withColumn("kind", F.lit(kind))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def statement_catalog(statements: DataFrame) -> DataFrame:
    """Every distinct statement shape of a log. Reads statement."""
    normalized = rec.normalize_query(F.col("statement"))
    return statements.select(normalized.alias("normalized_query")).groupBy("normalized_query").agg(
        F.count(F.lit(1)).alias("statements")).select(
        rec.hash_query(F.col("normalized_query")).alias("query_hash"),
        rec.detect_query_type(F.col("normalized_query")).alias("query_type"), "normalized_query", "statements")
