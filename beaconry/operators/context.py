"""What surrounds an error: breadcrumbs, the user, and the reports that already told of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry import fixed_values as fixed
from beaconry.operators import hot_keys
from beaconry.operators.hot_keys import SLOT_ROWS, newest


def crumb_owners(marks: DataFrame, limit: int = fixed.MAX_BREADCRUMBS, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Every breadcrumb an error takes with it, one row each.

    Reads marks: process_id, ts_ms, event_id, is_error and any crumb columns. A crumb belongs to the next error of
    its process; an error takes the newest ``limit`` of its crumbs and leaves none for later errors.
    """
    order = ["ts_ms", "event_id"]
    owned = hot_keys.next_known(marks, ["process_id"], order,
                                F.when(F.col("is_error"), F.col("event_id")), "error_id", slot_rows)
    crumbs = owned.where(~F.col("is_error") & F.col("error_id").isNotNull())
    return newest(crumbs, ["process_id", "error_id"], order, limit)


def attach_breadcrumbs(marks: DataFrame, crumb: Column, limit: int = fixed.MAX_BREADCRUMBS,
                       slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Per error that has any, its breadcrumbs oldest first as an array of ``crumb``; never longer than ``limit``."""
    owners = crumb_owners(marks, limit, slot_rows)
    listed = F.sort_array(F.collect_list(F.struct("ts_ms", "event_id", crumb.alias("crumb"))))
    return owners.groupBy("process_id", "error_id").agg(
        F.transform(listed, lambda item: item["crumb"]).alias("breadcrumbs"))


def user_at_error(marks: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Reads process_id, ts_ms, event_id, kind (set_user, clear_user, error), user_id, explicit_user_id.

    An error's user is the explicit one, else the one set last before it; clearing leaves none.
    """
    state = F.when(F.col("kind") == "set_user", F.struct(F.col("user_id").alias("id"))).when(
        F.col("kind") == "clear_user", F.struct(F.lit(None).cast("string").alias("id")))
    known = hot_keys.last_known(marks, ["process_id"], ["ts_ms", "event_id"], state, "_user", slot_rows)
    return known.where(F.col("kind") == "error").withColumn(
        "error_user_id", F.coalesce(F.col("explicit_user_id"), F.col("_user.id"))).drop("_user")


def dedupe_captured(from_requests: DataFrame, from_logs: DataFrame) -> DataFrame:
    """Errors of both origins, each exception of a request once.

    Both sides have request_id, exception_id, event_id. A request reports one exception; a log record about an
    exception that its request reported is left out, any other log record stays.
    """
    once = from_requests.groupBy("request_id").agg(
        F.min_by(F.struct("event_id", "exception_id"), "event_id").alias("_first"))
    reported = once.select("request_id", F.col("_first.exception_id").alias("exception_id"),
                           F.col("_first.event_id").alias("event_id"))
    fresh = from_logs.join(reported.select("request_id", "exception_id"), ["request_id", "exception_id"], "left_anti")
    columns = ["event_id", "request_id", "exception_id", "origin"]
    return reported.withColumn("origin", F.lit("request")).select(columns).unionByName(
        fresh.withColumn("origin", F.lit("log")).select(columns))


def dedupe_crumbs(crumbs: DataFrame) -> DataFrame:
    """Reads record_id, source (bridge or handler), level, message: one crumb a record, the bridge's first."""
    first = F.min_by(F.struct("source", "level", "message"), F.when(F.col("source") == "bridge", 0).otherwise(1))
    return crumbs.groupBy("record_id").agg(first.alias("_crumb")).select("record_id", "_crumb.*")


def route_errors(candidates: DataFrame, event_level: int = 40, crumb_level: int = 20) -> DataFrame:
    """Reads origin (request or log), exception_class, status_code, levelno; adds ``becomes``: error, crumb or null.

    Exceptions a framework answers with 4xx are control flow: never errors, and as log records only crumbs.
    """
    control_flow = F.coalesce(F.col("exception_class").isin(fixed.FRAMEWORK_4XX), F.lit(False))
    client_error = F.coalesce(F.col("status_code").between(400, 499), F.lit(False))
    from_log = F.when((F.col("levelno") >= event_level) & ~control_flow, "error").when(
        F.col("levelno") >= crumb_level, "crumb")
    from_request = F.when(F.col("exception_class").isNotNull() & ~control_flow & ~client_error, "error")
    return candidates.withColumn("becomes", F.when(F.col("origin") == "log", from_log).otherwise(from_request))
