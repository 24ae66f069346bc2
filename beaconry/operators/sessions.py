"""Release-health sessions folded from their marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry import fixed_values as fixed


def fold_sessions(marks: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Status, error count and duration per session, and the least value of each column that ``carry`` names.

    Reads session_id, ts_ms, event_id, mark (start, error, crash, abnormal, end), final_status. Marks after the first
    end are ignored. Crash beats abnormal beats error, whatever their order, so one aggregate does it; the explicit
    final status of the end beats all. A session without an end lasts until its latest mark.
    """
    order = F.struct("ts_ms", "event_id")
    is_end = F.col("mark") == "end"
    ends = marks.where(is_end).groupBy("session_id").agg(
        F.min(order).alias("_end"), F.min_by("final_status", order).alias("_final"))
    counted = marks.join(ends, "session_id", "left").where(F.col("_end").isNull() | (order <= F.col("_end")))
    severity = (F.when(F.col("mark") == "crash", 3).when(F.col("mark") == "abnormal", 2)
                .when(F.col("mark") == "error", 1).otherwise(0))
    # the end is one per session, so it can be a grouping key; what is left to fold is plain numbers
    # and so can what is carried: a session has few values of it, which are folded once the marks are
    once = ["session_id", "ended_ms", "_final"]
    folded = counted.groupBy("session_id", F.col("_end.ts_ms").alias("ended_ms"), "_final", *carry).agg(
        F.max(severity).alias("_severity"),
        F.sum(F.col("mark").isin("error", "crash").cast("bigint")).alias("error_count"),
        F.min("ts_ms").alias("started_ms"),
        F.max("ts_ms").alias("last_ms"))
    if carry:
        folded = folded.groupBy(*once).agg(
            F.max("_severity").alias("_severity"), F.sum("error_count").alias("error_count"), F.min("started_ms").alias("started_ms"),
            F.max("last_ms").alias("last_ms"), *[F.min(c).alias(c) for c in carry])
    status = F.element_at(F.array(F.lit("ok"), F.lit("errored"), F.lit("abnormal"), F.lit("crashed")),
                          F.col("_severity") + 1)
    return folded.select(
        "session_id", F.coalesce("_final", status).alias("status"), "error_count", "started_ms",
        F.greatest(F.coalesce("ended_ms", "last_ms") - F.col("started_ms"), F.lit(0)).alias("duration_ms"),
        F.col("ended_ms").isNotNull().alias("ended"), *carry)


def recover_sessions(states: DataFrame, now_ms: Column, transport_enabled: bool = True) -> DataFrame:
    """The end records owed for sessions whose process went away.

    Reads valid session states: session_id, started_at, updated_at, status, closed, recovery_attempts,
    lock_until, release, sdk_version. The latest state of a session counts.
    """
    latest = states.groupBy("session_id").agg(
        F.max_by(F.struct("started_at", "updated_at", "status", "closed", "recovery_attempts", "lock_until",
                          "release", "sdk_version"), F.struct("updated_at", "started_at")).alias("s"))
    due = latest.select("session_id", "s.*").where(
        ~F.coalesce("closed", F.lit(False))
        & (now_ms - F.col("started_at") <= fixed.SESSION_STATE_MAX_AGE_MS)
        & (F.coalesce("recovery_attempts", F.lit(0)) < fixed.SESSION_RECOVERY_ATTEMPTS)
        & (F.coalesce("lock_until", F.lit(0)) <= now_ms)
        & (F.coalesce(F.nullif("release", F.lit("")), "sdk_version").isNotNull())
        & F.lit(transport_enabled))
    return due.select(
        "session_id",
        F.when(F.col("status") == "crashed", "crashed").otherwise("abnormal").alias("status"),
        F.greatest(F.lit(0), F.least(F.lit(fixed.MAX_SAFE_INTEGER), F.col("updated_at") - F.col("started_at")))
        .alias("duration_ms"))


def session_starts(opens: DataFrame) -> DataFrame:
    """One start per session that knows a release or at least its SDK version; never sampled.

    Reads session_id, ts_ms, event_id, release, sdk_version, environment, user_id.
    """
    effective = F.coalesce(F.nullif("release", F.lit("")), "sdk_version")
    first = F.min_by(F.struct(effective.alias("release"), "environment", "user_id", "ts_ms"),
                     F.struct("ts_ms", "event_id"))
    return (opens.where(effective.isNotNull()).groupBy("session_id").agg(first.alias("s"))
            .select("session_id", "s.*"))
