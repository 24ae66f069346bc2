"""Reports kept as mergeable sketches: written once per hour or release, asked later for any span of them.

Quantiles are KLL sketches, distinct users theta sketches. Both have a fixed size, fold within tasks before they shuffle and
merge without the rows they stand for. Below their size they are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOUR_MS = 3_600_000
K = 400  # of a quantile sketch: the rank of a quantile is off by about 1 % at most, in 99 of 100 cases
LG_ENTRIES = 14  # of a user sketch: 16,384 users are counted exactly, more to about 1 %


def rank_error(k: int = K) -> float:
    """How far the rank of one quantile may be off (99 % confidence): the fit that the sketch's authors publish."""
    return 2.296 / k ** 0.9021


def hourly(rows: DataFrame, keys: list[str], sums: dict[str, Column], at_ms: str = "ts_ms", duration: str = "duration_ms", k: int = K,
           size_ms: int = HOUR_MS) -> DataFrame:
    """Per hour and ``keys``: calls, ``sums`` and a sketch of the durations. Rows without a time are hour null."""
    hour = (F.floor(F.col(at_ms) / size_ms) * size_ms).alias("hour_ms")
    return rows.select(hour, *keys, F.col(duration).cast("bigint").alias("_ms"), *[c.alias(n) for n, c in sums.items()]).groupBy("hour_ms", *keys).agg(
        F.count(F.lit(1)).alias("calls"), *[F.sum(n).alias(n) for n in sums], F.sum("_ms").alias("total_ms"),
        F.kll_sketch_agg_bigint("_ms", k).alias("durations"))


def hourly_query_stats(queries: DataFrame, k: int = K) -> DataFrame:
    """Reads ts_ms, query_hash, normalized_query, duration_ms, status, rows_affected; see ``hourly``."""
    return hourly(queries, ["query_hash", "normalized_query"], {
        "errors": (F.col("status") == "error").cast("bigint"), "rows": F.greatest("rows_affected", F.lit(0)).cast("bigint")}, k=k)


def hourly_endpoint_stats(requests: DataFrame, k: int = K) -> DataFrame:
    """Reads ts_ms, method, route, duration_ms, status_code, response_size; see ``hourly``."""
    return hourly(requests, ["method", "route"], {
        "failed": (F.col("status_code") >= 500).cast("bigint"), "bytes": F.col("response_size").cast("bigint")}, k=k)


def stats_between(hours: DataFrame, keys: list[str], sums: list[str], from_ms: int | None = None, to_ms: int | None = None,
                  quantiles: dict[str, float] | None = None) -> DataFrame:
    """Per ``keys``: calls, ``sums``, mean and quantiles over the hours from ``from_ms`` to before ``to_ms``, without the rows."""
    inside = F.lit(True)
    if from_ms is not None:
        inside = inside & (F.col("hour_ms") >= from_ms)
    if to_ms is not None:
        inside = inside & (F.col("hour_ms") < to_ms)
    merged = hours.where(inside).groupBy(*keys).agg(
        F.sum("calls").alias("calls"), *[F.sum(n).alias(n) for n in sums], F.sum("total_ms").alias("_total"),
        F.kll_merge_agg_bigint("durations").alias("_durations"))
    found = {f"{name}_ms": F.kll_sketch_get_quantile_bigint("_durations", F.lit(q)) for name, q in (quantiles or {"p50": 0.5, "p95": 0.95}).items()}
    return merged.withColumn("mean_ms", F.col("_total") / F.col("calls")).withColumns(found).drop("_total", "_durations")


def user_sketches(rows: DataFrame, keys: list[str], flags: dict[str, Column], lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Per ``keys``: rows, how many meet each of ``flags``, and sketches of the users of all rows and of those that meet one.

    Reads user_id; rows without a user count as rows. Sketches are named ``users`` and ``<flag>_users``.
    """
    marked = rows.select(*keys, "user_id", *[c.alias(n) for n, c in flags.items()])
    return marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(n).alias(n) for n in flags], F.theta_sketch_agg("user_id", lg_entries).alias("users"),
        *[F.theta_sketch_agg(F.when(F.col(n), F.col("user_id")), lg_entries).alias(f"{n}_users") for n in flags])


def release_sketches(sessions: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Reads release, status, user_id of folded sessions; see ``user_sketches``."""
    return user_sketches(sessions, ["release"], {"crashed": F.col("status") == "crashed"}, lg_entries)


def health_of(sketches: DataFrame, by: Column, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Health of any groups of releases: sessions, users and the shares without a crash.

    ``by`` maps a release's row to its group. Users of several releases of a group count once, and are free of crashes if
    they are in all of them: the users whose sketch lacks the crashed ones.
    """
    merged = sketches.groupBy(by.alias("releases")).agg(
        F.sum("rows").alias("sessions"), F.sum("crashed").alias("_crashed"), F.theta_union_agg("users", lg_entries).alias("_users"),
        F.theta_union_agg("crashed_users", lg_entries).alias("_crashed_users"))
    users = F.theta_sketch_estimate("_users")
    free = F.theta_sketch_estimate(F.theta_difference("_users", "_crashed_users"))
    return merged.select(
        "releases", "sessions", (1 - F.col("_crashed") / F.col("sessions")).alias("crash_free_sessions"), users.alias("users"),
        (free / F.nullif(users, F.lit(0))).alias("crash_free_users"))


def group_sketches(errors: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Reads exception_class, top_frame, release, user_id of errors; see ``user_sketches``."""
    return user_sketches(errors, ["exception_class", "top_frame", "release"], {}, lg_entries)


def users_of_groups(sketches: DataFrame, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Per fingerprint over all its releases: events and users."""
    return sketches.groupBy("exception_class", "top_frame").agg(F.sum("rows").alias("events"), F.theta_sketch_estimate(
        F.theta_union_agg("users", lg_entries)).alias("users"))


def new_users_of_groups(sketches: DataFrame, before: Column, after: Column, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """Per fingerprint: users that met it in releases ``after`` and in none of ``before``."""
    sides = sketches.groupBy("exception_class", "top_frame").agg(
        F.theta_union_agg(F.when(before, F.col("users")), lg_entries).alias("_before"), F.theta_union_agg(F.when(after, F.col("users")), lg_entries).alias("_after"))
    return sides.select("exception_class", "top_frame", F.theta_sketch_estimate(F.theta_difference("_after", "_before")).alias("new_users"))
