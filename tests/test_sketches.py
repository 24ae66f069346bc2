"""Merged sketches against the rows they stand for."""

import pytest
from pyspark.sql import functions as F

from beaconry.operators import reports, sketches


@pytest.fixture(scope="module")
def queries(spark):
    """A third of all calls are of one statement; durations of the others are skewed."""
    i = F.col("id")
    return spark.range(120_000).select(
        (i % 50 * 1_200_000).alias("ts_ms"), F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), i % 5)).alias("query_hash"), F.lit("n").alias("normalized_query"),
        F.floor(F.pow(F.pmod(F.xxhash64(i), F.lit(10_000)) / 100.0, 3)).cast("bigint").alias("duration_ms"),
        F.when(i % 11 == 0, "error").otherwise("success").alias("status"), (i % 4 - 1).alias("rows_affected"))


def ranks(rows, quantile, key):
    held = rows.join(quantile, key)
    return held.groupBy(key).agg(F.avg((F.col("duration_ms") < F.col("q")).cast("double")).alias("below"),
                                 F.avg((F.col("duration_ms") <= F.col("q")).cast("double")).alias("upto")).collect()


@pytest.mark.parametrize("hours", [(None, None), (3_600_000, 8 * 3_600_000)])
def test_quantiles_of_any_hours(queries, hours):
    kept = sketches.hourly_query_stats(queries)
    assert kept.select("hour_ms").distinct().count() == 17
    inside = queries if hours[0] is None else queries.where((F.col("ts_ms") >= hours[0]) & (F.col("ts_ms") < hours[1]))
    stats = sketches.stats_between(kept, ["query_hash"], ["errors", "rows"], *hours, quantiles={"p50": 0.5, "p95": 0.95, "p99": 0.99})
    exact = {r.query_hash: r for r in reports.query_stats(inside).collect()}
    for r in stats.collect():
        e = exact.pop(r.query_hash)
        assert (r.calls, r.errors, r.rows) == (e.calls, e.errors, e.rows) and abs(r.mean_ms - e.mean_ms) < 1e-9
    assert not exact
    for name, q in (("p50_ms", 0.5), ("p95_ms", 0.95), ("p99_ms", 0.99)):
        for r in ranks(inside, stats.select("query_hash", F.col(name).alias("q")), "query_hash"):
            assert r.below - sketches.rank_error() <= q <= r.upto + sketches.rank_error()


def test_small_sketches_are_exact(spark):
    requests = spark.range(300).select(F.lit(5).alias("ts_ms"), F.lit("GET").alias("method"), F.lit("/a").alias("route"), F.col("id").alias("duration_ms"),
                                       F.when(F.col("id") < 30, 503).otherwise(200).alias("status_code"), F.lit(2).alias("response_size"))
    kept = sketches.hourly_endpoint_stats(requests)
    got = sketches.stats_between(kept, ["method", "route"], ["failed", "bytes"], quantiles={"p50": 0.5}).first()
    assert (got.calls, got.failed, got.bytes, got.mean_ms) == (300, 30, 600, 149.5) and got.p50_ms in (149, 150)
    assert sketches.stats_between(kept, ["method", "route"], ["failed", "bytes"], from_ms=10**7).count() == 0


@pytest.fixture(scope="module")
def sessions(spark):
    """A third of the sessions are one user's; some have none."""
    i = F.col("id")
    return spark.range(60_000).select(
        F.concat(F.lit("1."), i % 6).alias("release"), F.when(F.pmod(F.xxhash64(i), F.lit(25)) == 0, "crashed").otherwise("ok").alias("status"),
        F.when(i % 3 == 0, 7).when(i % 50 != 1, F.pmod(F.xxhash64(i, F.lit(1)), F.lit(9000))).alias("user_id"))


def test_users_over_any_releases(sessions):
    kept = sketches.release_sketches(sessions)
    for by in (F.lit("all"), F.col("release"), F.when(F.col("release") < "1.2", "old").otherwise("new")):
        want = {r.release: r for r in reports.release_health(sessions.withColumn("release", by)).collect()}
        for r in sketches.health_of(kept, by).collect():
            e = want.pop(r.releases)
            assert (r.sessions, r.users) == (e.sessions, e.users)
            assert abs(r.crash_free_sessions - e.crash_free_sessions) < 1e-12 and abs(r.crash_free_users - e.crash_free_users) < 1e-12
        assert not want


def test_large_sets_are_estimated(sessions):
    kept = sketches.release_sketches(sessions, lg_entries=10)
    got, want = sketches.health_of(kept, F.lit("all"), 10).first(), reports.release_health(sessions.withColumn("release", F.lit("all"))).first()
    assert abs(got.users / want.users - 1) < 0.1 and abs(got.crash_free_users - want.crash_free_users) < 0.1


def test_users_of_error_groups(spark, sessions):
    errors = sessions.select(F.lit("E").alias("exception_class"), (F.col("user_id") % 3).cast("string").alias("top_frame"), "release", "user_id")
    kept = sketches.group_sketches(errors)
    late = F.col("release") >= "1.4"
    got = {r.top_frame: (r.events, r.users, r.new_users) for r in sketches.users_of_groups(kept).join(
        sketches.new_users_of_groups(kept, ~late, late), ["exception_class", "top_frame"]).collect()}
    for frame, found in got.items():
        mine = errors.where(F.col("top_frame") == frame)
        old = {r[0] for r in mine.where(~late).select("user_id").distinct().collect()}
        new = {r[0] for r in mine.where(late).select("user_id").distinct().collect()}
        assert found == (mine.count(), len(old | new), len(new - old))
    assert sketches.users_of_groups(sketches.group_sketches(errors.limit(0))).count() == 0
