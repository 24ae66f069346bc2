"""Operators over small tables: order of steps, floors, skew settings, round trips."""

import json

import pytest
from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.operators import delivery, normalize, reports, sampling, scrubbing, sessions, wire
from beaconry.sources import envelopes as env, tables as t

NO_MECHANISM = "struct<type:string,name:string,handled:boolean>"


def errors(spark, n=40):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.lit("ValueError").alias("exception_class"),
        F.concat(F.lit("mail a@b.co "), "id").alias("message"),
        F.struct(F.lit("hook").alias("type"), F.lit(None).cast("string").alias("name"), F.lit(False).alias("handled"))
        .alias("mechanism"), F.lit(None).cast("boolean").alias("handled"),
        F.create_map(F.lit("note"), F.lit("x")).alias("metadata"))


def test_sampled_out_errors_never_reach_the_hook(spark):
    seen = []

    def hook(df):
        seen.append(df)
        return df.withColumn("metadata", F.create_map(F.lit("session_token"), F.lit("s3cret"), F.lit("note"), F.lit("c@d.co")))

    out = scrubbing.send_errors(errors(spark), 0.5, F.col("id"), hook)
    kept = {r.id for r in out.collect()}
    assert 0 < len(kept) < 40 and kept == {r.id for r in sampling.sample_errors(errors(spark), 0.5, F.col("id")).collect()}
    row = out.first()
    assert row.message.startswith("mail [REDACTED] ") and row.mechanism == "hook" and row.handled is False
    assert row.metadata == {"session_token": fixed.REDACTED, "note": fixed.REDACTED}
    assert "[REDACTED]" in seen[0].first().message  # the hook sees sanitized events
    assert scrubbing.send_errors(errors(spark), 0, F.col("id")).count() == 0
    assert scrubbing.send_errors(errors(spark), 1, F.col("id")).count() == 40


def test_row_hook_fails_open(spark):
    def hook(event):
        if event["id"] == "1":
            raise RuntimeError
        return None if event["id"] == "2" else {**event, "message": "changed"}

    out = {r.id: r.message for r in errors(spark, 4).transform(scrubbing.row_hook(hook, ["id", "message"])).collect()}
    assert out == {"0": "changed", "1": "mail a@b.co 1", "3": "changed"}


def test_retention_floors_and_order(spark):
    rows = [("s", i * 1000, i, 600) for i in range(10)] + [("t", 0, 1, 9000)]
    df = spark.createDataFrame(rows, "spool_id string, ts_ms bigint, seq bigint, bytes bigint")
    now = F.lit(9000)
    assert {(r.spool_id, r.seq) for r in delivery.retention(df, now, 0, 0, 0).collect()} == {("s", 9)}
    assert {r.seq for r in delivery.retention(df, now, max_bytes=1800).collect() if r.spool_id == "s"} == {7, 8, 9}
    assert {r.seq for r in delivery.retention(df, now, max_age_s=2).collect()} == {7, 8, 9}


def test_fold_sessions(spark):
    marks = [
        ("ok", 0, 1, "start", None), ("err", 0, 1, "start", None), ("err", 5, 2, "error", None),
        ("crash", 0, 1, "error", None), ("crash", 1, 2, "crash", None), ("crash", 2, 3, "error", None), ("crash", 3, 4, "abnormal", None),
        ("late", 0, 1, "start", None), ("late", 4, 2, "end", None), ("late", 5, 3, "crash", None), ("late", 6, 4, "end", "crashed"),
        ("final", 0, 1, "crash", None), ("final", 9, 2, "end", "ok"),
    ]
    df = spark.createDataFrame(marks, "session_id string, ts_ms bigint, event_id bigint, mark string, final_status string")
    got = {r.session_id: (r.status, r.error_count, r.duration_ms) for r in sessions.fold_sessions(df).collect()}
    assert got == {"ok": ("ok", 0, 0), "err": ("errored", 1, 5), "crash": ("crashed", 3, 3), "late": ("ok", 0, 4),
                   "final": ("ok", 1, 9)}


def test_delivery(spark):
    tries = [("c", 1, fixed.PATH_LOGS, 1, i, s, False) for i, s in enumerate([500, 429, 202], 1)]
    tries += [("c", 2, fixed.PATH_LOGS, 2, i, 503, False) for i in range(1, 6)]
    tries += [("c", 3, fixed.PATH_HEARTBEAT, 3, 5, 0, False), ("c", 4, fixed.PATH_LOGS, 4, 5, 0, True)]
    tries += [("c", 5, fixed.PATH_LOGS, 5, 1, 422, False), ("c", 6, fixed.PATH_LOGS, 6, 1, 401, False), ("c", 7, fixed.PATH_LOGS, 7, 1, 202, False)]
    df = spark.createDataFrame(tries, "client_id string, event_id bigint, path string, ts_ms bigint, attempt int, status int, is_drain boolean")
    out = delivery.delivery_outcome(df)
    assert {r.event_id: r.outcome for r in out.collect()} == {
        1: "sent", 2: "persisted", 3: "dropped", 4: "kept", 5: "rejected", 6: "auth_stopped", 7: "dropped_disabled"}
    d = delivery.diagnostics(out).first()
    assert (d.captured, d.sent, d.failed, d.dropped, d.persisted, d.retry_attempts, d.rate_limited) == (6, 1, 5, 4, 1, 14, 1)


def test_wire_omits_what_the_contract_omits(spark):
    df = spark.createDataFrame([("info", "m", "", None, {})], "level string, message string, service string, trace_id string, metadata map<string,string>")
    assert json.loads(df.select(wire.to_wire(df, "logs")).first()[0]) == {"level": "info", "message": "m"}
    beat = spark.createDataFrame([("s", "success", 1, "")], "slug string, status string, duration_ms bigint, message string")
    assert json.loads(beat.select(wire.to_wire(beat, "heartbeats")).first()[0])["message"] == ""


def test_spool_round_trip(spark, tmp_path):
    payload = '{"level":"info","message":"m","metadata":{"password":"p","n":1}}'
    rows = [(fixed.PATH_LOGS, payload, 5), (fixed.PATH_SESSION_END, "{}", 6)]
    df = spark.createDataFrame(rows, env.schemas.ENVELOPE)
    env.write_spool(df, str(tmp_path / "spool"))
    back = env.read_envelopes(spark, str(tmp_path / "spool")).collect()
    assert [(r.path, r.ts) for r in back] == [(fixed.PATH_LOGS, 5)]
    assert json.loads(back[0].payload)["metadata"] == {"password": fixed.REDACTED, "n": 1}
    one_a_file = tmp_path / "files"
    one_a_file.mkdir()
    (one_a_file / "0000000000009-00000003-ab.json").write_text('{"path":"/ingest/v1/db","payload":{"a":1},"ts":9}')
    (one_a_file / "0000000000009-00000004-ab.json").write_text('{"path":"/ingest')
    rows = sorted(env.read_envelopes(spark, str(one_a_file)).collect(), key=lambda r: r.seq)
    assert [(r.seq, r.payload, r.rejected) for r in rows] == [(3, '{"a":1}', None), (4, None, "document")]


@pytest.mark.parametrize("n, rejected", [(0, True), (1, False), (100, False), (101, True)])
def test_batch_size(spark, n, rejected):
    df = spark.range(1).select(F.array_repeat(F.lit(1), n).alias("requests"))
    assert (delivery.validate_batches(df, "requests").first().rejected is not None) == rejected


def test_mechanism(spark):
    df = spark.createDataFrame(
        [(("hook", None, False), None), ((None, "n", True), False), (("", "", None), None), (None, True)],
        f"mechanism {NO_MECHANISM}, handled boolean")
    assert [tuple(r) for r in normalize.flatten_mechanism(df).select("mechanism", "handled").collect()] == [
        ("hook", False), ("n", False), (None, None), (None, True)]


def test_approximate_reports_agree_on_small_groups(spark):
    calls = spark.range(200).select(
        F.lit("GET").alias("method"), (F.col("id") % 2).cast("string").alias("route"), F.lit(200).alias("status_code"),
        F.col("id").alias("duration_ms"), F.lit(1).alias("response_size"))
    exact = {r.route: r for r in reports.endpoint_stats(calls).collect()}
    rough = {r.route: r for r in reports.endpoint_stats(calls, exact=False).collect()}
    assert exact.keys() == rough.keys()
    for route in exact:
        assert exact[route].calls == rough[route].calls == 100 and abs(exact[route].p95_ms - rough[route].p95_ms) <= 2


def test_hot_group_is_limited_before_its_shuffle(spark, sf_dir):
    df = t.SPOOL_ENTRIES.frame(spark, sf_dir)
    plan = delivery.retention(df, F.lit(0), 5000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
