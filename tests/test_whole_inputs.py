"""Nothing is cut, lost or let through in silence: long, deep, broken and odd inputs."""

import json

import pytest
from pyspark.sql import functions as F

from beaconry import fixed_values as fixed, session
from beaconry.functions import records as rec, scrub, trace_context as tc
from beaconry.operators import delivery, normalize, scrubbing
from beaconry.sources import envelopes as env
from beaconry.streaming import stateless


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


def test_long_texts_are_scanned_whole(spark):
    text = "x" * 40_000 + " alice@example.com"
    assert one(spark, text, scrub.scrub_text) == "x" * 40_000 + " " + fixed.REDACTED
    assert one(spark, text, lambda c: scrub.scrub_text(c, max_chars=fixed.MAX_SCAN_CHARS)) == text
    assert one(spark, json.dumps({"a": text}), scrub.scrub_json) == json.dumps({"a": "x" * 40_000 + " " + fixed.REDACTED}, separators=(",", ":"))
    audit = scrubbing.pii_audit(spark.createDataFrame([(text, "s")], "text string, source string"), "text", ["source"])
    assert [tuple(r) for r in audit.collect()] == [("s", "email", 1)]


def test_guards_know_digits_of_every_script(spark):
    arabic = "".join(chr(0x660 + int(d)) if d.isdigit() else d for d in "123-45-6789")
    assert one(spark, f"ssn {arabic} on file", scrub.scrub_text) == f"ssn {fixed.REDACTED} on file"


@pytest.mark.parametrize("text, gone, stays", [
    ("not json a@b.co 123-45-6789", ["a@b.co", "123-45-6789"], "not json"),
    ('{"password":"hunter2', ["hunter2"], '"password"'),
    ('{"n":1,"token":{"a":"hunter2","b":[1', ["hunter2"], '"n":1'),
    ('{"cvv":123,"n":7', ["123"], '"n":7'),
    ("[" * 100_000 + '"mail a@b.co"', ["a@b.co"], "mail"),
    ('{"a":"\\ud800","m":"a@b.co","password":"hunter2"}', ["a@b.co", "hunter2"], "\\ud800"),
    ("[" * 900 + '{"password":["hunter2"],"m":"a@b.co"}' + "]" * 900, ["hunter2", "a@b.co"], fixed.REDACTED),
])
def test_odd_json(spark, text, gone, stays):
    out = one(spark, text, scrub.scrub_json)
    assert stays in out and not [g for g in gone if g in out]


def test_keys_of_maps_of_any_type(spark):
    row = spark.range(1).select(
        F.create_map(F.lit("password"), F.array(F.lit("hunter2")), F.lit("n"), F.array(F.lit("v"))).alias("lists"),
        F.create_map(F.lit("cvv"), F.lit(123), F.lit("n"), F.lit(5)).alias("numbers"),
        F.create_map(F.lit("a"), F.create_map(F.lit("session"), F.lit("hunter2"), F.lit("k"), F.lit("v"))).alias("maps"),
        F.create_map(F.lit("jwt"), F.struct(F.lit("x").alias("secret"), F.lit(1).alias("b")), F.lit("s"), F.struct(F.lit("hunter2").alias("secret"), F.lit(2).alias("b"))).alias("structs"))
    out = scrubbing.scrub_columns(row, row.columns).first()
    assert out.lists == {"password": fixed.REDACTED, "n": '["v"]'}
    assert out.numbers == {"cvv": fixed.REDACTED, "n": "5"}
    assert json.loads(out.maps["a"]) == {"session": fixed.REDACTED, "k": "v"}
    assert out.structs["jwt"] == fixed.REDACTED and json.loads(out.structs["s"]) == {"secret": fixed.REDACTED, "b": 2}


def test_hooks_fail_open(spark):
    df = spark.createDataFrame([(i, f"m{i}") for i in range(6)], "id long, message string")
    results = {0: None, 1: "text", 2: {"id": "no number", "message": "x"}, 3: {"id": 3, "message": 7}, 4: {"id": 4, "message": "new"}}

    def hook(event):
        if event["id"] == 5:
            raise ValueError("hook failed")
        return results[event["id"]]

    rows = df.transform(scrubbing.row_hook(hook, ["id", "message"])).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "m1"), (2, "m2"), (3, "m3"), (4, "new"), (5, "m5")]


def test_paths_lose_parameters_of_the_last_segment(spark):
    for url, path in (("/cart;jsessionid=SECRET?x=1", "/cart"), ("/a;b/c;d;e#f", "/a;b/c"), ("http://h/x;y", "/x"), (";only", ";only")):
        assert one(spark, url, rec.strip_query) == path
    assert one(spark, "http://h/x;y/z;v=1?q", rec.url_path) == "/x;y/z"


def test_small_rules(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for text, seconds in (("Mon, 1 Jan 2024 00:01:00 GMT", 60), ("Mon, 01 Jan 2024 00:02:00 +0000", 120), ("Mon, 01 Jan 2024 02:03:00 +0200", 180)):
        assert one(spark, text, lambda c: rec.retry_after_seconds(c, at)) == seconds
    own = one(spark, "acme-trace_id=abc==, acme-span_id=old, x=y, acme-span_id=new", lambda c: tc.baggage_members(c, "acme"))
    assert own.own == {"trace_id": "abc==", "span_id": "new"} and own.preserved == "x=y"
    user = spark.range(1).select(rec.pick_user([F.lit(""), F.lit("u7")], F.lit(None).cast("string"), [F.lit(""), F.lit("1.2.3.4")])).first()[0]
    assert (user.id, user.ip) == ("u7", "1.2.3.4")
    call = spark.createDataFrame([("http://h/p", "get", 404, "HTTPError", -5)], "url string, method string, status_code int, raised string, duration_ms long")
    row = normalize.outbound_from_url(call).first()
    assert (row.status_code, row.duration_ms) == (404, 0)


def test_pending_is_no_failure(spark):
    rows = [("c", 1, fixed.PATH_LOGS, 10, 1, 503, False), ("c", 2, fixed.PATH_LOGS, 20, 5, 503, False), ("c", 3, fixed.PATH_LOGS, 30, 2, 200, False)]
    log = spark.createDataFrame(rows, "client_id string, event_id long, path string, ts_ms long, attempt int, status int, is_drain boolean")
    outcomes = delivery.delivery_outcome(log)
    assert {r.event_id: r.outcome for r in outcomes.collect()} == {1: "pending", 2: "persisted", 3: "sent"}
    counts = delivery.diagnostics(outcomes).first()
    assert (counts.captured, counts.sent, counts.failed, counts.persisted, counts.dropped) == (3, 1, 1, 1, 0)


def test_spool_rejects_by_argument_only(spark, tmp_path):
    rows = [(fixed.PATH_LOGS, json.dumps({"m": "x" * 6_000_000}), 7), (fixed.PATH_LOGS, "{}", 8)]
    df = spark.createDataFrame(rows, env.schemas.ENVELOPE)
    for name, limit in (("all", None), ("small", fixed.SPOOL_ENTRY_MAX_BYTES)):
        env.write_spool(df, str(tmp_path / name), max_entry_bytes=limit)
    assert sorted(r.ts for r in env.read_envelopes(spark, str(tmp_path / "all")).collect()) == [7, 8]
    assert [r.ts for r in env.read_envelopes(spark, str(tmp_path / "small")).collect()] == [8]
    assert [r.ts for r in env.read_envelopes(spark, str(tmp_path / "small-rejected")).collect()] == [7]


def test_ingest_keeps_every_document(spark, tmp_path):
    lines = ['{"path":"/ingest/v1/logs","payload":{"level":"info","message":"m"},"ts":1}', '{"path":"/ingest/v1/heartbeat","payload":{"slug":"s","status":"success","durationMs":1},"ts":2}',
             '{"path":"/ingest/v1/unheard-of","payload":{"password":"hunter2"},"ts":3}', "{broken a@b.co", '{"path":7,"payload":{}}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text("\n".join(lines))
    write = stateless.ingest_writer(str(tmp_path / "out"))
    write(env.read_envelopes(spark, str(tmp_path / "in")), 0)
    out = spark.read.parquet(str(tmp_path / "out" / "rejected_envelopes")).collect()
    assert sorted(r.rejected for r in out) == ["document", "kind", "path"]
    assert not [r for r in out if "hunter2" in str(r) or "a@b.co" in str(r)]
    assert spark.read.parquet(str(tmp_path / "out" / "logs")).count() == 1 == spark.read.parquet(str(tmp_path / "out" / "heartbeats")).count()


def test_no_local_folder_on_a_cluster(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Cluster:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(Cluster, "x")
    Cluster.conf["spark.checkpoint.dir"] = "hdfs:///shared"
    assert session.scratch_dir(Cluster, "x").startswith("hdfs:///shared/")
