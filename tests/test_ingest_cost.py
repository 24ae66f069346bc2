"""What ingest costs a row: payloads parsed once a way, documents without schemas, kinds with a check scrubbed once."""

import json

from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions import scrub
from beaconry.sources import envelopes as env
from beaconry.streaming import stateless


def test_payloads_are_parsed_once_a_way(spark):
    """Moved below the parsing, the test for nested documents would parse again for every field: 110 times for releases."""
    rows = spark.createDataFrame([("p", "{}", 1)], "path string, payload string, ts long")
    for kind in schemas.KINDS:
        plan = env.route_scrubbed(rows, kind)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 3, kind


def test_objects_are_told_without_their_schema(spark):
    lines = {'{"path":"a","payload":{"b":1}}': None, '{"path":"a","payload":{}}': None, '{"path":"a","payload":"{}"}': "payload",
             '{"path":"a","payload":null}': "payload", '{"path":"a","payload":[{}]}': "payload", '{"path":"a"}': "payload",
             '{"path":7,"payload":{}}': "path", '[{"path":"a","payload":{}}]': "document", '"x"': "document", "null": "document", "{": "document"}
    parsed = env.parse_envelopes(spark.createDataFrame([(line, "x") for line in lines], "value string, file string"))
    assert parsed.where("rejected IS NULL").count() == 2
    assert {r.value: r.rejected for r in parsed.collect() if r.rejected} == {line: reason for line, reason in lines.items() if reason}
    assert parsed._jdf.queryExecution().analyzed().toString().count("schema_of_variant") == 1  # of the path


def test_ids_that_begin_with_digits_stay_out_of_python(spark):
    """An id of 13 leading digits is no number, and ids are not scanned; a number in a scanned field is still handed on."""
    shape = spark.createDataFrame([], schemas.KINDS["logs"][1]).schema

    def free(**log):
        row = spark.createDataFrame([(json.dumps(log),)], "payload string")
        body = F.from_json("payload", schemas.KINDS["logs"][1])
        held = row.select(scrub.holds_documents(body, shape).alias("held"), scrub.may_hold_documents(F.col("payload")).alias("may")).first()
        assert held.may or not held.held
        return held.held

    assert not free(traceId="1234567890123456abcdef1234567890", message="m")
    assert not free(traceId=4111111111111111)
    assert not free(message="1234567890123 items")
    assert free(message=4111111111111111)
    assert free(traceId={"password": "p"})
    assert free(metadata={"n": [{"password": "p"}]})


def test_checked_kinds_are_scrubbed_once(spark, tmp_path, monkeypatch):
    """The table and its rejects come from one scrubbing, not one each."""
    done = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        done.add(1)
        return text

    monkeypatch.setattr(env, "scrub_json", lambda column, **_: counted(column))
    nested = '{"path":"/ingest/v1/logs","payload":{"level":"%s","message":"m","metadata":{"x":{"pwd":"p"}}},"ts":1}'
    batch = env.parse_envelopes(spark.createDataFrame([(nested % level, "x") for level in ("info", "loud")], "value string, file string"))
    stateless.ingest_writer(str(tmp_path), ["logs"])(batch, 0)
    assert done.value == 2
    assert [r.level for r in spark.read.parquet(f"{tmp_path}/logs").collect()] == ["info"]
    assert [(r.level, r.rejected) for r in spark.read.parquet(f"{tmp_path}/rejected_logs").collect()] == [("loud", "level")]
