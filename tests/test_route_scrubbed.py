"""Payloads scrubbed along their schema come out as those scrubbed as JSON of unknown shape."""

import json
import random

from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.functions import scrub
from beaconry.sources import envelopes as env

TEXTS = ["plain", "mail me@example.com", "card 4111 1111 1111 1111", "card 4111111111111112", "ssn 123-45-6789", "from 10.0.0.1", "v1.2.3", "Bearer abc.def",
         "BEARER\tx", "a eyJa.bc.de b", "", "é   \"quoted\"", "😀", "{\"password\":\"x\"}", "[1,2]", "4111111111111111", "{\"a\":1", "token"]
KEYS = ["note", "password", "my_Token_x", "user_id", "url", "Card_Number", "K", "release"]


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 4:
        return rng.choice(TEXTS)
    if kind == 4:
        return rng.choice([1, 2.5, True, None, 4111111111111111, -1234567890123])
    if kind == 5:
        return rng.choice(KEYS)
    if kind == 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(KEYS): value(rng, depth + 1) for _ in range(rng.randrange(4))}


def payload(rng, kind):
    text = lambda: rng.choice(TEXTS)
    if kind == "errors":
        return {"exceptionClass": text(), "message": text(), "level": "error", "sessionId": text(), "user": {"id": "5", "email": text(), "ip": text()},
                "metadata": {rng.choice(KEYS): value(rng) for _ in range(3)}, "stackTrace": [text(), text()],
                "requestContext": {"method": "GET", "path": text(), "statusCode": 200, "userAgent": text()},
                "breadcrumbs": [{"type": "log", "message": text(), "data": {rng.choice(KEYS): value(rng)}}], "unheard": text()}
    if kind == "spans":
        return {"spans": [{"description": text(), "operation": text(), "tags": {rng.choice(KEYS): value(rng)}, "data": value(rng), "durationMs": 5} for _ in range(3)]}
    return {"level": text(), "message": value(rng), "userId": text(), "metadata": {rng.choice(KEYS): value(rng)}, "traceId": text()}


def test_same_rows_by_either_way(spark):
    rng = random.Random(12)
    rows = [(schemas.KINDS[kind][0], json.dumps(payload(rng, kind), ensure_ascii=rng.random() < 0.3), i)
            for i, kind in enumerate(rng.choices(["errors", "spans", "logs"], k=300))]
    envelopes = spark.createDataFrame(rows, "path string, payload string, ts long")
    for vendor, pii in ((None, False), ("acme", True)):
        whole = envelopes.withColumn("payload", scrub.scrub_json(F.col("payload"), vendor=vendor, send_default_pii=pii, keep=["sessionId"]))
        for kind in ("errors", "spans", "logs"):
            got = {r.ts: r for r in env.route_scrubbed(envelopes, kind, vendor, pii).collect()}
            want = {r.ts: r for r in env.route(whole, kind).collect()}
            assert got == want and len(got) > 50


def test_only_nested_secrets_enter_python(spark, monkeypatch):
    """The Python step gets the payloads with a nested document that has something to redact, and no others."""
    @F.udf("string")
    def refuse(text):
        raise ValueError(text)

    monkeypatch.setattr(env, "scrub_json", lambda column, **_: refuse(column))
    clean = [{"level": "info", "message": f"mail u{i}@example.com", "metadata": {"password": "x", "n": i, "flat": "card 4111 1111 1111 1111", "list": [1, 2]}} for i in range(200)]
    rows = spark.createDataFrame([(schemas.KINDS["logs"][0], json.dumps(c), i) for i, c in enumerate(clean)], "path string, payload string, ts long")
    got = env.route_scrubbed(rows, "logs").collect()
    assert len(got) == 200 and all(r.message == "mail [REDACTED]" and r.metadata["password"] == "[REDACTED]" and r.metadata["flat"] == "card [REDACTED]" for r in got)
    nested = spark.createDataFrame([(schemas.KINDS["logs"][0], '{"metadata":{"x":{"pwd":"p"}}}', 1)], "path string, payload string, ts long")
    try:
        env.route_scrubbed(nested, "logs").collect()
        raise SystemExit("a nested secret was not handed on")
    except Exception as error:
        assert "ValueError" in str(error)


def test_guard_errs_on_the_safe_side(spark):
    """Whatever the tree walk changes, the native test has seen."""
    rng = random.Random(13)
    documents = [json.dumps(value(rng), ensure_ascii=rng.random() < 0.5) for _ in range(2000)]
    docs = spark.createDataFrame([(d,) for d in documents], "d string").select("d", scrub.may_hold_secrets(F.col("d")).alias("seen"))
    terms = scrub.denied_terms()
    clean = 0
    for d, seen in docs.collect():
        clean += not seen
        if not seen:
            node = json.loads(d)
            assert scrub._scrub_tree(json.loads(d), terms, False, True) == node
    assert clean > 300
