"""Scrubbing and sampling jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import scrub
from beaconry.operators import instrument, sampling, scrubbing
from beaconry.plans import check_sql as sql
from beaconry.plans.registry import job
from beaconry.session import spread
from beaconry.sources import tables as t

VENDOR = "acme"


@job("scrub_text", f"""
SELECT doc_id, md5(scrubbed) AS digest, length(scrubbed) AS chars, scrubbed <> text AS changed
FROM ({sql.scrubbed('SELECT * FROM documents', 'text')})""")
def scrub_text(spark, sf_dir):
    docs = spread(t.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.withColumn("out", scrub.scrub_text(F.col("text"))).select(
        "doc_id", F.md5("out").alias("digest"), F.length("out").alias("chars"),
        (F.col("out") != F.col("text")).alias("changed"))


@job("scrub_text_with_pii", f"""
SELECT doc_id, md5(scrubbed) AS digest FROM ({sql.scrubbed('SELECT * FROM documents', 'text', send_default_pii=True)})""")
def scrub_text_with_pii(spark, sf_dir):
    docs = spread(t.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5(scrub.scrub_text(F.col("text"), send_default_pii=True)).alias("digest"))


@job("scrub_conversations", f"""
SELECT conv_id, turn, role, scrubbed AS text FROM ({sql.scrubbed('SELECT * FROM conversations', 'text')})""")
def scrub_conversations(spark, sf_dir):
    rows = spread(t.read(spark, sf_dir, "conversations"))
    return rows.withColumn("text", scrub.scrub_text(F.col("text")))


@job("mask_cards", f"""
SELECT doc_id, len(list_filter(regexp_extract_all(text, {sql.quote(fixed.CARD_RUN)}), lambda r: {sql.is_card('r')}))
  AS cards, md5(masked) AS digest FROM ({sql.masked_cards('SELECT * FROM documents', 'text', 'masked')})""")
def mask_cards(spark, sf_dir):
    text = F.col("text")
    docs = spread(t.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.size(F.filter(scrub.card_runs(text), scrub.is_card)).alias("cards"),
                       F.md5(scrub.mask_cards(text)).alias("digest"))


@job("mask_secrets", f"""
SELECT doc_id, md5({sql.replaced(sql.replaced(sql.replaced('text', fixed.SSN), fixed.BEARER), fixed.JWT)}) AS secrets,
  md5({sql.replaced(sql.replaced('text', fixed.EMAIL), fixed.IPV4)}) AS addresses FROM documents""")
def mask_secrets(spark, sf_dir):
    text = F.col("text")
    docs = spread(t.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.md5(scrub.mask_jwt(scrub.mask_bearer(scrub.mask_ssn(text)))).alias("secrets"),
                       F.md5(scrub.mask_ipv4(scrub.mask_email(text))).alias("addresses"))


def _hits(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, {sql.quote(pattern)}))"


def _audit_sql() -> str:
    source = "SELECT source, text FROM documents"
    cards = sql.masked_cards(source, "text", "c0")
    steps = [("ssn", fixed.SSN), ("bearer", fixed.BEARER), ("jwt", fixed.JWT), ("email", fixed.EMAIL),
             ("ipv4", fixed.IPV4)]
    counted = [f"SELECT source, 'card' AS rule, len(list_filter(regexp_extract_all(text, {sql.quote(fixed.CARD_RUN)}), "
               f"lambda r: {sql.is_card('r')})) AS hits FROM documents"]
    text = "c0"
    for rule, pattern in steps:
        counted.append(f"SELECT source, '{rule}' AS rule, {_hits(text, pattern)} AS hits FROM ({cards})")
        text = sql.replaced(text, pattern)
    return ("SELECT source, rule, CAST(sum(hits) AS BIGINT) AS redactions FROM (" + " UNION ALL ".join(counted)
            + ") WHERE hits > 0 GROUP BY source, rule")


@job("pii_audit", _audit_sql())
def pii_audit(spark, sf_dir):
    docs = spread(t.read(spark, sf_dir, "documents").select("source", "text"))
    return scrubbing.pii_audit(docs, "text", ["source"])


_METADATA = {
    "user": ("CAST(user_id AS STRING)", "CAST(user_id AS VARCHAR)"),
    "password": "concat('pw', user_id)",
    "max_tokens": "'12'",
    "className": "'Order'",
    "note": "concat('mail u', user_id, '@example.com')",
    "url": "concat('http://10.0.0.', user_id % 256, '/x')",
    "Custom-PII": "'v'",
}


@job("redact_keys", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_value, '[REDACTED]' AS password, '[REDACTED]' AS max_tokens,
  '[REDACTED]' AS class_name, '[REDACTED]' AS custom, concat('mail u', user_id, '@example.com') AS note,
  '[REDACTED]' AS nested_cookie, concat('a', event_id) AS nested_plain, '[REDACTED]' AS listed_secret FROM events""")
def redact_keys(spark, sf_dir):
    """Sensitive keys in maps, structs and arrays of structs."""
    events = t.read(spark, sf_dir, "events")
    entries = []
    for key, value in _METADATA.items():
        entries += [F.lit(key), F.expr(value if isinstance(value, str) else value[0])]
    plain = F.concat(F.lit("a"), "event_id")
    records = events.select(
        "event_id", F.create_map(*entries).alias("metadata"),
        F.struct(F.struct(F.lit("c=1").alias("Set_Cookie"), plain.alias("plain")).alias("inner")).alias("nested"),
        F.array(F.struct(F.lit("s").alias("client_secret"), F.lit(1).alias("n"))).alias("items"))
    out = scrubbing.scrub_columns(records, ["metadata", "nested", "items"], extra=["custom-pii"], values=False)
    m = F.col("metadata")
    return out.select(
        "event_id", m["user"].alias("user_value"), m["password"].alias("password"), m["max_tokens"].alias("max_tokens"),
        m["className"].alias("class_name"), m["Custom-PII"].alias("custom"), m["note"].alias("note"),
        F.col("nested.inner.Set_Cookie").alias("nested_cookie"), F.col("nested.inner.plain").alias("nested_plain"),
        F.col("items")[0]["client_secret"].alias("listed_secret"))


@job("scrub_values", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_value, 'mail [REDACTED]' AS note,
  concat('http://10.0.0.', user_id % 256, '/x') AS url, 'seen at [REDACTED]' AS nested_text,
  concat('10.0.0.', user_id % 256) AS nested_release, 'ip [REDACTED]' AS listed FROM events""")
def scrub_values(spark, sf_dir):
    """Free text at any depth, with the keys that pass through."""
    events = t.read(spark, sf_dir, "events")
    ip = F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string"))
    entries = []
    for key in ("user", "note", "url"):
        value = _METADATA[key]
        entries += [F.lit(key), F.expr(value if isinstance(value, str) else value[0])]
    records = events.select(
        "event_id", F.create_map(*entries).alias("metadata"),
        F.struct(F.concat(F.lit("seen at "), ip).alias("text"), ip.alias("release")).alias("nested"),
        F.array(F.concat(F.lit("ip "), ip)).alias("items"))
    out = scrubbing.scrub_columns(records, ["metadata", "nested", "items"], keys=False)
    m = F.col("metadata")
    return out.select("event_id", m["user"].alias("user_value"), m["note"].alias("note"), m["url"].alias("url"),
                      F.col("nested.text").alias("nested_text"), F.col("nested.release").alias("nested_release"),
                      F.col("items")[0].alias("listed"))


@job("scrub_json", """
SELECT event_id, concat('{"k":', json_extract_string(props, '$.k'), ',"user":{"email":"u', user_id,
  '@example.com","password":"[REDACTED]"},"list":["[REDACTED]",', user_id, '],"session_state":"[REDACTED]"}') AS document
FROM events""")
def scrub_json(spark, sf_dir):
    """Free-form JSON documents, whose shape the plan does not know."""
    document = F.expr("""concat('{"k":', get_json_object(props, '$.k'), ',"user":{"email":"u', user_id,
        '@example.com","password":{"old":"x"}},"list":["u', user_id, '@example.com",', user_id,
        '],"session_state":{"a":[1,2]}}')""")
    events = spread(t.read(spark, sf_dir, "events").select("event_id", document.alias("document")))
    return events.withColumn("document", scrub.scrub_json(F.col("document"), vendor=VENDOR))


@job("scrub_task_args", """
SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 3 <> 0 THEN concat('[', o_orderkey,
  ',{"password":"[REDACTED]","n":1}]') END AS args, concat('{"order":', o_orderkey,
  ',"api_key":"[REDACTED]","nested":{"Cookie":"[REDACTED]","ok":true}}') AS kwargs FROM orders""")
def scrub_task_args(spark, sf_dir):
    runs = spread(t.TASK_RUNS.frame(spark, sf_dir).select("run_id", "args", "kwargs"))
    return scrubbing.scrub_task_args(runs)


_CAPTURED = "upper(method) IN ('CONNECT','DELETE','GET','PATCH','POST','PUT','TRACE')"
_FAILED = "(raised IS NOT NULL OR status BETWEEN 500 AND 599)"
_ERROR_MESSAGE = ("CASE WHEN raised IS NULL THEN concat(upper(method), ' ', coalesce(route, 'generic ASGI request'), "
                  "' responded with ', status) ELSE coalesce(nullif(raised_message, ''), raised) END")


@job("sanitize_errors", f"""
SELECT event_id, scrubbed AS message, md5(concat('s', event_id)) AS session_id, upper(method) AS method, path,
  host, '[REDACTED]' AS meta_token, trace_id AS meta_trace
FROM ({sql.scrubbed(f"SELECT *, {_ERROR_MESSAGE} AS _m FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED} AND {_FAILED}", '_m')})""")
def sanitize_errors(spark, sf_dir):
    """Error events of the access log, scrubbed; the top-level session id stays."""
    errors = instrument.asgi_errors(instrument.asgi_requests(t.ACCESS.frame(spark, sf_dir)))
    errors = errors.withColumn("session_id", F.md5(F.concat(F.lit("s"), "event_id"))).withColumn(
        "metadata", F.map_concat("metadata", F.create_map(F.lit("auth_token"), F.col("request_id"))))
    m = F.col("metadata")
    return scrubbing.sanitize_errors(errors, vendor=VENDOR).select(
        "event_id", "message", "session_id", m["http.method"].alias("method"), m["http.path"].alias("path"),
        m["http.host"].alias("host"), m["auth_token"].alias("meta_token"), m["traceId"].alias("meta_trace"))


@job("send_errors", f"""
SELECT event_id, concat(scrubbed, ' hook [REDACTED]') AS message,
  CASE WHEN raised IS NOT NULL THEN 'fastapi' END AS mechanism, CASE WHEN raised IS NOT NULL THEN true END AS handled
FROM ({sql.scrubbed(f"SELECT *, {_ERROR_MESSAGE} AS _m FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED} AND {_FAILED}", '_m')})
WHERE {sql.sampling_unit('CAST(event_id AS VARCHAR)')} < 0.6 AND raised IS DISTINCT FROM 'KeyError'""")
def send_errors(spark, sf_dir):
    """The whole order of steps, with a hook that drops one class and brings an address back in."""
    errors = instrument.asgi_errors(instrument.asgi_requests(t.ACCESS.frame(spark, sf_dir)))

    def hook(df):
        return df.where("exception_class <> 'KeyError'").withColumn(
            "message", F.concat("message", F.lit(" hook back@example.com")))

    return scrubbing.send_errors(errors, 0.6, F.col("event_id").cast("string"), hook, vendor=VENDOR).select(
        "event_id", "message", "mechanism", "handled")


@job("before_send_rows", f"""
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN {_ERROR_MESSAGE} ELSE concat('seen ', {_ERROR_MESSAGE}) END AS message
FROM ({t.ACCESS.sql()}) WHERE {_CAPTURED} AND {_FAILED} AND raised IS DISTINCT FROM 'KeyError'""")
def before_send_rows(spark, sf_dir):
    """A hook over single events: changes some, drops some, raises on some."""
    errors = instrument.asgi_errors(instrument.asgi_requests(t.ACCESS.frame(spark, sf_dir))).select(
        F.col("event_id").cast("string").alias("id"), "event_id", "exception_class", "message")

    def hook(event):
        if event["exception_class"] == "KeyError":
            return None
        if int(event["id"]) % 5 == 0:
            raise ValueError("hook failed")
        return {**event, "message": "seen " + event["message"]}

    return errors.transform(scrubbing.row_hook(hook, ["id", "exception_class", "message"])).select(
        "event_id", "message")


@job("sample_errors", f"""
SELECT event_id, raised FROM ({t.ACCESS.sql()}) WHERE raised IS NOT NULL
  AND {sql.sampling_unit('CAST(event_id AS VARCHAR)')} < 0.25""")
def sample_errors(spark, sf_dir):
    errors = t.ACCESS.frame(spark, sf_dir).where("raised IS NOT NULL").select("event_id", "raised")
    return sampling.sample_errors(errors, 0.25, F.col("event_id").cast("string"))


@job("sample_traces", f"""
SELECT trace_id, count(*) AS spans FROM ({t.SPANS.sql()}) WHERE {sql.sampling_unit('trace_id')} < 0.3
GROUP BY trace_id""")
def sample_traces(spark, sf_dir):
    kept = sampling.sample_traces(t.SPANS.frame(spark, sf_dir).select("trace_id"), 0.3)
    return kept.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"))


@job("sample_inbound", f"""
SELECT event_id, tp_sampled FROM ({sql.with_traceparent(t.HEADERS.sql())})
WHERE coalesce(tp_sampled, {sql.sampling_unit('coalesce(tp_trace, CAST(event_id AS VARCHAR))')} < 0.3)""")
def sample_inbound(spark, sf_dir):
    from beaconry.functions.trace_context import parse_traceparent

    tp = parse_traceparent(F.col("traceparent"))
    rows = t.HEADERS.frame(spark, sf_dir).select(
        "event_id", tp["sampled"].alias("tp_sampled"),
        F.coalesce(tp["trace_id"], F.col("event_id").cast("string")).alias("trace_id"))
    return sampling.sample_traces(rows, 0.3, inbound_sampled=F.col("tp_sampled")).select("event_id", "tp_sampled")


@job("scrub_kinds", f"""
SELECT 'spans' AS kind, span_id AS id, description AS text FROM ({t.SPANS.sql()})
UNION ALL SELECT 'logs', CAST(log_id AS VARCHAR), scrubbed FROM ({sql.scrubbed(t.LOGS.sql(), 'message')})
UNION ALL SELECT 'db_queries', CAST(statement_id AS VARCHAR), error_message FROM ({t.STATEMENTS.sql()})""")
def scrub_kinds(spark, sf_dir):
    """Free text of spans, logs and statements."""
    def kind(name, df, key, text):
        return scrubbing.scrub_kind(df, name).select(
            F.lit(name).alias("kind"), F.col(key).cast("string").alias("id"), F.col(text).alias("text"))

    return (kind("spans", t.SPANS.frame(spark, sf_dir), "span_id", "description")
            .unionByName(kind("logs", t.LOGS.frame(spark, sf_dir), "log_id", "message"))
            .unionByName(kind("db_queries", t.STATEMENTS.frame(spark, sf_dir), "statement_id", "error_message")))
