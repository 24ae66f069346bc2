"""Exact input and output of the rules, one value at a time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import records as rec, scrub, trace_context as tc

TRACE, SPAN = "a" * 32, "b" * 16
R = fixed.REDACTED


def one(spark, fn, *values, kinds=None):
    """The value of an expression over one row of columns v0, v1, ..."""
    kinds = kinds or ["string"] * len(values)
    schema = ", ".join(f"v{i} {k}" for i, k in enumerate(kinds))
    df = spark.createDataFrame([tuple(values)], schema)
    return df.select(fn(*[F.col(c) for c in df.columns]).alias("out")).first().out


@pytest.mark.parametrize("text, want", [
    ("card 4111111111111111 used", f"card {R}used"),
    ("pay 4111 1111 1111 1111 ok", f"pay {R}ok"),
    ("a 4111-1111-1111-1111.", f"a {R}."),
    ("order 1234567890123456 shipped", "order 1234567890123456 shipped"),
    ("id 123456789012", "id 123456789012"),
    ("ts 20240517120000123", "ts 20240517120000123"),
    ("4111111111111111 42", R),  # the short number is absorbed into the run, whose sum happens to be right
    ("ssn 123-45-6789 on file", f"ssn {R} on file"),
    ("ref 123456789 ok", "ref 123456789 ok"),
    ("contact alice@example.com", f"contact {R}"),
    ("from 192.168.1.10 ok", f"from {R} ok"),
    ("version 1.2.999.4", "version 1.2.999.4"),
    ("Authorization: Bearer should_not_leak eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjMifQ.signature", f"Authorization: {R} {R}"),
    ("é4111111111111111", "é4111111111111111"),
    ("4111111111111111 é", f"{R}é"),
    ("", ""), (None, None),
    ("x" * 40_000 + " alice@example.com", "x" * 40_000 + " [REDACTED]"),
    ("x" * 30_000 + " alice@example.com", "x" * 30_000 + f" {R}"),
])
def test_scrub_text(spark, text, want):
    assert one(spark, scrub.scrub_text, text) == want
    if text is not None:
        assert scrub._scrub_str(text, False) == want  # the form used inside JSON documents


def test_scrub_text_with_pii(spark):
    text = "alice@example.com 192.168.1.10 123-45-6789 Bearer abc"
    assert one(spark, lambda c: scrub.scrub_text(c, True), text) == f"alice@example.com 192.168.1.10 {R} {R}"


@pytest.mark.parametrize("document, want", [
    ('{"user":{"email":"a@b.co","password":"x"},"note":"a@b.co"}',
     '{"user":{"email":"a@b.co","password":"%s"},"note":"%s"}' % (R, R)),
    ('{"Api_Key":1,"list":[{"jwt":null},"1.2.3.4"],"n":1.5}', '{"Api_Key":"%s","list":[{"jwt":"%s"},"%s"],"n":1.5}' % (R, R, R)),
    ('{"x-acme-key":"v","custom_pii":"v","release":"1.2.3.4"}', '{"x-acme-key":"%s","custom_pii":"%s","release":"1.2.3.4"}' % (R, R)),
    ("not json", "not json"), (None, None),
])
def test_scrub_json(spark, document, want):
    assert one(spark, lambda c: scrub.scrub_json(c, extra=["custom_pii"], vendor="acme"), document) == want


@pytest.mark.parametrize("header, want", [
    (f"00-{TRACE}-{SPAN}-01", (TRACE, SPAN, True)), (f"00-{TRACE}-{SPAN}-00", (TRACE, SPAN, False)),
    (f" 00-{TRACE.upper()}-{SPAN}-03 tail", (TRACE, SPAN, True)),
    (f"01-{TRACE}-{SPAN}-01", None), (f"00-{TRACE}-{'0' * 16}-01", None), (f"00-{'0' * 32}-{SPAN}-01", None),
    (f"00-{'g' * 32}-{SPAN}-01", None), (f"00-{TRACE}-{'b' * 32}-01", None), (f"00-{TRACE}-{SPAN}-01x", None), (None, None),
])
def test_traceparent(spark, header, want):
    got = one(spark, tc.parse_traceparent, header)
    assert (tuple(got) if got else None) == want


def test_baggage(spark):
    got = one(spark, lambda c: tc.baggage_members(c, "acme"), "vendor=value, acme-trace_id=old, acme-span_id=old,")
    assert got.preserved == "vendor=value" and got.own == {"trace_id": "old", "span_id": "old"}


@pytest.mark.parametrize("text, want", [
    ("SELECT * FROM t WHERE a = 'it''s' AND b=-5", "SELECT * FROM t WHERE a = ?? AND b=-?"),
    ("  select\n x1, 1.50 , \"q\" ", 'select x1, ? , "q"'),
])
def test_normalize_query(spark, text, want):
    assert one(spark, rec.normalize_query, text) == want


@pytest.mark.parametrize("text, want", [
    (" insert into t", "INSERT"), ("WITH x AS (SELECT 1)", "OTHER"), ("SELECT(1)", "OTHER"), ("  ", "OTHER"), ("", "OTHER")])
def test_query_type(spark, text, want):
    assert one(spark, rec.detect_query_type, text) == want


AT = dt.datetime(2026, 1, 1, 12, 0, 0)


@pytest.mark.parametrize("value, want", [
    ("2", 2.0), ("Thu, 01 Jan 2026 12:00:42 GMT", 42.0), ("Thu, 01 Jan 2026 11:59:00 GMT", 0.0), (None, 0.0), ("", 0.0),
    ("   ", 0.0), ("soon", 0.0), ("12abc", 0.0), ("-5", 0.0), ("999", 300.0), ("Thu, 01 Jan 2026 13:00:00 GMT", 300.0)])
def test_retry_after(spark, value, want):
    assert one(spark, rec.retry_after_seconds, value, AT, kinds=["string", "timestamp"]) == want


@pytest.mark.parametrize("path, want", [
    ("/a/b?token=1", "/a/b"), ("?token=1", "?token=1"), ("https://h.example/x/y?z#f", "/x/y"), ("/p#frag", "/p"), ("", "")])
def test_strip_query(spark, path, want):
    assert one(spark, rec.strip_query, path) == want


@pytest.mark.parametrize("url, host, path", [
    ("https://u:p@h.example:8443/x?q=1", "u:p@h.example:8443", "/x"), ("https://h.example", "h.example", "/"),
    ("plain/path", "plain/path", "plain/path")])
def test_url_parts(spark, url, host, path):
    assert one(spark, rec.url_host, url) == host and one(spark, rec.url_path, url) == path


@pytest.mark.parametrize("level, handled, want", [
    ("error", None, "error"), ("fatal", True, "crash"), ("warning", True, None), (None, True, "error"), ("info", False, "crash")])
def test_session_mark(spark, level, handled, want):
    assert one(spark, rec.session_mark_of, level, handled, kinds=["string", "boolean"]) == want


def test_frames(spark):
    text = 'Traceback:\n  File "/app/a.py", line 3, in go\n    run()\n\n  File "<string>", line 1, in <module>\n' \
           '  File "/usr/lib/site-packages/x.py", line 9, in y\n'
    frames = one(spark, rec.traceback_frames, text)
    assert [(f.filename, f.function, f.lineno, f.inApp) for f in frames] == [
        ("/app/a.py", "go", 3, True), ("<string>", "<module>", 1, False), ("/usr/lib/site-packages/x.py", "y", 9, False)]
    assert len(one(spark, rec.traceback_lines, text)) == 5
