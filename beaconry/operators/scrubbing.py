"""Scrubbing whole records and the order of steps an error event goes through."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions import scrub
from beaconry.operators.normalize import flatten_mechanism
from beaconry.operators.sampling import sample_errors


def scrub_columns(df: DataFrame, columns: Iterable[str], extra: Iterable[str] = (), send_default_pii: bool = False,
                  vendor: str | None = None, keys: bool = True, values: bool = True) -> DataFrame:
    """Both layers over some columns: text is scanned, nested columns are walked by their schema.

    Typed correlation columns (session and trace ids) are not to be named here: the key rule would redact them.
    """
    out = df
    for name in columns:
        if keys:
            out = out.withColumn(name, scrub.redact_keys(F.col(name), out.schema[name].dataType, extra, vendor))
        if values:
            out = out.withColumn(name, scrub.scrub_values(F.col(name), out.schema[name].dataType, send_default_pii))
    return out


# Error columns that hold free text or free structure. ``user`` is only reached by the key rule and the ids,
# frames, release and SDK columns by neither, as the contract leaves them alone.
ERROR_TEXT = ("message", "exception_class", "environment")
ERROR_NESTED = ("metadata", "breadcrumbs", "request_context")


def sanitize_errors(df: DataFrame, extra: Iterable[str] = (), send_default_pii: bool = False,
                    vendor: str | None = None) -> DataFrame:
    """Both layers over an error table; its top-level session_id is a correlation key and stays."""
    present = [c for c in (*ERROR_TEXT, *ERROR_NESTED) if c in df.columns]
    out = scrub_columns(df, present, extra, send_default_pii, vendor)
    return scrub_columns(out, ["user"], extra, vendor=vendor, values=False) if "user" in df.columns else out


# Text and nested columns per kind that both layers cover. Before they were spooled, the wire form of the last
# three kinds used to go out unscrubbed; ``strict`` reproduces that.
SCRUBBED = {
    "logs": ("message", "service", "environment", "metadata"),
    "http_requests": ("method", "host", "error_fingerprint", "metadata"),
    "db_queries": ("normalized_query", "error_message", "database_name"),
    "replay_events": ("event_type", "event_data"),
    "spans": ("description", "tags", "data"),
    "heartbeats": ("slug", "message"),
    "session_starts": ("environment",),
}
_LIVE_UNSCRUBBED = ("spans", "heartbeats", "session_starts")


def scrub_kind(df: DataFrame, kind: str, extra: Iterable[str] = (), send_default_pii: bool = False,
               vendor: str | None = None, strict: bool = False) -> DataFrame:
    """Both layers over what a record kind holds of free text; see sanitize_errors for errors."""
    if kind == "errors":
        return sanitize_errors(df, extra, send_default_pii, vendor)
    if strict and kind in _LIVE_UNSCRUBBED:
        return df
    return scrub_columns(df, [c for c in SCRUBBED[kind] if c in df.columns], extra, send_default_pii, vendor)


def send_errors(df: DataFrame, rate: float, key: Column,
                before_send: Callable[[DataFrame], DataFrame] | None = None, extra: Iterable[str] = (),
                send_default_pii: bool = False, vendor: str | None = None) -> DataFrame:
    """Sample, sanitize, hook, flatten the mechanism, sanitize again so that no hook brings a secret back.

    ``before_send`` maps a DataFrame to a DataFrame; ``row_hook`` makes one from a function of one event.
    """
    out = sanitize_errors(sample_errors(df, rate, key), extra, send_default_pii, vendor)
    if before_send is not None:
        out = out.transform(before_send)
    return sanitize_errors(flatten_mechanism(out), extra, send_default_pii, vendor)


def row_hook(hook: Callable[[dict], dict | None], columns: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A before_send step from a function of one event (a dict of the text ``columns``).

    It may change the event or return None to drop it; if it raises, or returns what is no event of these columns, the
    event stays as it was. It runs in Arrow batches and needs nothing but its own rows.
    """
    def sound(event, fields: list[pa.Field]) -> bool:
        if not isinstance(event, dict):
            return False
        try:
            for field in fields:
                pa.array([event.get(field.name)], field.type)
        except (pa.ArrowException, TypeError, ValueError, OverflowError):
            return False
        return True

    def apply(df: DataFrame) -> DataFrame:
        def batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in incoming:
                kept, events = [], []
                fields = [batch.schema.field(c) for c in columns]
                for event in batch.select(columns).to_pylist():
                    try:
                        result = hook(dict(event))
                    except Exception:
                        result = event
                    if result is not None and not sound(result, fields):
                        result = event
                    kept.append(result is not None)
                    if result is not None:
                        events.append({c: result.get(c) for c in columns})
                out = batch.filter(pa.array(kept, pa.bool_()))
                for c in columns:
                    out = out.set_column(out.schema.get_field_index(c), out.schema.field(c),
                                         pa.array([event[c] for event in events], out.schema.field(c).type))
                yield out

        return df.mapInArrow(batches, df.schema)

    return apply


def scrub_task_args(df: DataFrame, vendor: str | None = None) -> DataFrame:
    """Reads args and kwargs (JSON text, null when absent): keys redacted, values left as they are."""
    return df.withColumn("args", scrub.scrub_json(F.col("args"), vendor=vendor, values=False)).withColumn(
        "kwargs", scrub.scrub_json(F.col("kwargs"), vendor=vendor, values=False))


def pii_audit(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """How many spans of ``text`` each rule replaces, per ``by`` columns; one pass, partial sums before the shuffle.

    The rules apply one after another, and each adds as many marks as it replaces spans.
    """
    staged = df.select(*by, F.col(text).alias("_before"))
    staged = staged.withColumn("_marks", scrub.redactions(F.col("_before")))
    for rule, mask in scrub.RULES.items():
        staged = (staged.withColumn("_before", mask(F.col("_before")))
                  .withColumn("_now", scrub.redactions(F.col("_before")))
                  .withColumn(rule, F.col("_now") - F.col("_marks"))
                  .withColumn("_marks", F.col("_now")))
    totals = staged.groupBy(*by).agg(*[F.sum(rule).alias(rule) for rule in scrub.RULES])
    return totals.unpivot(by, list(scrub.RULES), "rule", "redactions").where(F.col("redactions") > 0)
