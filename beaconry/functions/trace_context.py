"""Trace identifiers and propagation headers as they appear in an access log."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry.fixed_values import TRACEPARENT


def _hex_id(value: Column, width: int) -> Column:
    cleaned = F.lower(F.trim(value))
    return F.when(cleaned.rlike(f"^[0-9a-f]{{{width}}}$") & (cleaned != F.lit("0" * width)), cleaned)


def normalize_trace_id(value: Column) -> Column:
    """32 lower-case hex digits, not all zero; anything else is null."""
    return _hex_id(value, 32)


def normalize_span_id(value: Column) -> Column:
    """16 lower-case hex digits, not all zero; anything else is null."""
    return _hex_id(value, 16)


def parse_traceparent(header: Column) -> Column:
    """struct<trace_id, parent_span_id, sampled> of a valid version-00 header, else null."""
    text = F.lower(F.trim(header))
    version, flags = F.regexp_extract(text, TRACEPARENT, 1), F.regexp_extract(text, TRACEPARENT, 4)
    trace_id = normalize_trace_id(F.regexp_extract(text, TRACEPARENT, 2))
    span_id = normalize_span_id(F.regexp_extract(text, TRACEPARENT, 3))
    odd = F.substring(flags, 2, 1).isin(list("13579bdf"))
    return F.when((version == "00") & trace_id.isNotNull() & span_id.isNotNull(),
                  F.struct(trace_id.alias("trace_id"), span_id.alias("parent_span_id"), odd.alias("sampled")))


def lenient_trace_id(traceparent: Column, own_header: Column, generic_header: Column) -> Column:
    """The second dash-separated part if it is 32 long, whatever its characters; else the two plain headers."""
    second = F.get(F.split(traceparent, "-"), F.lit(1))
    return F.coalesce(F.when(F.length(second) == 32, second), F.nullif(own_header, F.lit("")),
                      F.nullif(generic_header, F.lit("")))


def baggage_members(header: Column, vendor: str) -> Column:
    """struct<own, preserved>: the vendor's own members as a map and the others in order, blanks dropped."""
    prefix = f"{vendor.lower()}-"
    members = F.filter(F.transform(F.split(header, ","), lambda m: F.trim(m)), lambda m: m != "")
    own = F.filter(members, lambda m: F.startswith(F.lower(m), F.lit(prefix)))
    others = F.filter(members, lambda m: ~F.startswith(F.lower(m), F.lit(prefix)))
    entries = F.transform(own, lambda m: F.struct(
        F.lower(F.substring_index(F.substr(m, F.lit(len(prefix) + 1)), "=", 1)).alias("key"),
        F.when(m.contains("="), F.regexp_replace(m, "^[^=]*=", "")).alias("value")))
    # of members that name one key the last counts
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.struct(F.map_from_entries(last).alias("own"), F.array_join(others, ",").alias("preserved"))


def sampling_unit(key: Column) -> Column:
    """A number in [0, 1) that depends on the key only, so that retries and streams decide alike."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
