"""Delivery: retention, batching, attempt logs and what became of every payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from beaconry import fixed_values as fixed
from beaconry.functions import records as rec
from beaconry.operators.hot_keys import HOT, KEY, SLOT, SLOT_ROWS, newest, numbered, placed
from beaconry.operators.wire import wire_item
from beaconry.schemas import KINDS


def persistable(envelopes: DataFrame) -> DataFrame:
    """Only the paths that are safe to replay after a restart."""
    return envelopes.where(F.col("path").isin(fixed.PERSISTABLE_PATHS))


def retention(entries: DataFrame, now_ms: Column, max_events: int = fixed.SPOOL_MAX_EVENTS,
              max_bytes: int = fixed.SPOOL_MAX_BYTES, max_age_s: float = fixed.SPOOL_MAX_AGE_SECONDS,
              by: str = "spool_id") -> DataFrame:
    """Reads the ``by`` key, ts_ms, seq, bytes. Drops by age, then the oldest over the count, then over the bytes.

    Dropping the oldest until the sum fits leaves the longest newest run within the cap, which is a running sum.
    """
    max_events, max_bytes, max_age_s = max(1, int(max_events)), max(1024, int(max_bytes)), max(0.0, float(max_age_s))
    young = entries.where(now_ms - F.col("ts_ms") <= max_age_s * 1000) if max_age_s > 0 else entries
    kept = newest(young, [by], ["ts_ms", "seq"], max_events)
    newest_first = Window.partitionBy(by).orderBy(F.col("ts_ms").desc(), F.col("seq").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return kept.withColumn("_sum", F.sum("bytes").over(newest_first)).where(F.col("_sum") <= max_bytes).drop("_sum")


def newest_n(items: DataFrame, by: list[str], order: list[str], n: int = fixed.BUFFER_SIZE) -> DataFrame:
    """What a full buffer keeps: the newest ``n`` items per key."""
    return newest(items, by, order, n)


def evictions(items: DataFrame, by: list[str], n: int = fixed.BUFFER_SIZE) -> DataFrame:
    """Per key, how many items a buffer of ``n`` evicts."""
    return items.groupBy(*by).agg(F.greatest(F.count(F.lit(1)) - F.lit(n), F.lit(0)).alias("evicted"))


def drain_order(entries: DataFrame) -> DataFrame:
    """Oldest first; a range-partitioned sort."""
    return entries.orderBy("ts_ms", "seq")


def chunk_numbers(items: DataFrame, flush_key: list[str], order: list[str], size: int = fixed.MAX_BATCH,
                  slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Adds chunk (from 0) and position in the chunk (from 1) for every item of a flush."""
    placed = numbered(items, flush_key, order, "_position", slot_rows)
    return (placed.withColumn("chunk", F.floor((F.col("_position") - 1) / size).cast("bigint"))
            .withColumn("position", (F.col("_position") - 1) % size + 1).drop("_position"))


def chunk_batches(items: DataFrame, flush_key: list[str], order: list[str], item: Column, field: str,
                  size: int = fixed.MAX_BATCH, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Wire bodies of at most ``size`` items per flush, each an array column named ``field``.

    A body that lies within a slot is gathered where its items are numbered; only those over a border of slots shuffle again.
    """
    rows = placed(items, flush_key, order, "_position", slot_rows)
    chunk = F.floor((F.col("_position") - 1) / size).cast("bigint")
    chunks = rows.withColumns({"chunk": chunk, "position": (F.col("_position") - 1) % size + 1})
    listed = F.sort_array(F.collect_list(F.struct("position", item.alias("item"))))
    bodies = F.transform(listed, lambda x: x["item"]).alias(field)
    before = F.coalesce(F.col("_before"), F.lit(0))
    inside = ~F.coalesce(F.col(HOT), F.lit(False)) | (F.col("chunk") * size >= before) & ((F.col("chunk") + 1) * size <= before + F.col("_n"))
    whole = chunks.where(inside).groupBy(KEY, SLOT, *flush_key, "chunk").agg(bodies).drop(KEY, SLOT)
    return whole.unionByName(chunks.where(~inside).groupBy(*flush_key, "chunk").agg(bodies))


# Items per wire body and kind. Spans go out whole, a flush holding at most what the buffer does; logs one by one.
BODY_ITEMS = {"http_requests": fixed.MAX_BATCH, "db_queries": fixed.MAX_BATCH, "spans": fixed.BUFFER_SIZE,
              "replay_events": fixed.BUFFER_SIZE, "logs": 1}


def flush_bodies(items: DataFrame, kind: str, flush_key: list[str], order: list[str],
                 slot_rows: int = SLOT_ROWS) -> DataFrame:
    """The wire bodies of a flush of one kind; ``field`` is the name of their array."""
    field = KINDS[kind][2] or "items"
    return chunk_batches(items, flush_key, order, wire_item(items, kind), field, BODY_ITEMS[kind], slot_rows)


def validate_batches(batches: DataFrame, field: str) -> DataFrame:
    """Adds ``rejected``: a batch holds 1 to 100 items."""
    return batches.withColumn("rejected", F.when(
        ~F.coalesce(F.size(field).between(1, fixed.MAX_BATCH), F.lit(False)), "batch_size"))


def _first_auth_stop(attempts: DataFrame, by: str, order: Column) -> DataFrame:
    return attempts.where(F.col("status") == 401).groupBy(by).agg(F.min(order).alias("_stop"))


def replay_outcomes(log: DataFrame) -> DataFrame:
    """Reads spool_id, ts_ms, seq, corrupt, status: what a drain did with every entry.

    Corrupt entries go uncounted; accepted and refused ones are removed; the rest is kept. The first 401 stops the
    drain: it and everything after it stay.
    """
    order = F.struct("ts_ms", "seq")
    sound = log.where(~F.col("corrupt"))
    stops = _first_auth_stop(sound, "spool_id", order)
    at_or_after = F.coalesce(order >= F.col("_stop"), F.lit(False))
    outcome = (F.when(at_or_after, "kept_stopped").when(F.col("corrupt"), "discarded")
               .when(rec.spool_terminal(F.col("status")), "removed").otherwise("kept"))
    return log.join(stops, "spool_id", "left").withColumn("outcome", outcome).drop("_stop")


def delivery_outcome(attempts: DataFrame) -> DataFrame:
    """One row per payload of an attempt log, with what became of it.

    Reads client_id, event_id, path, ts_ms, attempt (1..5), status (0: network error), is_drain and, where logged,
    raw_bytes and wire_bytes. A 401 ends the client: payloads first tried after it are dropped untried. A payload whose
    last attempt may be repeated, and has attempts left, is pending.
    """
    # path and is_drain are one per post, so they can be grouping keys; what is left to fold is plain numbers
    sizes = [F.max(c).alias(c) for c in ("raw_bytes", "wire_bytes") if c in attempts.columns]
    folded = attempts.groupBy("client_id", "event_id", "path", "is_drain").agg(
        *sizes,
        F.max_by("status", "attempt").alias("status"),
        F.max("attempt").alias("attempts"),
        F.min("ts_ms").alias("ts_ms"),
        F.sum((F.col("status") == 429).cast("bigint")).alias("rate_limited"))
    order = F.struct("ts_ms", "event_id")
    stops = _first_auth_stop(attempts, "client_id", order)
    kind = rec.status_class(F.col("status"))
    untried = F.coalesce(order > F.col("_stop"), F.lit(False))
    exhausted = F.when(F.col("path").isin(fixed.PERSISTABLE_PATHS) & ~F.col("is_drain"), "persisted").when(
        F.col("is_drain"), "kept").otherwise("dropped")
    outcome = (F.when(untried, "dropped_disabled").when(kind == "auth_stop", "auth_stopped")
               .when(kind == "rejected", "rejected").when(kind == "sent", "sent")
               .when(F.col("attempts") < fixed.MAX_ATTEMPTS, "pending").otherwise(exhausted))
    return folded.join(stops, "client_id", "left").withColumn("outcome", outcome).drop("_stop")


def diagnostics(outcomes: DataFrame, buffer_evictions: DataFrame | None = None) -> DataFrame:
    """The delivery counters per client, from ``delivery_outcome`` and optionally (client_id, evicted)."""
    live, o = ~F.col("is_drain"), F.col("outcome")
    tried = o != "dropped_disabled"

    def total(condition: Column, amount: Column | None = None) -> Column:
        return F.sum(F.when(condition, F.lit(1) if amount is None else amount).otherwise(0)).cast("bigint")

    saved = F.col("raw_bytes") - F.col("wire_bytes")
    compression = [
        total(tried & (saved > 0)).alias("compressed"), total(tried & ~(saved > 0)).alias("uncompressed"),
        total(tried & (saved > 0), saved).alias("bytes_saved"),
    ] if {"raw_bytes", "wire_bytes"} <= set(outcomes.columns) else []
    counted = outcomes.groupBy("client_id").agg(
        *compression,
        total(live).alias("captured"),
        total(o == "sent").alias("sent"),
        total(o.isin("auth_stopped", "rejected", "persisted", "kept", "dropped")).alias("failed"),
        total((o == "rejected") | (o.isin("auth_stopped", "dropped", "dropped_disabled") & live)).alias("dropped"),
        total(o == "persisted").alias("persisted"),
        total((o == "sent") & F.col("is_drain")).alias("replayed"),
        total(tried, F.col("attempts") - 1).alias("retry_attempts"),
        total(tried, F.col("rate_limited")).alias("rate_limited"))
    if buffer_evictions is None:
        return counted.withColumn("buffer_dropped", F.lit(0).cast("bigint"))
    return (
        counted.join(buffer_evictions.groupBy("client_id").agg(F.sum("evicted").alias("_evicted")), "client_id",
                     "left")
        .withColumn("buffer_dropped", F.coalesce("_evicted", F.lit(0)))
        .withColumn("dropped", F.col("dropped") + F.col("buffer_dropped"))
        .drop("_evicted")
    )


def retry_delay_report(attempts: DataFrame) -> DataFrame:
    """Per path: attempts, rate-limited attempts and the seconds the contract asks to wait (jitter left out).

    Reads path, attempt, status, retry_after and at (timestamp of the response). Nothing follows the last attempt or
    an attempt that settled the payload.
    """
    asked = F.when(F.col("status").isin(429, 503), rec.retry_after_seconds(F.col("retry_after"), F.col("at")))
    backoff = F.element_at(F.array(*[F.lit(float(s)) for s in fixed.BACKOFF_SECONDS]),
                           F.least(F.col("attempt"), F.lit(len(fixed.BACKOFF_SECONDS))).cast("int"))
    retried = rec.status_class(F.col("status")).isin("retry", "retry_after") & (
        F.col("attempt") < fixed.MAX_ATTEMPTS)
    wait = F.when(retried, F.when(asked > 0, asked).otherwise(backoff)).otherwise(0.0)
    return attempts.groupBy("path").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum((F.col("status") == 429).cast("bigint")).alias("rate_limited"),
        F.sum(wait).alias("wait_seconds"))


def payload_sizes(wire: DataFrame) -> DataFrame:
    """Reads kind, body (JSON text): bytes per kind and the share of bodies that reach the compression threshold."""
    size = F.octet_length("body").cast("bigint")
    big = (size >= fixed.COMPRESSION_THRESHOLD_BYTES).cast("bigint")
    return wire.groupBy("kind").agg(
        F.count(F.lit(1)).alias("payloads"), F.sum(size).alias("bytes"), F.sum(big).alias("compressible"),
        (F.sum(big) / F.count(F.lit(1))).alias("compressible_share"))
