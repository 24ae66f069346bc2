"""Intake, duplicates, rates, traces and correlation, on Spark's own streaming operators."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from beaconry import schemas
from beaconry.functions.scrub import scrub_json
from beaconry.operators import normalize, wire
from beaconry.sources import envelopes as env
from beaconry.streaming.run import to_batches, write_batch


def ingest_writer(out: str, kinds: list[str] | None = None, vendor: str | None = None,
                  send_default_pii: bool = False) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step: envelopes scrubbed, routed, unrolled, validated and written, one folder per kind.

    All kinds unless ``kinds`` names some. Rejected rows get a folder of their own, with the reason; so do, under
    ``rejected_envelopes``, documents that are no envelopes and envelopes of a path that no kind of these has. Payloads are
    parsed and scrubbed natively by their kind's schema; see ``route_scrubbed`` for the few that are not. The batch is read
    once per kind, so it is persisted. Kinds are written side by side: a spool's files hold mostly one kind each, so that one
    kind keeps only the tasks of its files busy.
    """
    kinds = list(schemas.KINDS) if kinds is None else kinds
    paths = [schemas.KINDS[kind][0] for kind in kinds]

    def write(batch: DataFrame, batch_id: int) -> None:
        if "rejected" not in batch.columns:
            batch = batch.withColumns({"rejected": F.lit(None).cast("string"), "value": F.lit(None).cast("string")})
        known = F.col("rejected").isNull() & F.col("path").isin(paths)
        batch = batch.persist()

        def write_kind(kind: str) -> None:
            rows = env.route_scrubbed(batch, kind, vendor, send_default_pii)
            if schemas.KINDS[kind][2]:
                rows = env.explode_batch(rows, kind)
            rows = rows.toDF(*[wire.snake(c) for c in rows.columns])
            check = {"errors": normalize.validate_errors, "logs": normalize.validate_logs,
                     "http_requests": normalize.validate_http_items,
                     "heartbeats": normalize.validate_heartbeats}.get(kind)
            if check is None:
                write_batch(rows, f"{out}/{kind}", batch_id)
                return
            checked = check(rows).persist()  # scrubbed once for both tables
            try:
                write_batch(normalize.valid(checked), f"{out}/{kind}", batch_id)
                write_batch(normalize.rejected(checked), f"{out}/rejected_{kind}", batch_id)
            finally:
                checked.unpersist()

        def write_strange() -> None:
            scrubbed = {c: scrub_json(F.col(c), vendor=vendor, send_default_pii=send_default_pii, keep=["sessionId"]) for c in ("payload", "value")}
            strange = batch.where(~F.coalesce(known, F.lit(False))).withColumns(scrubbed).select(
                "path", "payload", "ts", "value",
                F.coalesce("rejected", F.lit("kind")).alias("rejected"))
            write_batch(strange, f"{out}/rejected_envelopes", batch_id)

        try:
            batch.count()  # so that no kind waits for what another reads
            with ThreadPool(len(kinds) + 1) as pool:
                started = [pool.apply_async(inheritable_thread_target(write_kind), (kind,)) for kind in kinds]
                started.append(pool.apply_async(inheritable_thread_target(write_strange)))
                pool.close()
                pool.join()
            for each in started:
                each.get()
        finally:
            batch.unpersist()

    return write


def stream_ingest(envelopes: DataFrame, out: str, checkpoint: str, kinds: list[str] | None = None,
                  vendor: str | None = None, every: str | None = None):
    return to_batches(envelopes, ingest_writer(out, kinds, vendor), checkpoint, every=every)


def stream_dedupe(df: DataFrame, at: str, keys: list[str], delay: str) -> DataFrame:
    """Each key once, whatever a spool sends again within ``delay``."""
    return df.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def stream_traces(spans: DataFrame, delay: str, gap: str = "30 seconds") -> DataFrame:
    """Traces assembled from spans; a trace closes ``gap`` after its latest span. Reads at, trace_id, status, end_ms,
    start_ms."""
    return (
        spans.withWatermark("at", delay).groupBy(F.session_window("at", gap).alias("w"), "trace_id").agg(
            F.count(F.lit(1)).alias("spans"), F.count_if(F.col("status") == "error").alias("error_spans"),
            (F.max("end_ms") - F.min("start_ms")).alias("wall_ms"))
        .select("trace_id", F.unix_millis("w.start").alias("from_ms"), "spans", "error_spans", "wall_ms")
    )


def stream_rates(requests: DataFrame, delay: str, size: str = "1 minute", slide: str | None = None) -> DataFrame:
    """Requests and failures per service and window, tumbling or sliding. Reads at, service, failed."""
    window = F.window("at", size, slide) if slide else F.window("at", size)
    return (
        requests.withWatermark("at", delay).groupBy(window.alias("w"), "service").agg(
            F.count(F.lit(1)).alias("requests"), F.count_if("failed").alias("failed"))
        .select(F.unix_millis("w.start").alias("from_ms"), "service", "requests", "failed")
    )


def stream_correlate(requests: DataFrame, errors: DataFrame, delay: str, within: str) -> DataFrame:
    """Errors joined to their request within an interval. Both have request_id; requests at, errors error_at."""
    left = requests.withWatermark("at", delay)
    right = errors.withWatermark("error_at", delay).withColumnRenamed("request_id", "error_request_id")
    near = F.expr(f"request_id = error_request_id AND error_at >= at AND error_at <= at + interval {within}")
    return left.join(right, near).drop("error_request_id")
