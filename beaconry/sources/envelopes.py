"""Envelopes ``{path, payload, ts}`` and spool folders, for batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from beaconry import fixed_values as fixed, schemas
from beaconry.functions.scrub import holds_documents, may_hold_documents, scrub_json, scrub_typed

_SPOOL_NAME = r"(\d{13})-(\d{8})-([^/]*)\.json"


def read_envelopes(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Spool documents as rows: path, payload (JSON text), ts, seq, file.

    One document a file or one a line. The order columns come from the file name where it carries them. Documents that
    are no envelopes stay, with the reason in ``rejected`` and their text in ``value``; ``normalize.valid`` leaves them out.
    ``options`` are those of Spark's text source, such as the limits of a stream's micro-batch.
    """
    reader = spark.readStream if stream else spark.read
    lines = reader.options(**{"recursiveFileLookup": "true", **options}).text(path)
    return parse_envelopes(lines.select("value", F.col("_metadata.file_path").alias("file")))


def parse_envelopes(lines: DataFrame) -> DataFrame:
    """Reads value (the JSON text of one envelope) and file; adds ``rejected``, null for an envelope.

    An object is what can be cast to a struct, be it one without fields; a variant's whole schema would cost more than its parsing.
    """
    document = F.try_parse_json("value")
    name = F.element_at(F.split("file", "/"), -1)
    parsed = lines.select(
        "value", "file",
        F.try_variant_get(document, "$", "struct<>").isNotNull().alias("_is_object"),
        F.try_variant_get(document, "$.path", "string").alias("path"),
        F.schema_of_variant(F.try_variant_get(document, "$.path", "variant")).alias("_path_type"),
        F.try_variant_get(document, "$.payload", "struct<>").isNotNull().alias("_has_payload"),
        F.get_json_object("value", "$.payload").alias("payload"),
        F.try_variant_get(document, "$.ts", "bigint").alias("ts"))
    checks = ((F.col("_is_object"), "document"), (F.col("_path_type") == "STRING", "path"), (F.col("_has_payload"), "payload"))
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), why) for ok, why in checks])
    sound = reason.isNull()
    return parsed.select(
        *[F.when(sound, F.col(c)).alias(c) for c in ("path", "payload", "ts")],
        F.nullif(F.regexp_extract(name, _SPOOL_NAME, 2), F.lit("")).try_cast("bigint").alias("seq"), "file",
        F.when(~sound, F.col("value")).alias("value"), reason.alias("rejected"))


def route(envelopes: DataFrame, kind: str) -> DataFrame:
    """The typed payloads of one kind, with the envelope's ts. A batch kind keeps its array; see explode_batch."""
    path, ddl, _ = schemas.KINDS[kind]
    return envelopes.where(F.col("path") == path).select(
        "ts", F.from_json("payload", ddl).alias("body")).select("ts", "body.*")


def route_scrubbed(envelopes: DataFrame, kind: str, vendor: str | None = None, send_default_pii: bool = False,
                   keep: tuple[str, ...] = ("sessionId",)) -> DataFrame:
    """``route`` with both scrubbing layers applied to the payloads.

    Payloads are parsed by the kind's schema and scrubbed by native expressions along it. Only those that hold, in a free
    member such as metadata, a nested document with something to redact are scrubbed as JSON of unknown shape in Python.
    A filter on the parsed body would be moved below the parsing and parse once for every field it mentions; it is not moved
    below an ``explode``.
    """
    path, ddl, batch = schemas.KINDS[kind]
    body, suspect = F.from_json("payload", ddl), may_hold_documents(F.col("payload"), batch is not None)
    typed = envelopes.where(F.col("path") == path).select("ts", "payload", F.explode(F.array(body)).alias("body"))
    shape = typed.schema["body"].dataType
    options = {"vendor": vendor, "send_default_pii": send_default_pii}
    free = holds_documents(F.col("body"), shape, **options)
    easy = typed.where(~(suspect & free)).select("ts", scrub_typed(F.col("body"), shape, keep=keep, **options).alias("body"))
    nested = typed.where(suspect & free).select("ts", F.from_json(scrub_json(F.col("payload"), keep=keep, tested=True, **options), ddl).alias("body"))
    return easy.unionByName(nested).select("ts", "body.*")


def explode_batch(bodies: DataFrame, kind: str) -> DataFrame:
    """One row per item of a batch body; columns beside the batch (a replay's fingerprint and session) stay."""
    field = schemas.KINDS[kind][2]
    others = [c for c in bodies.columns if c != field]
    return bodies.select(*others, F.inline(field))


def to_envelopes(bodies: DataFrame, kind: str, payload: Column, ts: Column) -> DataFrame:
    """Rows as envelopes of one kind; ``payload`` is JSON text."""
    return bodies.select(F.lit(schemas.KINDS[kind][0]).alias("path"), payload.alias("payload"), ts.alias("ts"))


def spoolable(envelopes: DataFrame, vendor: str | None = None, max_entry_bytes: int | None = None) -> DataFrame:
    """What may go to disk: replay-safe paths, keys redacted first.

    Adds value, the JSON text of the entry, bytes, its size, and rejected: ``entry_bytes`` for an entry over
    ``max_entry_bytes``, which the contract's clients set to ``fixed.SPOOL_ENTRY_MAX_BYTES``.
    """
    scrubbed = envelopes.where(F.col("path").isin(fixed.PERSISTABLE_PATHS)).withColumn(
        "payload", scrub_json(F.col("payload"), vendor=vendor, values=False))
    entry = F.concat(F.lit('{"path":'), F.to_json(F.col("path").cast("variant")), F.lit(',"payload":'),
                     F.col("payload"), F.lit(',"ts":'), F.col("ts").cast("string"), F.lit("}"))
    large = F.lit(False) if max_entry_bytes is None else F.col("bytes") > max_entry_bytes
    return (scrubbed.withColumn("value", entry).withColumn("bytes", F.octet_length("value").cast("bigint"))
            .withColumn("rejected", F.when(large, "entry_bytes")))


def write_spool(envelopes: DataFrame, folder: str, vendor: str | None = None, compression: str = "gzip",
                max_entry_bytes: int | None = None) -> None:
    """Append the entries as JSON lines, one entry a line, one folder per kind of path.

    With a size limit, entries over it go to ``folder``-rejected in the same form.
    """
    entries = spoolable(envelopes, vendor, max_entry_bytes)

    def append(rows: DataFrame, to: str) -> None:
        rows.select("value", F.element_at(F.split("path", "/"), -1).alias("kind")).write.mode("append").partitionBy(
            "kind").option("compression", compression).text(to)

    append(entries.where("rejected IS NULL"), folder)
    if max_entry_bytes is not None:
        append(entries.where("rejected IS NOT NULL"), f"{folder}-rejected")


def write_tables(df: DataFrame, folder: str, at_ms: str) -> None:
    """Append a typed table as parquet, partitioned by day so that readers prune."""
    df.withColumn("day", F.to_date(F.timestamp_millis(F.col(at_ms)))).write.mode("append").partitionBy("day").parquet(
        folder)


def register_releases(seen: DataFrame) -> DataFrame:
    """One registration per (version, environment); reads release, environment, commit_sha, branch, sdk_name,
    sdk_version, ts_ms. The earliest sighting gives the details."""
    known = seen.where(F.nullif("release", F.lit("")).isNotNull())
    first = F.min_by(F.struct("commit_sha", "branch", F.concat_ws("/", "sdk_name", "sdk_version").alias("author")),
                     F.struct("ts_ms", "event_id"))
    return (
        known.groupBy(F.col("release").alias("version"),
                      F.coalesce(F.nullif("environment", F.lit("")), F.lit("production")).alias("environment"))
        .agg(first.alias("r")).select("version", "environment", "r.*")
    )
