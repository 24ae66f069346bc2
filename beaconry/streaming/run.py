"""Starting streams: settings, sinks that survive a repeated batch, and running one to the end of its input."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from beaconry.session import tune

INTAKE = str(1 << 30)  # bytes
INTAKE_PACKED = str(1 << 27)  # bytes of gzipped JSON, which are about as much when unpacked
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # a count of the state's rows costs a read before every write; it only feeds progress reports
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # session windows merge inside a task before they shuffle, so a hot trace shuffles few rows
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tune_streams(spark: SparkSession) -> SparkSession:
    for key, value in STREAM_CONF.items():
        spark.conf.set(key, value)
    return tune(spark)


def stream_table(spark: SparkSession, folder: str, pattern: str, schema_of: str, **options: str) -> DataFrame:
    """The parquet files of a folder as a stream; the schema comes from what is there.

    A micro-batch takes ``INTAKE`` bytes of them unless the options set another limit; what keyed state must sort is a key's
    share of that.
    """
    schema = tune_streams(spark).read.parquet(schema_of).schema
    if not {"maxFilesPerTrigger", "maxBytesPerTrigger"} & set(options):
        options["maxBytesPerTrigger"] = INTAKE
    return spark.readStream.schema(schema).options(pathGlobFilter=pattern, **options).parquet(folder)


def to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet table. Without ``every`` it stops at the end of the input it finds."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (df.writeStream.format("parquet").outputMode(mode).option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def to_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
               every: str | None = None) -> StreamingQuery:
    """Hand every micro-batch to ``write(batch, batch_id)``, which must give the same result when repeated."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """Replace one batch's folder: a batch that runs again after a failure leaves no second copy."""
    df.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def until_read(query: StreamingQuery, rows: int, patience_s: float = 600) -> None:
    """Wait until a running stream has taken in ``rows`` rows, then stop it.

    For streams on timers of the processing time: these always have another batch ahead and never come to an end.
    """
    read, until = {}, time.monotonic() + patience_s
    while sum(read.values()) < rows:
        if not query.isActive:
            query.awaitTermination()  # raises what ended it
            return
        if time.monotonic() > until:
            query.stop()
            raise TimeoutError(f"{sum(read.values())} of {rows} rows were read in {patience_s} s")
        read |= {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"]}
        time.sleep(0.2)
    query.stop()
