"""Telemetry of all kinds clustered by trace: a lookup by trace ids opens the few files that hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ORDER = ["trace_id", "ts_ms", "kind"]


def write_trace_store(timeline: DataFrame, folder: str, parts: int | None = None) -> None:
    """Write rows of all kinds (trace_id, ts_ms, kind, anything else) range-clustered by trace and time.

    ``folder``/rows has one folder per range, sorted within; ``folder``/ranges has a row per range with its first and last
    trace; ``folder``/columns has the columns. Borders are sampled, on trace and time together, so a trace of any size spreads over several ranges. That is the
    one sort the store costs; lookups sort nothing but what they return. ``parts`` defaults to the session's number of
    shuffle partitions: take about as many as the table has blocks. Rows without a trace are kept, in the first ranges.
    """
    spark = timeline.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = timeline.repartitionByRange(parts, *ORDER).withColumn("part", F.spark_partition_id())
    placed.sortWithinPartitions("part", *ORDER).write.partitionBy("part").parquet(f"{folder}/rows")
    spark.createDataFrame([], timeline.schema).write.parquet(f"{folder}/columns")  # what an empty store has too
    rows = spark.read.schema(placed.schema).parquet(f"{folder}/rows")
    rows.groupBy("part").agg(F.min("trace_id").alias("first"), F.max("trace_id").alias("last"), F.count(F.lit(1)).alias("rows")).coalesce(1).write.parquet(
        f"{folder}/ranges")


def parts_of(spark: SparkSession, folder: str, trace_ids: list[str]) -> list[int]:
    """The ranges that may hold any of these traces."""
    if not trace_ids:
        return []
    inside = F.exists(F.array(*map(F.lit, trace_ids)), lambda trace: (F.col("first") <= trace) & (trace <= F.col("last")))
    return sorted(r.part for r in spark.read.parquet(f"{folder}/ranges").where(inside).select("part").collect())


def timeline(spark: SparkSession, folder: str, trace_ids: list[str]) -> DataFrame:
    """All rows of some traces, in order within each partition of the result: by part, trace and time.

    Only the folders of ranges that may hold the traces are listed and read, and of their row groups only those whose
    statistics allow one of the ids. ``part`` ascends with trace and time, so ordering by it and the keys is the order of
    the whole.
    """
    rows = f"{folder}/rows"
    parts = parts_of(spark, folder, trace_ids)
    schema = spark.read.parquet(f"{folder}/columns").schema.add("part", "integer")
    if not parts:
        return spark.createDataFrame([], schema)
    held = spark.read.schema(schema).option("basePath", rows).parquet(*[f"{rows}/part={part}" for part in parts])
    return held.where(F.col("trace_id").isin(trace_ids)).sortWithinPartitions("part", *ORDER)
