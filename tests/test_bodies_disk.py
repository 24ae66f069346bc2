"""Bodies of hot keys: rows move once, and nothing but the borders of slots is written."""

import os

import pytest
from pyspark.sql import Window, functions as F

from beaconry.operators import delivery, hot_keys


@pytest.fixture(scope="module")
def items(spark):
    """5,000 rows, a third of one key, some without a time, all twice where the id is a multiple of 50."""
    rows = spark.range(5_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") * 7919 % 6007).alias("at"))
    return rows.unionByName(rows.where("id % 50 = 0")).cache()


@pytest.mark.parametrize("slot_rows", [90, 400, 10**6])
def test_bodies_over_slots(items, slot_rows):
    got = delivery.chunk_batches(items, ["key"], ["at", "id"], F.col("id"), "ids", size=25, slot_rows=slot_rows)
    position = F.row_number().over(Window.partitionBy("key").orderBy("at", "id"))
    plain = items.withColumn("n", position).groupBy("key", F.floor((F.col("n") - 1) / 25).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("n", "id"))).alias("found")).select("key", "chunk", F.col("found.id").alias("ids"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_only_borders_are_written(spark, items, tmp_path, monkeypatch):
    """A slot written as it is would be a copy of all rows beside those of the shuffles."""
    made = iter(range(9))
    monkeypatch.setattr(hot_keys, "scratch_dir", lambda _, label: str(tmp_path / f"{label}-{next(made)}"))
    rows = hot_keys.bordered(items, ["key"], ["at", "id"], 90)
    assert os.listdir(tmp_path) == ["borders-0"] and spark.read.parquet(str(tmp_path / "borders-0")).count() == 2  # hot, and rows without a key
    sizes = [r["count"] for r in rows.where("_hot").groupBy("_key", "_slot").count().collect()]
    assert sum(sizes) == items.where("key = 'hot' OR key IS NULL").count() and len(sizes) > 10
    plan = hot_keys.placed(items, ["key"], ["at", "id"], "n", 90)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and os.listdir(tmp_path / "borders-0") and not [f for f in os.listdir(tmp_path) if "slots" in f]
