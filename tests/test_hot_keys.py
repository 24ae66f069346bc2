"""A key that holds a third of all rows is cut into slots; the result is that of a plain window."""

import pytest
from pyspark.sql import Window, functions as F

from beaconry.operators import context, delivery, hot_keys, spans


@pytest.fixture(scope="module")
def marks(spark):
    """6,000 rows; one process has 2,000, another 1,000 of which half share one instant, the rest are spread."""
    return spark.range(6000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, "burst")
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 97).cast("string"))).alias("process_id"),
        F.when((F.col("id") % 6 == 1) & (F.col("id") % 12 == 1), F.lit(3000)).when(F.col("id") % 500 == 9, None)
        .otherwise((F.col("id") * 7919) % 6007).cast("bigint").alias("ts_ms"),
        (F.col("id") % 41 == 0).alias("is_error"),
        F.when(F.col("id") % 17 == 0, "set_user").when(F.col("id") % 59 == 1, "clear_user")
        .when(F.col("id") % 5 == 0, "error").otherwise("other").alias("kind"),
        F.when(F.col("id") % 17 == 0, F.concat(F.lit("u"), "id")).alias("user_id"),
        F.lit(None).cast("string").alias("explicit_user_id"),
    ).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_slots_are_small_and_ordered(marks):
    placed = hot_keys.slotted(marks, ["process_id"], ["ts_ms", "event_id"], 200).where(F.col("process_id") == "hot")
    sizes = placed.groupBy("_slot").agg(F.count("*").alias("n"), F.min("ts_ms").alias("lo"), F.max("ts_ms").alias("hi"))
    found = sorted((r._slot, r.n, r.lo, r.hi) for r in sizes.collect())
    assert len(found) > 10 and max(n for _, n, _, _ in found) < 400
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:]) if a[3] is not None and b[2] is not None)


def test_outliers_bursts_and_nulls_make_no_large_slots(spark):
    """20,000 rows of one key: one in eleven at time 0, a third at one instant, some without a time, one far away."""
    many = spark.range(20_000).select(
        "id", F.lit("k").alias("key"),
        F.when(F.col("id") == 7, F.lit(4 * 10**17)).when(F.col("id") % 11 == 0, 0).when(F.col("id") % 13 == 0, None)
        .when(F.col("id") % 3 == 0, 1_700_000_000_000).otherwise(1_700_000_000_000 + F.col("id")).alias("at"))
    sizes = hot_keys.slotted(many, ["key"], ["at", "id"], 1000).groupBy("_slot").count().collect()
    assert len(sizes) >= 20 and max(r["count"] for r in sizes) <= 2000


def test_many_newest_rows(spark, marks):
    threshold = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    want = rows(hot_keys.newest(marks, ["process_id"], ["ts_ms", "event_id"], 60))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "50")
    try:
        assert rows(hot_keys.newest(marks, ["process_id"], ["ts_ms", "event_id"], 60)) == want
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)


@pytest.mark.parametrize("slot_rows", [150, 10**6])
def test_numbered(marks, slot_rows):
    got = hot_keys.numbered(marks, ["process_id"], ["ts_ms", "event_id"], "n", slot_rows)
    plain = marks.withColumn("n", F.row_number().over(Window.partitionBy("process_id").orderBy("ts_ms", "event_id")))
    assert rows(got.select("event_id", "n")) == rows(plain.select("event_id", "n"))


@pytest.mark.parametrize("slot_rows", [20, 150])
def test_crumbs(marks, slot_rows):
    got = context.crumb_owners(marks, 7, slot_rows).select("event_id", "error_id")
    after = Window.partitionBy("process_id").orderBy("ts_ms", "event_id").rowsBetween(0, Window.unboundedFollowing)
    owned = marks.withColumn("error_id", F.first(F.when(F.col("is_error"), F.col("event_id")), True).over(after)).where(
        ~F.col("is_error") & F.col("error_id").isNotNull())
    age = Window.partitionBy("process_id", "error_id").orderBy(F.desc("ts_ms"), F.desc("event_id"))
    plain = owned.withColumn("k", F.row_number().over(age)).where("k <= 7").select("event_id", "error_id")
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("slot_rows", [20, 150])
def test_user_at_error(marks, slot_rows):
    got = context.user_at_error(marks, slot_rows).select("event_id", "error_user_id")
    plain = context.user_at_error(marks, 10**9).select("event_id", "error_user_id")
    assert rows(got) == rows(plain)
    users, want = {}, {}
    for r in sorted(marks.collect(), key=lambda r: (r.ts_ms is not None, r.ts_ms or 0, r.event_id)):
        if r.kind == "set_user":
            users[r.process_id] = r.user_id
        elif r.kind == "clear_user":
            users[r.process_id] = None
        elif r.kind == "error":
            want[r.event_id] = users.get(r.process_id)
    assert dict(rows(got)) == want


@pytest.mark.parametrize("slot_rows", [50, 10**6])
def test_span_parents(spark, slot_rows):
    spans_df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 31).cast("string"))).alias("context_id"),
        F.lit("t").alias("trace_id"), F.concat(F.lit("s"), "id").alias("span_id"),
        ((F.col("id") * 613) % 3001).alias("start_ms"), (F.col("id") * 2).alias("start_seq"),
        F.when(F.col("id") % 101 == 0, None).otherwise((F.col("id") * 613) % 3001 + (F.col("id") * 37) % 400).alias("finish_ms"),
        (F.col("id") * 2 + 1).alias("finish_seq"),
        F.when(F.col("id") % 2 == 0, "upstream").alias("inbound_parent"))
    got = dict(rows(spans.infer_parent_spans(spans_df, slot_rows).select("span_id", "parent_span_id")))
    want, stacks, marks = {}, {}, []
    for r in spans_df.collect():
        marks.append(((r.start_ms, r.start_seq), 0, r))
        if r.finish_ms is not None:
            marks.append(((r.finish_ms, r.finish_seq), 1, r))
    for _, finish, r in sorted(marks, key=lambda m: m[:2]):
        stack = stacks.setdefault(r.context_id, [])
        if finish:
            stack.remove(r.span_id)
        else:
            want[r.span_id] = stack[-1] if stack else (r.inbound_parent or "")
            stack.append(r.span_id)
    assert got == want


def test_chunks(marks):
    got = delivery.chunk_numbers(marks, ["process_id"], ["ts_ms", "event_id"], 100, slot_rows=150)
    sizes = got.groupBy("process_id", "chunk").agg(F.count("*").alias("n"), F.max("position").alias("last"))
    assert all(r.n == r.last <= 100 for r in sizes.collect())
    assert sizes.where("process_id = 'hot'").count() == 20
