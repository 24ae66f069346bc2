"""The tree over slots: every slot of a range once, marks found by their slot, rows bounded where spans stay open long."""

import pytest
from pyspark.sql import functions as F

from beaconry.operators import hot_keys, slot_tree as st, spans


def test_ranges_and_paths(spark):
    levels = 6
    ranges = spark.range(60).join(spark.range(70).toDF("end"), F.col("end") >= F.col("id") - 2)
    filed = ranges.select("id", "end", F.inline(st.nodes_of_range(F.col("id"), F.col("end"), levels)))
    asked = spark.range(64).select(F.col("id").alias("slot"), F.inline(st.nodes_above(F.col("id"), levels)))
    met = filed.join(asked, ["level", "index"]).groupBy("id", "end").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    got = {(r.id, r.end): r.slots for r in met.collect()}
    assert got == {(i, e): list(range(i, min(e, 64))) for i in range(60) for e in range(70) if e > i}
    assert filed.groupBy("id", "end").count().agg(F.max("count")).first()[0] <= 2 * levels


@pytest.fixture(scope="module")
def late(spark):
    """20,000 spans of one context that stay open over most of the rest, among them some that never end, and a small one."""
    key = F.when(F.col("id") % 400 == 7, F.concat(F.lit("c"), F.col("id") % 5)).otherwise("hot")
    n = 20_000
    return spark.range(n).select(
        key.alias("context_id"), F.lit("t").alias("trace_id"), F.concat(F.lit("s"), "id").alias("span_id"),
        F.floor(F.col("id") / 3).cast("bigint").alias("start_ms"), F.col("id").alias("start_seq"),
        F.when(F.col("id") % 5003 == 11, None).otherwise(
            F.floor(F.col("id") / 3).cast("bigint") + F.when(F.col("id") % 7 == 0, F.col("id") % 40).otherwise(n // 2 + (F.col("id") * 7919) % n)).alias("finish_ms"),
        (F.col("id") + n).alias("finish_seq"), F.lit("up").alias("inbound_parent"))


def test_late_ending_spans(late):
    slot_rows = 200
    placed = hot_keys.slotted(late, ["context_id", "trace_id"], ["start_ms", "start_seq", "span_id"], slot_rows)
    tree = st.slot_tree(placed, F.struct("start_ms", "start_seq"))
    hot = placed.where(hot_keys.HOT)
    slots, n = tree.firsts.count(), hot.count()
    assert slots > 100 and tree.depth == 2
    before = spans.spans_from_before(hot, tree)
    assert before.count() <= n + slots
    until = st.locate(hot.where("finish_ms IS NOT NULL"), tree, F.struct("finish_ms", "finish_seq"), "until")
    assert st.filed(until, tree, F.col("_slot") + 1, F.col("until")).count() <= n * 2 * slots.bit_length()
    firsts = sorted((r["_first"], r["_slot"]) for r in tree.firsts.collect())
    for r in until.where("start_seq % 97 = 0").collect():
        assert r.until == max([s for f, s in firsts if tuple(f) < (r.finish_ms, r.finish_seq)], default=firsts[0][1])


def test_parents_of_late_ending_spans(late):
    rows = late.collect()
    by_context = {}
    for r in sorted(rows, key=lambda r: (r.start_ms, r.start_seq)):
        by_context.setdefault(r.context_id, []).append(r)
    want = {}
    for context in by_context.values():
        stack = []
        for r in context:
            while stack and (stack[-1].finish_ms if stack[-1].finish_ms is not None else 1 << 62, stack[-1].finish_seq) <= (r.start_ms, r.start_seq):
                stack.pop()
            want[r.span_id] = stack[-1].span_id if stack else "up"
            stack.append(r)
    for slot_rows in (200, 5000, 1_000_000):
        got = spans.infer_parent_spans(late, slot_rows).select("span_id", "parent_span_id").collect()
        assert len(got) == len(rows) and dict(map(tuple, got)) == want


def test_spans_without_time_and_empty(spark, late):
    """A start without a time counts as the earliest of its key, in any slot."""
    odd = late.limit(3000).withColumn("start_ms", F.when(F.col("start_seq") >= 20, F.col("start_ms")))
    small = dict(map(tuple, spans.infer_parent_spans(odd, 100).select("span_id", "parent_span_id").collect()))
    assert small == dict(map(tuple, spans.infer_parent_spans(odd).select("span_id", "parent_span_id").collect()))
    assert spans.infer_parent_spans(late.limit(0)).count() == 0
