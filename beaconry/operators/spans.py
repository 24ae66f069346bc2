"""Span trees: inferred parents and continued traces."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from beaconry.functions import records as rec, trace_context as tc
from beaconry.operators.hot_keys import HOT, KEY, SLOT, SLOT_ROWS, slotted
from beaconry.operators.slot_tree import SlotTree, largest_over_slots, locate, slot_tree

_FOREVER = 2**63 - 1
_PARENTS = "span_id string, context_id string, trace_id string, start_ms bigint, parent_span_id string"


def infer_parent_spans(spans: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """The innermost span still open in the same context and trace when a span starts; else the inbound parent.

    Reads context_id, trace_id, span_id, start_ms, start_seq, finish_ms (null: never finished), finish_seq and
    inbound_parent. (ms, seq) is the order of the marks.

    Each slot of a hot context is replayed on its own. It first receives the spans that end in it and began before it,
    and, of those that stay open throughout, the one that began last: it hides all others. See ``spans_from_before``.
    """
    marks = ["context_id", "trace_id", "span_id", "start_ms", "start_seq", "finish_ms", "finish_seq",
             "inbound_parent"]
    placed = slotted(spans.select(marks), ["context_id", "trace_id"], ["start_ms", "start_seq", "span_id"], slot_rows)
    every = placed.select(KEY, *marks, SLOT).withColumn("_own", F.lit(True))
    tree = slot_tree(placed, F.struct("start_ms", "start_seq"))
    if tree is not None:
        before = spans_from_before(placed.where(HOT), tree)
        every = every.unionByName(before.select(KEY, *marks, SLOT).withColumn("_own", F.lit(False)))
    # sorted runs stream through the replay: it holds the open spans of one run, never the run itself
    forever = F.lit(_FOREVER)
    runs = every.select(
        KEY, SLOT, "context_id", "trace_id", "span_id", "start_ms", "start_seq",
        F.coalesce("start_ms", -forever).alias("_at"),
        F.coalesce("finish_ms", forever).alias("finish_ms"), F.coalesce("finish_seq", forever).alias("finish_seq"),
        F.coalesce("inbound_parent", F.lit("")).alias("inbound_parent"), "_own")
    return runs.repartition(KEY, SLOT).sortWithinPartitions(KEY, SLOT, "_at", "start_seq").mapInPandas(
        _replay, _PARENTS)


def spans_from_before(hot: DataFrame, tree: SlotTree) -> DataFrame:
    """What each slot must know of spans that began in earlier ones, as spans placed in that slot.

    A span that ends in a later slot goes to that slot. For the slots between, and for all later ones if it never ends,
    it is filed on the tree's nodes; each slot takes the latest start of the nodes above it. That is one row per span,
    one per slot, and at most two a level of the tree for each span that reaches over whole slots.
    """
    ending = locate(hot.where(F.col("finish_ms").isNotNull()), tree, F.struct("finish_ms", "finish_seq"), "_until")
    later = ending.where(F.col("_until") > F.col(SLOT))
    past = F.lit(1 << tree.levels).cast("bigint")  # slots of other keys are there too, under their own key
    reaching = later.unionByName(hot.where(F.col("finish_ms").isNull()).withColumn("_until", past))
    own = [c for c in hot.columns if c not in (KEY, SLOT, HOT)]
    covers = largest_over_slots(reaching, tree, F.col(SLOT) + 1, F.col("_until"), F.struct(
        F.struct("start_ms", "start_seq").alias("started"), F.struct(*own).alias("span")))
    whole = covers.select(KEY, SLOT, "_value.span.*")
    return later.drop(SLOT, HOT).withColumnRenamed("_until", SLOT).unionByName(whole)


def _replay(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    run, stack = None, []  # stack: (finish, span id) of spans that may still be open, latest start on top
    for frame in frames:
        parents = []
        for key, slot, span, ms, seq, end_ms, end_seq, inbound in zip(
                *(frame[c].tolist() for c in (KEY, SLOT, "span_id", "_at", "start_seq", "finish_ms", "finish_seq",
                                              "inbound_parent"))):
            if (key, slot) != run:
                run, stack = (key, slot), []
            # finished spans below the top may linger: they surface, and go, once the spans above them are gone
            while stack and stack[-1][0] <= (ms, seq):
                stack.pop()
            parents.append(stack[-1][1] if stack else inbound)
            stack.append(((end_ms, end_seq), span))
        frame["parent_span_id"] = parents
        yield frame.loc[frame["_own"], ["span_id", "context_id", "trace_id", "start_ms", "parent_span_id"]]


def continue_traces(requests: DataFrame) -> DataFrame:
    """Reads request_id, traceparent, own_trace_header; adds trace_id, parent_span_id, inbound_sampled.

    A valid traceparent is continued; else a valid own header gives the trace; else the trace is new.
    """
    parsed = tc.parse_traceparent(F.col("traceparent"))
    return (
        requests.withColumn("_inbound", parsed)
        .withColumn("trace_id", F.coalesce(F.col("_inbound.trace_id"),
                                           tc.normalize_trace_id(F.col("own_trace_header")),
                                           F.md5(F.col("request_id"))))
        .withColumn("parent_span_id", F.col("_inbound.parent_span_id"))
        .withColumn("inbound_sampled", F.col("_inbound.sampled"))
        .drop("_inbound")
    )


def request_ids(requests: DataFrame) -> DataFrame:
    """Reads event_id, x_request_id, own_request_header; a missing id becomes a hash of the event."""
    return requests.withColumn("request_id", F.coalesce(
        rec.first_non_empty(F.col("x_request_id"), F.col("own_request_header")),
        F.md5(F.concat(F.lit("request-"), F.col("event_id").cast("string")))))
