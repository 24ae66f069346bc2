"""Filter interaction audit: what each filter removes in every order of a filter chain, by decision diagrams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.support import staged, whole_text

#: A failure condition over the columns ``text`` and ``words`` (the text's words, repeats included).
Condition = Callable[[Column, Column], Column]

BLANKS = r"[\x20\x09-\x0D]+"
WEIGHTS = 3  # documents, good ones, toxic ones

AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
         "toxic_lost long, shapley long")


class Node(NamedTuple):
    """A node tests one filter: ``low`` are the documents that pass it, ``high`` those that fail. ``total`` counts all below."""

    low: Node | None
    high: Node | None
    total: tuple[int, ...]


class Diagram:
    """A count-weighted decision diagram of failure masks; every path tests all filters, in the order of ``order``.

    Equal subdiagrams are one node. ``swap`` exchanges two neighbouring levels: only nodes of these levels are rebuilt, and
    those above that lead to them; what hangs below stays as it is.
    """

    def __init__(self, filters: str, counts: dict[int, tuple[int, ...]]):
        self.order = list(filters)
        self.nodes: dict[tuple, Node] = {}
        nothing = (0,) * WEIGHTS
        level = [self.leaf(counts.get(mask, nothing)) for mask in range(1 << len(filters))]
        while len(level) > 1:  # halves differ in the highest bit alone, the last filter that is left; the first ends at the root
            half = len(level) // 2
            level = [self.node(a, b) for a, b in zip(level[:half], level[half:], strict=True)]
        self.root = level[0]

    def leaf(self, total: tuple[int, ...]) -> Node:
        return self.nodes.setdefault(("leaf", total), Node(None, None, total))

    def node(self, low: Node, high: Node) -> Node:
        key = (id(low), id(high))
        if key not in self.nodes:
            self.nodes[key] = Node(low, high, tuple(a + b for a, b in zip(low.total, high.total, strict=True)))
        return self.nodes[key]

    def swap(self, level: int) -> None:
        """Exchange the filters at ``level`` and ``level + 1``."""
        done: dict[int, Node] = {}

        def turned(node: Node, depth: int) -> Node:
            if id(node) not in done:
                low, high = node.low, node.high
                if depth < level:
                    low, high = turned(low, depth + 1), turned(high, depth + 1)
                else:
                    low, high = self.node(low.low, high.low), self.node(low.high, high.high)
                done[id(node)] = self.node(low, high)
            return done[id(node)]

        self.root = turned(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[str, tuple[int, ...], tuple[int, ...]]]:
        """Down the path of documents that pass everything: each filter with what it keeps and what it removes there."""
        at = self.root
        for name in self.order:
            yield name, at.low.total, at.high.total
            at = at.low


def plain_changes(n: int) -> Iterator[int]:
    """Levels to swap, one after another, so that all orders of ``n`` items are seen once each."""
    if n < 2:
        return
    up = False
    for inner in [*plain_changes(n - 1), None]:
        yield from (range(n - 1) if up else range(n - 2, -1, -1))
        if inner is not None:
            yield inner + (0 if up else 1)
        up = not up


def audit_counts(filters: str, counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order.

    ``counts`` has (documents, good, toxic) of each failure mask; bit i is the i-th filter.
    """
    diagram = Diagram(filters, counts)
    failing = {f: sum(c[0] for mask, c in counts.items() if mask >> i & 1) for i, f in enumerate(filters)}
    alone = {f: counts.get(1 << i, (0,))[0] for i, f in enumerate(filters)}
    shapley = dict.fromkeys(filters, 0)
    found = []
    for level in [None, *plain_changes(len(filters))]:
        if level is not None:
            diagram.swap(level)
        order = "".join(diagram.order)
        for step, (name, kept, removed) in enumerate(diagram.steps(), 1):
            shapley[name] += removed[0]
            found.append((order, step, name, kept[0], removed))
    return [(order, step, kept, removed[0], failing[name] - removed[0], alone[name], removed[1], removed[2], shapley[name])
            for order, step, name, kept, removed in found]


def failure_counts(docs: DataFrame, labels: DataFrame, conditions: dict[str, Condition], repeats: str | None,
                   id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, documents, good, toxic): how many rows of a part fail exactly the filters of a mask."""
    text, words = F.col("text"), F.col("words")
    split = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        whole_text(text_col).alias("text"))
    split = split.withColumn("words", F.filter(F.split(text, BLANKS), lambda w: w != ""))
    mask = sum((F.when(fails(text, words), 1 << i).otherwise(0) for i, fails in enumerate(conditions.values())), F.lit(0))
    # written narrow: texts are read once, all that follows moves a digest
    rows = staged(split.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")), "masks")

    # rows of one id and text are folded before they meet their labels, copies of one text before they meet each other
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"))
    folded = rows.where("doc_id IS NOT NULL").groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    marked = folded.join(known, "doc_id", "left").na.fill(0, ["good", "toxic"])
    cell = ["part", "mask", "good", "toxic"]
    none = F.lit(0).cast("long")
    nameless = rows.where("doc_id IS NULL").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "mask", none.alias("good"), none.alias("toxic"), "n")
    if repeats is None:
        every = marked.select(*cell, "n").unionByName(nameless)
    else:
        cells = marked.groupBy("digest", *cell).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"),
                                                    F.min_by("n", "doc_id").alias("firsts"))
        # a text has one row per part and label here, however many copies it has
        lowest = F.min("first").over(Window.partitionBy("digest"))
        passes = cells.withColumn("passing", F.when(F.col("first") == lowest, F.col("firsts")).otherwise(0))
        bit = 1 << len(conditions)
        parted = F.array(F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
                         F.struct((F.col("mask") + bit).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))
        every = passes.select("part", "good", "toxic", F.inline(parted)).where("n > 0").select(*cell, "n").unionByName(nameless)
    return every.groupBy("part", "mask").agg(
        F.sum("n").alias("documents"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, conditions: dict[str, Condition], repeats: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """What every filter removes, per part, in every order of the filters.

    ``conditions`` maps one-letter names to failure conditions; ``repeats`` names one more filter, last in the alphabet of
    the masks, that fails a document whose text a smaller id has too, anywhere in the table. Returns one row per part,
    filter_order and step (from 1): documents kept and removed there, redundant (failing the step's filter, removed
    before), unique_fails (failing it alone), good_lost and toxic_lost (removed there with quality or toxic 1 in
    ``labels``) and shapley (what the filter removes, summed over all orders).

    A null text is empty, a null part is the empty one. A row without id has no label; it repeats nothing and nothing
    repeats it. Repeated rows count each; those of the smallest id do not repeat each other. Of several labels of an id
    any 1 counts. Other columns are not read; an empty table gives no rows.

    Masks are counted per part before any diagram is built, so a diagram has at most 2^filters counts whatever the
    table's size.
    """
    filters = "".join(conditions) + (repeats or "")
    counted = failure_counts(docs, labels, conditions, repeats, id_col, text_col, part_col)

    def work(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        weights = zip(*(table.column(c).to_pylist() for c in ("documents", "good", "toxic")), strict=True)
        rows = audit_counts(filters, dict(zip(table.column("mask").to_pylist(), weights, strict=True)))
        columns = list(zip(*rows, strict=True))
        names = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.table([pa.array([part] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                        names=["part", *names])

    return counted.groupBy("part").applyInArrow(work, AUDIT)
