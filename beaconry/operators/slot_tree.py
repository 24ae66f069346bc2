"""A binary tree over the slots of hot keys, for rows that reach over many slots.

A row that covers a range of slots is filed on the few nodes that make up the range, at most two of a level; a slot
asks the nodes on its way to the root. With ``s`` slots that is 2 log s rows for a range and log s for a question,
where handing a row to every slot it covers costs s. Nodes are plain columns (key, level, index), so filing is an
explode, folding a node an aggregate with a partial one before the shuffle, and asking a join on equal keys.

``locate`` finds the slot of a mark by the slots' first marks. These form a tree of few levels of ``FANOUT`` marks a
node, walked by one join on equal keys a level; no row ever carries all marks of its key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from beaconry.operators.hot_keys import HOT, KEY, SLOT
from beaconry.session import scratch_dir

FANOUT = 32
_NODE, _ENTRIES = "_node", "_entries"


@dataclass(frozen=True)
class SlotTree:
    """First marks of all slots of hot keys (``_key``, ``_slot``, ``_first``), one row per slot, and the tree's heights."""

    firsts: DataFrame
    levels: int  # of the binary tree
    depth: int  # of the tree of marks


def slot_tree(placed: DataFrame, mark: Column) -> SlotTree | None:
    """The tree over the slots of ``placed``, a result of ``slotted``; None where no key is hot."""
    path = scratch_dir(placed.sparkSession, "first-marks")
    placed.where(HOT).groupBy(KEY, SLOT).agg(F.min(mark).alias("_first")).write.parquet(path)
    firsts = placed.sparkSession.read.parquet(path)
    last, most = firsts.groupBy(KEY).agg(F.max(SLOT).alias("last"), F.count(F.lit(1)).alias("slots")).agg(
        F.max("last"), F.max("slots")).first()
    if last is None:
        return None
    depth = 1
    while FANOUT ** depth < most:
        depth += 1
    return SlotTree(firsts, int(last).bit_length(), depth)


def locate(rows: DataFrame, tree: SlotTree, mark: Column, name: str) -> DataFrame:
    """Add ``name``: of the slots of a row's key, the last that begins before ``mark``; the first if none does."""
    in_order = Window.partitionBy(KEY).orderBy(SLOT)  # one row per slot
    children = tree.firsts.select(KEY, (F.row_number().over(in_order) - 1).alias("_rank"), "_first", F.col(SLOT).alias("_child"))
    tables = []
    for _ in range(tree.depth):
        nodes = children.groupBy(KEY, F.floor(F.col("_rank") / FANOUT).alias(_NODE)).agg(
            F.sort_array(F.collect_list(F.struct("_first", "_child"))).alias(_ENTRIES))  # at most FANOUT
        tables.append(nodes)
        children = nodes.select(KEY, F.col(_NODE).alias("_rank"), F.col(_ENTRIES)[0]["_first"].alias("_first"), F.col(_NODE).alias("_child"))
    found = rows.withColumn("_mark", mark).withColumn(_NODE, F.lit(0).cast("bigint"))
    for nodes in reversed(tables):
        begun = F.size(F.filter(_ENTRIES, lambda e: e["_first"] < F.col("_mark")))
        child = F.element_at(_ENTRIES, F.greatest(begun, F.lit(1)))["_child"]
        found = found.join(nodes, [KEY, _NODE]).withColumn(_NODE, child).drop(_ENTRIES)
    return found.withColumnRenamed(_NODE, name).drop("_mark")


def nodes_of_range(start: Column, end: Column, levels: int) -> Column:
    """The nodes (level, index) that make up the slots from ``start`` to before ``end``."""
    found = []
    for level in range(levels + 1):
        left, right = F.shiftright(start + ((1 << level) - 1), level), F.shiftright(end, level)
        for odd, index in ((left, left), (right, right - 1)):
            found.append(F.when((left < right) & (odd % 2 == 1), F.struct(F.lit(level).alias("level"), index.alias("index"))))
    return F.filter(F.array(*found), lambda n: n.isNotNull())


def nodes_above(slot: Column, levels: int) -> Column:
    """The nodes from a slot's leaf to the root."""
    return F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(slot, level).alias("index")) for level in range(levels + 1)])


def filed(rows: DataFrame, tree: SlotTree, start: Column, end: Column) -> DataFrame:
    """Every row once per node of its range, with the node as ``level`` and ``index``; empty ranges give no rows."""
    return rows.select("*", F.inline(nodes_of_range(start, end, tree.levels)))


def largest_over_slots(rows: DataFrame, tree: SlotTree, start: Column, end: Column, value: Column) -> DataFrame:
    """(_key, _slot, _value): of the rows whose range holds a slot, the largest ``value``, for slots that any row covers."""
    folded = filed(rows.withColumn("_value", value), tree, start, end).groupBy(KEY, "level", "index").agg(F.max("_value").alias("_value"))
    asking = tree.firsts.select(KEY, SLOT, F.inline(nodes_above(F.col(SLOT), tree.levels)))
    return asking.join(folded, [KEY, "level", "index"]).groupBy(KEY, SLOT).agg(F.max("_value").alias("_value"))
