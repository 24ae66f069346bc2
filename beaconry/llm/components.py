"""Connected components of a graph of numbered nodes, by pointer jumping over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import staged


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node that can be reached.

    Each round gives every node the smallest root among its neighbours, hands that root on to the node's former root
    and then follows roots once more, so that even long chains take few rounds. Rounds are written to the
    shared scratch folder; the loop ends with the first round that changes no root. Loops and repeated edges are
    harmless; no edges give no rows.
    """
    links = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct()
    links = staged(links, "links")
    roots = staged(links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "roots")
    while True:
        near = links.join(roots.select(F.col("node").alias("b"), F.col("root").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        own = roots.join(near.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "seen").alias("better"))
        told = own.filter("better < root").groupBy("root").agg(F.min("better").alias("told")).withColumnRenamed("root", "former")
        hooked = (own.join(told, F.col("node") == F.col("former"), "left")
                  .select("node", "root", F.least("better", "told").alias("better")))
        hooked = staged(hooked, "roots")
        jump = hooked.select(F.col("node").alias("better"), F.col("better").alias("jumped"))
        then = hooked.join(jump, "better").select("node", F.col("root").alias("was"), F.col("jumped").alias("root"))
        then = staged(then, "roots")
        moved = then.filter("root <> was").limit(1).count()
        roots = then.drop("was")
        if not moved:
            return roots
