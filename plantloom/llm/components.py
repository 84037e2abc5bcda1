"""Connected components of an edge table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantloom.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long a, long b): the smallest node reachable.

    Every round each node and its parent hook onto the smallest grandparent
    seen among the neighbours, then parents are replaced by grandparents, so
    rounds grow with the logarithm of the longest path. Minima are aggregated
    before each shuffle; in the joins only the looked-up side has unique keys,
    and a heavy parent lies on the other side, where adaptive execution splits
    it. Each round is written to shared storage.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))))
    parents = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("parent")))
    while True:
        of = parents.select(F.col("node").alias("b"), F.col("parent").alias("above"))
        seen = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("above").alias("low"))
        hooks = (parents.join(seen, "node")
                 .select(F.explode(F.array(
                     F.struct("node", F.least("low", "parent").alias("up")),
                     F.struct(F.col("parent").alias("node"), F.least("low", "parent").alias("up"))))
                     .alias("h"))
                 .groupBy("h.node").agg(F.min("h.up").alias("up")))
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("parent"))
        now = materialize(hooks.join(above, "up").select("node", "parent"))
        changed = now.join(parents.withColumnRenamed("parent", "was"), "node").filter(
            "parent <> was").limit(1).count()
        parents = now
        if not changed:
            return parents.withColumnRenamed("parent", "root")
