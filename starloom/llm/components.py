"""Connected components of a graph given by its edges, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import reliable_checkpoint


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the least node of each node's component.

    Each round every node moves to its least neighbour, and the edges are
    contracted to the places their ends moved to; a star is gone after one
    round, and the edges left shrink until there are none.  The least node
    never moves, so it is where its component ends up.  Edges, moves and
    labels are written to the checkpoint folder every round; the driver only
    learns whether an edge is left.  A node with very many edges is
    pre-aggregated by the minimum before the shuffle, and the joins' other
    side has each node once, so the adaptive skew join may split them.
    """
    left = edges.select(F.col(a).alias("s"), F.col(b).alias("t")).where("s <> t")
    left = reliable_checkpoint(
        left.unionByName(left.select(F.col("t").alias("s"), F.col("s").alias("t"))).distinct(), "edges")
    label = None
    while True:
        move = reliable_checkpoint(left.groupBy("s").agg(F.min("t").alias("t"))
                                   .select(F.col("s").alias("node"), F.least("s", "t").alias("up")), "moves")
        if label is None:
            label = move.select("node", F.col("up").alias("label"))
        else:
            label = reliable_checkpoint(
                label.join(move.withColumnRenamed("node", "from"), F.col("label") == F.col("from"), "left")
                .select("node", F.coalesce("up", "label").alias("label")), "labels")
        ends = left.join(move.select(F.col("node").alias("s"), F.col("up").alias("us")), "s") \
            .join(move.select(F.col("node").alias("t"), F.col("up").alias("ut")), "t")
        left = reliable_checkpoint(ends.where("us <> ut").select(F.col("us").alias("s"), F.col("ut").alias("t"))
                                   .distinct(), "edges")
        if left.isEmpty():
            return label
