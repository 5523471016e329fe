"""Connected components and joins of tables in which a few keys hold many of the rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: A key is hot when it holds at least one part in ``HOT`` of the rows, so at most ``HOT`` keys are.
HOT = 1000


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row per key (inner, or left).

    The hot keys of ``left``, at most ``HOT`` by their definition, meet a broadcast of their
    rows of ``right``; the rest is shuffled, and no key in it holds more than one part in
    ``HOT`` of the rows. ``left`` is read several times, so it should be a stored table.
    """
    n = f"n_{uuid.uuid4().hex}"
    total = left.count()
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) * HOT >= max(total, HOT * HOT)).select(*keys)
    hot = C.stored(hot.dropna(subset=keys), "hot")
    if not hot.take(1):
        return left.join(right, keys, how)
    known = F.broadcast(hot)
    cold = left.join(known, keys, "left_anti").join(right, keys, how)
    return cold.unionByName(left.join(known, keys, "left_semi").join(F.broadcast(right.join(known, keys, "left_semi")), keys, how))


def _star(e: DataFrame, cut: int, large: bool) -> DataFrame:
    # large: every node's larger neighbours point to its smallest neighbour; small: its smaller ones do
    both = e.unionByName(e.select(F.col("root").alias("node"), F.col("node").alias("root"))) if large else e
    least = (both.groupBy("node").agg(F.min("root").alias("least"), F.count(F.lit(1)).alias("many"))
             .withColumn("least", F.least("node", "least")))
    if cut:
        # nodes with more rows than the cut, at most 2 * HOT of them, meet their rows by a broadcast
        few = C.stored(least.where(F.col("many") > cut).select("node", "least"), "hot-nodes")
        joined = (both.join(F.broadcast(few.select("node")), "node", "left_anti").join(least.where(F.col("many") <= cut).select("node", "least"), "node")
                  .unionByName(both.join(F.broadcast(few), "node")))
    else:
        joined = both.join(least, "node")
    if large:
        moved = joined.where(F.col("root") > F.col("node")).select(F.col("root").alias("node"), F.col("least").alias("root"))
    else:
        moved = (joined.where(F.col("root") != F.col("least")).select(F.col("root").alias("node"), F.col("least").alias("root"))
                 .unionByName(least.where(F.col("least") < F.col("node")).select("node", F.col("least").alias("root"))))
    return moved.where("node != root").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that edges (node, root) lead to, for every node with an edge.

    Alternating large-star and small-star steps until every node has one root and no root has
    one; each round is stored and looked at by one job, and while nodes have very many edges,
    those meet their neighbours by a broadcast, not in one task.
    """
    now = C.stored(edges.select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root"))
                   .where("node != root").distinct(), "edges")
    while True:
        ends = now.select(F.explode(F.array(F.struct("node", F.lit(1).alias("up")), F.struct(F.col("root").alias("node"), F.lit(0).alias("up")))).alias("end"))
        degree = ends.groupBy("end.node").agg(F.count(F.lit(1)).alias("many"), F.sum("end.up").alias("roots"))
        many, total, forked = degree.agg(F.max("many"), F.sum("roots"), F.max(F.col("roots").between(1, F.col("many") - 1) | (F.col("roots") > 1))).first()
        if not forked:
            return now.select("node", F.col("root").alias("label"))
        cut = max(total // HOT, HOT)
        cut = cut if many > cut else 0
        now = C.stored(_star(C.stored(_star(now, cut, True), "star"), cut, False), "edges")
