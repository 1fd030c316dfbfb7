"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Smallest node reachable from each node that has an edge: columns ``node`` and ``root``.

    Each round hooks every node to its smallest neighbour, follows the hooks
    to their ends by doubling, and contracts the edges to what still joins two
    trees. Every tree that has a neighbour takes part in a merge, so the number of
    trees at least halves: the rounds follow the logarithm of the input. A hub is
    safe: its edges are reduced by a minimum that combines map-side, and the joins
    can be split by adaptive execution. Edges with a null end and loops are
    left out; nodes without an edge are not returned.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    pairs = materialize(pairs, "edges")
    roots = None
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hooks = materialize(hooks.select("node", F.least("node", "low").alias("root")), "hooks")
        hooks = _follow(hooks)
        roots = hooks if roots is None else materialize(_step(roots, hooks), "roots")
        ends = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        pairs = pairs.join(ends, "a").select("b", "ra")
        ends = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        pairs = pairs.join(ends, "b").where("ra <> rb")
        pairs = materialize(
            pairs.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges"
        )
    if roots is None:
        kind = pairs.schema["a"].dataType
        return pairs.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("root"))
    return roots


def _step(nodes: DataFrame, hooks: DataFrame) -> DataFrame:
    far = hooks.select(F.col("node").alias("root"), F.col("root").alias("far"))
    return nodes.join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root"))


def _follow(hooks: DataFrame) -> DataFrame:
    while True:
        again = materialize(_step(hooks, hooks), "hooks")
        # roots only get smaller, so equal sums mean that nothing moved
        if _total(again) == _total(hooks):
            return again
        hooks = again


def _total(hooks: DataFrame):
    return hooks.agg(F.sum(F.col("root").cast("decimal(38,0)"))).first()[0]
