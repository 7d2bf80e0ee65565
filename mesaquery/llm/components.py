"""Connected components by hooking, pointer jumping and contraction, on edges that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mesaquery.llm.common import drop, saved, with_small


def _roots(hooked: DataFrame, n: int) -> DataFrame:
    """A saved (node, to) with every ``to`` a root, from that of a forest whose roots hook to themselves.

    Each step sends a node to its target's target and so halves its way; it takes log2(depth) steps.
    """
    while True:
        next_ = hooked.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
        moved = with_small(hooked.select("node", "to"), next_, ["to"], "inner", n)
        jumped = saved(moved.select("node", F.col("beyond").alias("to"), (F.col("to") != F.col("beyond")).alias("moved")), "jumps")
        drop(hooked)
        if jumped.where("moved").isEmpty():
            return jumped
        hooked = jumped


def components(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """``edges`` (a long, b long) to (node, component): the smallest node that each can reach.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the hooks to
    their roots, and contracts the edges to these. A root that nothing hooks to has only neighbours
    that went to smaller roots, so that it hooks in the next round: after two rounds at most half of
    the nodes are left, and the rounds grow with the logarithm of the nodes, whatever the graph. A
    hub's edges meet only in a partial aggregate and in joins.

    Nulls and self-loops are ignored; nodes without edges aren't listed. ``rounds`` gets the number
    of edges that each round began with.
    """
    left = saved(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    labels: DataFrame | None = None
    while n_edges := left.count():
        if rounds is not None:
            rounds.append(n_edges)
        both = left.union(left.select("b", "a"))
        hooked = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("to")), "hooks")
        n = hooked.count()
        roots = _roots(hooked, n)
        on_a = roots.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        on_b = roots.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = with_small(with_small(left, on_a, ["a"], "inner", n), on_b, ["b"], "inner", n)
        contracted = saved(moved.where("to_a <> to_b").select(F.greatest("to_a", "to_b").alias("a"), F.least("to_a", "to_b").alias("b")).distinct(), "edges")
        drop(left)
        left = contracted
        if labels is None:
            labels = roots
        else:
            step = roots.select(F.col("node").alias("reached"), F.col("to").alias("beyond"))
            further = labels.select("node", F.col("to").alias("reached"))
            further = saved(with_small(further, step, ["reached"], "left", n).select("node", F.coalesce("beyond", "reached").alias("to")), "labels")
            drop(labels, roots)
            labels = further
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    drop(left)
    return labels.select("node", F.col("to").alias("component"))
