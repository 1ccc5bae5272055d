"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsloom.llm.shared import staged


def components(edges: DataFrame) -> DataFrame | None:
    """(node, root) for every node of the edges (a, b); root is one node of the component. None without edges.

    Every round hooks each node to its smallest neighbour and contracts the graph to the hooks; with
    names that stand in random order (digests) a round removes a constant share of the nodes. Each
    round is written, so a lost executor repeats one round at most; the driver sees no node.
    """
    rest = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    hooks = []
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a"))
        hook = staged(both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("root")), "hooks")
        hooks.append(hook)
        one = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        two = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        rest = staged(rest.join(one, "a").join(two, "b").filter("ra <> rb").select(
            F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if not hooks:
        return None
    out = hooks[0]
    for hook in hooks[1:]:
        after = hook.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = out.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    # a hook may point to a node that is hooked in turn in the same round: follow to the end
    out = staged(out, "roots")
    while True:
        above = out.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = out.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        moved = staged(moved, "roots")
        out = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return out
