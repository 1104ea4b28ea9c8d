"""Connected components by contraction.

Each round gives every node a random priority, hooks it to the best of itself and its neighbours, and renames the
links. Nodes in the middle of others vanish, so that the expected number of nodes falls by a constant factor, for
long paths and large stars alike. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.words import stored


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of links ``a, b`` (numbers); nodes have one root if and only if they are connected."""
    links = stored(links.select("a", "b").where("a <> b"), "links")
    hooks: DataFrame | None = None
    turn = 0
    while links.limit(1).count():
        both = links.union(links.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("p"), c.alias("node"))  # noqa: B023, E731
        best = both.groupBy(F.col("a").alias("node")).agg(F.min(rank(F.col("b"))).alias("best"))
        best = stored(best.select("node", F.least("best", rank(F.col("node")))["node"].alias("root")), "hooks")
        for side in ("a", "b"):
            links = links.join(best.select(F.col("node").alias(side), F.col("root").alias(f"to_{side}")), side)
        links = links.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).where("a <> b").distinct()
        links = stored(links, "links")
        if hooks is None:
            hooks = best
        else:
            after = best.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hooks = stored(hooks.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        turn += 1
    return hooks if hooks is not None else links.select(F.col("a").alias("node"), F.col("b").alias("root"))
