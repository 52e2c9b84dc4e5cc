"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqgate.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `edges (a, b)`; root is the component's smallest node.

    Each round hooks every node to its smallest neighbour, follows those hooks to their
    ends and contracts the edges onto the ends. A node that stays has only larger
    neighbours, and they all leave, so the nodes halve at least: the rounds are
    logarithmic in the number of nodes. Minima are combined before the shuffle, and every
    step is a table in the shared folder. Nulls and loops are left out.
    """
    left = written(_between(edges), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("m"))
        parents = _flat(written(hooks.select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "hooks"))
        rounds.append(parents)
        of = lambda end, p=parents: p.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        ends = left.join(of("a"), "a").join(of("b"), "b")
        left = written(_between(ends.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[0]
    for later in rounds[1:]:
        found = _followed(found, later)
    return written(found, "components")


def _between(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.where("a <> b").distinct()


def _followed(parents: DataFrame, later: DataFrame) -> DataFrame:
    """`parents` with each root replaced by the root that `later` gives it."""
    step = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return parents.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def _flat(parents: DataFrame) -> DataFrame:
    """Every node with the end of its chain of hooks; the followed length doubles each time."""
    while True:
        longer = parents.alias("p").join(parents.alias("q"), F.col("p.root") == F.col("q.node"))
        further = written(
            longer.select("p.node", F.col("q.root").alias("root"), (F.col("p.root") != F.col("q.root")).alias("moved")),
            "hooks",
        )
        parents = further.select("node", "root")
        if further.where("moved").isEmpty():
            return parents
