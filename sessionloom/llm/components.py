"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.session import drop, materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root: equal roots if and only if edges (a, b) connect the nodes; nodes with edges only.

    In each round every node joins the first of its neighbours and itself, in an order drawn
    anew by hash, and the edges between the joined nodes remain.  A star takes one round, any
    graph a number that grows with the logarithm of its size in expectation; each round has at
    least one node less per component, so it ends.  Rounds are written tables: nothing comes to
    the driver, and a node with very many edges or members is the key of plain joins, which
    adaptive execution splits.  A round's tables go when the next has its own; what is returned is
    one table, which `release` removes.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        order = lambda name: F.struct(
            F.xxhash64(name, F.lit(turn)).alias("place"), F.col(name).alias("node")  # noqa: B023
        )
        first = both.groupBy("a").agg(F.min(order("b")).alias("first"))
        joined = materialise(
            first.select(
                F.col("a").alias("old"), F.least(F.col("first"), order("a"))["node"].alias("new")
            ),
            "joined-nodes",
        )
        last, roots = roots, materialise(
            joined.toDF("node", "root") if roots is None else
            roots.join(joined, roots["root"] == joined["old"], "left").select(
                "node", F.coalesce("new", "root").alias("root")
            ),
            "roots",
        )
        drop(*[last] if last is not None else [])
        last, edges = edges, materialise(
            edges.join(joined.toDF("a", "c"), "a").join(joined.toDF("b", "d"), "b")
            .where("c <> d").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
            .distinct(),
            "edges",
        )
        drop(last, joined)
        turn += 1
    if roots is None:
        roots = edges.toDF("node", "root")
        roots.written_to = edges.written_to
        return roots
    drop(edges)
    return roots
