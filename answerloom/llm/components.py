"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.common import land


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (a, b: any orderable type) -> node, root: the smallest node that each linked node reaches.

    Every round hangs each node below the smallest node it is linked with,
    follows the parents to their roots by doubling, and goes on with the links
    between different roots.  A round at least halves the nodes that still have
    links, so rounds and jumps are few; each ends in a written table.  Links at
    a hub meet in aggregates with map-side combine.  NULL ends are ignored, and
    an empty table gives no rows.
    """
    edges = land(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), name)
    found = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = land(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node"), name
        )
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("_up"))
            jumped = land(
                parents.join(up, "root").select("node", F.col("_up").alias("root"), (F.col("_up") < F.col("root")).alias("_moved")),
                name,
            )
            parents = jumped.drop("_moved")
            if jumped.filter("_moved").isEmpty():
                break
        if found is None:
            found = parents
        else:
            later = parents.select(F.col("node").alias("root"), F.col("root").alias("_later"))
            found = land(
                found.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("root")), name
            )
        a = parents.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        b = parents.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        edges = land(
            edges.join(a, "a").join(b, "b").filter("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            name,
        )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
