"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``links`` (columns ``a``, ``b``).

    Each round maps a node to the smallest of itself and its neighbours and contracts the
    links along that map, until no link is left.  With node ids that are hashes, the nodes
    left fall by a constant factor a round, whatever the shape of the component.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while True:
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(ends.groupBy("a").agg(F.min("b").alias("m"))
                       .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "contract")
        if labels is None:
            labels = step
            if labels.isEmpty():
                return labels
        else:
            to = step.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
            older, labels = labels, written(labels.join(to, F.col("label") == F.col("_n"), "left")
                                            .select("node", F.coalesce("_l", "label").alias("label")), "labels")
            drop_written(older)
        ma, mb = (step.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in "ab")
        older, edges = edges, written(edges.join(ma, "a").join(mb, "b")
                                      .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
                                      .where("a <> b").distinct(), "links")
        drop_written(older)
        if edges.isEmpty():
            return labels
