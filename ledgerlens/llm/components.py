"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import durable, fewer_tasks


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    Rounds of large-star and small-star on the links alone: each node's neighbours are hung on its
    smallest neighbour until all hang on the smallest node of the component. Every round is
    written to the checkpoint folder. Minima are taken before their shuffle, and the join of links
    with them is one that Spark can split where a node has very many links. Rounds never add
    links, so their number sets the tasks of a round. Null ends and links of a node with itself
    are ignored; an empty table gives no rows. ``most`` is a number that the rows of ``links`` don't exceed,
    where it is known; it sets the tasks that write them.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = durable(edges if most is None else fewer_tasks(edges, most))
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if state == before or state[0] == 0:
            break
        rows = state[0] if before is None else rows
        before = state
        edges = fewer_tasks(edges, rows)
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        edges = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        edges = fewer_tasks(edges, rows)
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(fewer_tasks(hung.union(fewer_tasks(least, rows)).distinct(), rows))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    nodes = nodes.union(edges.select("v", "v")).groupBy("node").agg(F.min("component").alias("component"))
    return fewer_tasks(nodes, state[0])
