"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eligo.llm.common import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; two nodes share a root if a path of links joins them.

    Each round every node points to the first of its neighbours and itself; the links are then redrawn
    between those representatives, without loops and repeats, until none is left. The order is by node in the
    first round (links usually lead to their group's smallest node) and by a hash new in each round after
    that, which shortens long chains by a constant factor on average. Minima are combined before the exchange
    and every round is written to the shared folder, so nothing is gathered in one place. The root is some
    node of the component, not always its smallest. Empty links give no rows.
    """
    edges = materialize(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "links")
    nodes = None
    turn = 0
    while nodes is None or edges.limit(1).count():
        order = F.xxhash64(F.lit(turn), F.col("v")) if turn else F.col("v")
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        both = both.unionByName(both.select("u", F.col("u").alias("v")))
        first = materialize(both.select("u", F.struct(order.alias("o"), F.col("v").alias("p")).alias("x"))
                            .groupBy("u").agg(F.min("x")["p"].alias("p")), "first-neighbours")
        to_a = first.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        to_b = first.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        edges = materialize(
            edges.join(to_a, "a").join(to_b, "b").filter("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        step = first.select(F.col("u").alias("root"), "p")
        nodes = (first.select(F.col("u").alias("node"), F.col("p").alias("root")) if nodes is None else
                 materialize(nodes.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root")), "roots"))
        turn += 1
    return nodes
