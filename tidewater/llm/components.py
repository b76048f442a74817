"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _pull(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Point neighbours of each node at the node's smallest neighbour.

    ``larger_only``: the neighbours above the node move to the smallest node
    in its neighbourhood (the hub keeps its own edge); otherwise the node and
    its smaller neighbours move. Both keep the components as they are.
    """
    if larger_only:
        sym = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        low = sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = sym.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v")
    else:
        down = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v")
        out = moved.unionByName(low.selectExpr("u", "m AS v"))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every node that has an edge: ``(node, component)``.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). Every
    round is a map-side combined minimum and a join on the node, so a hub with
    a third of all edges is a skewed join side that adaptive execution splits,
    never one task's list. Each round is written to the shared scratch folder.
    No edges gives an empty table; self loops and repeated edges are ignored.
    """
    edges = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = keep(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), name)
    before = None
    for k in range(max_rounds):
        edges = keep(_pull(_pull(edges, True), False), f"{name}-{k}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.selectExpr("u AS node", "v AS component")
        before = now
    raise RuntimeError("components did not settle")
