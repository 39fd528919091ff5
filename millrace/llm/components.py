"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared


def _beside_least(edges: DataFrame, least: DataFrame, hub_rows: int, hubs: bool) -> DataFrame:
    """Edges (u, v) joined with least (u, m, n: the node's edges); a node of more than ``hub_rows`` edges is dealt over several tasks.

    Such nodes are told by a broadcast of at most edges / hub_rows rows; without ``hubs`` there are none.
    """
    if not hubs:
        return edges.join(least.select("u", "m"), "u")
    parts = F.ceil(F.col("n") / hub_rows).cast("int")
    told = F.broadcast(least.filter(F.col("n") > hub_rows).select(F.col("u").alias("hub"), parts.alias("parts")))
    dealt = edges.join(told, F.col("u") == F.col("hub"), "left").select("u", "v", F.coalesce(F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"), F.lit(0)).alias("part"))
    return dealt.join(least.select("u", "m", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)).alias("part")), ["u", "part"])


def _state(edges: DataFrame) -> tuple[int, int]:
    """How many edges (u, v) there are, and how many nodes u have several or one to a node that isn't a root."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(False).alias("down")).unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(True).alias("down")))
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(F.sum("up").alias("edges"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & F.col("down"))).alias("open")).collect()[0]
    return row["edges"] or 0, row["open"]


def connected_components(shared: Shared, edges: DataFrame, name: str = "components", most_rounds: int = 60, hub_rows: int = 100_000) -> DataFrame:
    """(node, root) for every node of an edge (a, b); root is the smallest node of the component.

    Alternates the large-star and small-star steps: every node's larger
    neighbours are tied to its smallest neighbour, then its smaller ones, until
    each node is tied to a root.  Minima combine before the shuffle and are
    joined back with hubs dealt over several tasks; no edge comes to the
    driver.  Each round is written and replaces the one before; one aggregation
    tells whether another is needed, and whether any node can be a hub.
    Nulls aren't nodes; repeated edges count once; no edges give no nodes.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now = shared.keep(pairs, f"{name}0")
    for k in range(1, most_rounds + 2):
        left, unsettled = _state(now)
        if not unsettled:
            break
        hubs = left > hub_rows
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _beside_least(now.select(F.col("v").alias("u"), F.col("u").alias("v")), least, hub_rows, hubs).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _beside_least(large, low, hub_rows, hubs).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        now = shared.keep(small, f"{name}{k}")
        shared.drop(f"{name}{k - 1}")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
