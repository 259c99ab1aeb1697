"""Connected components of a link table, by repeated star contraction in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.llm.store import kept

#: Links above which a node is a hub; hubs that are broadcast at most (more are joined like any node).
HUB, BROADCAST_ROWS = 100_000, 1 << 20


def _with_least(edges: DataFrame, own: bool, hubs: bool) -> DataFrame:
    """edges (u, v) with m, the smallest v of u (and u itself, if own).

    The minimum is combined before the shuffle.  It comes back to the edges by a
    join on u, but to those of hubs, if there can be any, by a broadcast, where
    they stand.
    """
    least = F.least(F.min("v"), F.col("u")) if own else F.min("v")
    if not hubs:
        return edges.join(edges.groupBy("u").agg(least.alias("m")), "u")
    least = kept(edges.groupBy("u").agg(least.alias("m"), F.count("*").alias("n")), "least")
    hubs = least.where(F.col("n") > HUB).select("u", "m")
    if not 0 < hubs.count() <= BROADCAST_ROWS:
        return edges.join(least.select("u", "m"), "u")
    rest = edges.join(F.broadcast(hubs.select("u")), "u", "left_anti").join(least.where(F.col("n") <= HUB).select("u", "m"), "u")
    return rest.unionByName(edges.join(F.broadcast(hubs), "u"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of links, the smallest node reachable from it.

    Nodes are integers.  Large-star and small-star steps alternate until the
    edges no longer change (Kiveris et al., 2014).  Each round is written to the
    shared folder.  Empty links give an empty table.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    edges = kept(links.select(hi.alias("u"), lo.alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hubs = 2 * edges.count() > HUB
        large = _with_least(both, True, hubs).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = kept(large, "large") if hubs else large
        joined = _with_least(large, False, hubs)
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionAll(
            joined.select("u", F.col("m").alias("v"))
        )
        edges = kept(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
