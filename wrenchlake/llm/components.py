"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.session import materialise


def _toward_minimum(links: DataFrame, larger_only: bool) -> DataFrame:
    """Hang neighbours of every node on the least node in sight.

    ``larger_only`` moves each node's larger neighbours (they then sit below
    the least one), otherwise each node moves itself and its smaller
    neighbours. The least neighbour is an aggregate, so a hub costs one row per
    task there; the join back is on one row per node.
    """
    if larger_only:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        return both.filter("b > a").join(least, "a").select(F.col("_m").alias("a"), "b")
    least = links.groupBy("b").agg(F.min("a").alias("_m"))
    moved = links.join(least, "b")
    up = moved.filter("a > _m").select(F.col("_m").alias("a"), F.col("a").alias("b"))
    return up.unionByName(least.select(F.col("_m").alias("a"), "b"))


def components(links: DataFrame, rows: int) -> DataFrame:
    """node, component (its least node) for every node of the links (a, b); self-links are ignored.

    ``rows`` is a bound on the number of links. Each round contracts both ways
    and is written to the shared folder; the number of rounds grows with the
    logarithm of the longest chain. Ends when a round changes nothing, at which
    point every component is a star.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    links = materialise(links, "links", rows)
    state = None
    while True:
        new = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if new == state or not new[0]:
            break
        state = new
        larger = _toward_minimum(links, True).filter("a < b").distinct()
        # A round never makes more links than two for each it had.
        links = materialise(_toward_minimum(larger, False).filter("a < b").distinct(), "links", 2 * new[0])
    hubs = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(hubs)
