"""Connected components of a link table by alternating large and small stars.

Every round rewrites the links so that nodes hang on the smallest node they know of; the
number of rounds grows with the logarithm of the longest chain.  Nothing but a row count
and a checksum per round reaches the driver, and a node with very many links is only ever
met in an aggregation (summed on the map side) and a join that may be split by skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _nearest(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, or the node itself."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_nearest(both), "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links lead from a node to a smaller one."""
    least = _nearest(links)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.union(kept).filter("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, for all linked nodes.

    Links may be repeated and may lead either way; links of a node to itself or with a
    null end are ignored.  Nodes without a link do not appear.  An empty table gives an
    empty table.
    """
    a, b = F.col(left), F.col(right)
    links = (
        links.filter(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    links = stored(links, "links")
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
