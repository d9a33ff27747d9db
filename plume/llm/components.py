"""Connected components of a link table by alternating large-star and small-star rounds.

Each round rewrites the links so that every node points at a smaller node of its component; the rounds end
when no link changes.  A round moves a component's links closer to a star around its smallest node, so a few
rounds do even for long chains (about the logarithm of the component's size, squared at worst).  Every round
is checkpointed to the shared folder, partial minima are combined before the shuffle, and a hub's links are
only ever joined with one minimum row (which Spark splits at run time when the hub is skewed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _minima(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minima(both).withColumn("m", F.least("u", "m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    low = _minima(links)
    moved = links.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node each linked node can reach.

    Null ends, self-links and repeated links have no effect; nodes without a link do not occur in the result;
    no links give no rows.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    now = cut(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
              .select(hi.alias("u"), lo.alias("v")).distinct())
    mark = None
    while True:
        got = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if got[0] == 0 or tuple(got) == mark:
            break
        mark = tuple(got)
        now = cut(_small_star(_large_star(now)))
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
