"""Weighted directed PageRank as a DataFrame iteration.

Semantics of the usual power iteration: damping ``alpha``, start and teleport
vector uniform (1/N), out-weights normalised per source, the rank of dangling
vertices (no out-weight) spread uniformly, stop when the L1 change is below
``N * tol`` or after ``max_iter`` rounds.

The normalised edges are written once, dealt by their source (hub sources
over several partitions, see ``iterate``).  Per round the ranks join them
there, one aggregate on the target follows (combined map-side, so hub targets
never gather raw rows), and contributions and vertex rows meet in that
aggregate (no join back to the vertex table).  The round's two scalars
(dangling mass, L1 change) are one aggregate over the written round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plume.operators.iterate import SpreadEdges, round_state
from plume.schemas import PAGERANK_ALPHA, PAGERANK_MAX_ITER, PAGERANK_TOL


@dataclass
class PageRankInfo:
    iterations: int
    converged: bool
    l1_change: float


def pagerank(verts: DataFrame, edges: DataFrame, alpha: float = PAGERANK_ALPHA, max_iter: int = PAGERANK_MAX_ITER,
             tol: float | None = PAGERANK_TOL) -> tuple[DataFrame, PageRankInfo]:
    """Return ``(username, pagerank)`` and run info.

    ``verts``: ``username``; ``edges``: ``source_user, target_user, weight`` with
    one row per pair (see ``graph.collapse_edges``).  ``tol=None`` runs exactly
    ``max_iter`` rounds.  Not converging is reported in the info, and the last
    iterate is returned; ``converged_pagerank`` raises instead.
    """
    spark = verts.sparkSession
    out_w = edges.groupBy("source_user").agg(F.sum(F.col("weight").cast("double")).alias("__w"))
    norm = SpreadEdges(edges.join(out_w, "source_user").select(
        F.col("source_user").alias("src"), F.col("target_user").alias("dst"),
        (F.col("weight").cast("double") / F.col("__w")).alias("p")), "src")
    vd = round_state(verts.select("username").join(out_w.select(F.col("source_user").alias("username"),
                                                                F.lit(False).alias("__has_out")), "username", "left")
                     .select("username", F.col("__has_out").isNull().alias("dangling")))
    # Vertex count and the start's dangling mass (each vertex starts at 1/N) in one job.
    n, n_dangling = vd.agg(F.count(F.lit(1)), F.count_if(F.col("dangling"))).first()
    if n == 0:
        return spark.createDataFrame([], "username string, pagerank double"), PageRankInfo(0, True, 0.0)

    ranks = vd.select("username", "dangling", F.lit(1.0 / n).alias("rank"))
    dangling_mass = n_dangling * (1.0 / n)
    info = PageRankInfo(0, False, float("inf"))
    for it in range(1, max_iter + 1):
        contrib = norm.look_up(ranks.select(F.col("username").alias("src"), "rank")).select(
            F.col("dst").alias("username"), (F.col("rank") * F.col("p")).alias("c"),
            F.lit(None).cast("boolean").alias("dangling"), F.lit(None).cast("double").alias("old"))
        base = ranks.select("username", F.lit(0.0).alias("c"), "dangling", F.col("rank").alias("old"))
        summed = contrib.unionByName(base).groupBy("username").agg(
            F.sum("c").alias("c"), F.max("dangling").alias("dangling"), F.max("old").alias("old"))
        rank = F.lit(alpha) * (F.col("c") + F.lit(dangling_mass / n)) + F.lit((1.0 - alpha) / n)
        now = round_state(summed.select("username", "dangling", rank.alias("rank"),
                                        F.abs(rank - F.col("old")).alias("delta")))
        row = now.agg(F.sum("delta"), F.sum(F.when(F.col("dangling"), F.col("rank")).otherwise(0.0))).first()
        ranks = now.select("username", "dangling", "rank")
        err, dangling_mass = float(row[0] or 0.0), float(row[1] or 0.0)
        info = PageRankInfo(it, False, err)
        if tol is not None and err < n * tol:
            info.converged = True
            break
    if tol is None:
        info.converged = True
    return ranks.select("username", F.col("rank").alias("pagerank")), info


def converged_pagerank(verts: DataFrame, edges: DataFrame) -> DataFrame:
    """PageRank that has converged; raises if it has not after the usual maximum of rounds."""
    ranks, info = pagerank(verts, edges)
    if not info.converged:
        raise RuntimeError(f"PageRank did not converge in {info.iterations} rounds (L1 change {info.l1_change})")
    return ranks
