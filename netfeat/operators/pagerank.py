"""Static PageRank over DataFrames.

r0 = 1 for every vertex; each round r(v) = reset + (1 - reset) * sum over
in-edges (u, v) of r(u) / outdeg(u), with no redistribution of dangling
mass; after the last round ranks are scaled per snapshot so that they add
up to the number of vertices (isolated ones included).

Per round: the rank share of each source meets its out-edges. Both are bucketed by the vertex, the
edges once for the whole run and the ranks when they are written, so neither moves (hub sources meet
their edges in a salted join); contributions are summed per destination with map-side partial
sums, the only shuffle, and meet the ranks in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import PAGERANK_ITERATIONS, PAGERANK_RESET
from netfeat.operators.graph import Graph, out_degrees


#: Decimals of a rank. Sums of doubles depend on the order of their terms beyond; snapshots and ids are numbered
#: anew in every batch, so a vintage that is computed again, alone, would differ there.
PLACES = 12


def pagerank(graph: Graph, reset: float = PAGERANK_RESET, max_iter: int = PAGERANK_ITERATIONS) -> DataFrame:
    """(*keys, id, pagerank) for every vertex."""
    k = graph.key_list
    on = [*k, "id"]
    # 1 / out-degree is fixed for the whole run; vertices without out-edges get null.
    state = graph.put(
        graph.vertex_table().join(out_degrees(graph), on, "left").select(
            *on, (F.lit(1.0) / F.col("out_degree")).alias("inv_out"), F.lit(1.0).alias("rank")
        )
    )
    for _ in range(max_iter):
        ranks = state.frame
        share = ranks.where(F.col("inv_out").isNotNull()).select(
            *on, (F.col("rank") * F.col("inv_out")).alias("share")
        )
        sums = (
            graph.gather("src", share)
            .groupBy(*k, F.col("dst").alias("id"))
            .agg(F.sum("share").alias("incoming"))
        )
        state = graph.put(
            ranks.join(sums.hint("shuffle_hash"), on, "left").select(
                *on,
                "inv_out",
                (F.lit(reset) + F.lit(1.0 - reset) * F.coalesce(F.col("incoming"), F.lit(0.0))).alias("rank"),
            ),
            old=state,
        )
    return normalise(state.frame.select(*on, "rank"), k)


def normalise(ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Scale ranks so that they add up to the vertex count of their snapshot, rounded to ``PLACES``."""
    totals = ranks.groupBy(*keys).agg(F.sum("rank").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    if keys:
        scaled = ranks.join(totals, keys)  # one row per snapshot
    else:
        row = totals.first()
        scaled = ranks.withColumns({"_sum": F.lit(row["_sum"] if row else 1.0), "_n": F.lit(row["_n"] if row else 0)})
    return scaled.select(*keys, "id", F.round(F.col("rank") * F.col("_n") / F.col("_sum"), PLACES).alias("pagerank"))
