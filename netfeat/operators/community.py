"""Community metrics of label-propagation labels.

Per label: member count, count of directed distinct edges whose two ends
carry the label (self-loops included), density = edges / (n (n - 1) / 2)
and average degree = 2 edges / n, both 0 when the denominator is 0. Edges
are directed while the possible pairs are undirected, so a fully
reciprocal community has density 2.0; that is the definition, kept as is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.functions import safe_ratio
from netfeat.operators.graph import Graph
from netfeat.operators.skew import SkewConfig, hot_keys, salted_join


def community_metrics(graph: Graph, labels: DataFrame) -> DataFrame:
    """(*keys, label, community_size, edge_count, community_density, community_avg_degree)."""
    k = graph.key_list
    arriving = graph.gather("src", labels).select(*k, F.col("dst").alias("id"), "label")
    if graph.hot() is None:
        # every edge meets the label of its destination in that vertex's bucket
        own = labels.select(*k, "id", F.col("label").alias("own")).hint("shuffle_hash")
        within = arriving.repartition(graph.buckets(), *k, "id").join(own, [*k, "id"]).where(F.col("label") == F.col("own"))
        intra = within.groupBy(*k, "label").agg(F.count(F.lit(1)).alias("edge_count"))
    else:
        # edges per (destination, label of the source): summed before the shuffle, so a hub is its
        # distinct neighbour labels; only those that meet the destination's own label survive the join
        arriving = arriving.groupBy(*k, "id", "label").agg(F.count(F.lit(1)).alias("n"))
        intra = (
            arriving.join(labels.select(*k, "id", "label"), [*k, "id", "label"])
            .groupBy(*k, "label")
            .agg(F.sum("n").alias("edge_count"))
        )
    size = labels.groupBy(*k, "label").agg(F.count(F.lit(1)).alias("community_size"))
    n = F.col("community_size")
    e = F.col("edge_count")
    return (
        size.join(intra, [*k, "label"], "left")
        .na.fill({"edge_count": 0})
        .select(
            *k,
            "label",
            "community_size",
            "edge_count",
            safe_ratio(e, n * (n - 1) / 2).alias("community_density"),
            safe_ratio(e * 2, n).alias("community_avg_degree"),
        )
    )


def vertex_communities(
    labels: DataFrame, metrics: DataFrame, keys: list[str], skew: SkewConfig, bound: int | None = None
) -> DataFrame:
    """Metrics of each vertex's community: (*keys, id, label, community_size, ...).

    A community may hold a large share of all vertices, so large labels are
    salted in this look-up. ``bound``: the vertex count, if known.
    """
    hot = hot_keys(metrics, [*keys, "label"], "community_size", skew, bound)
    return salted_join(labels, metrics, [*keys, "label"], hot, F.col("id"), "left")
