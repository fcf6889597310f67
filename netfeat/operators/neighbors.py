"""High-risk neighbour counts.

A node is high-risk in a snapshot if any transaction of the snapshot flags
it, as entity or as counterparty. The count of a vertex is the number of
edge ends next to it whose other end is high-risk: a reciprocal high-risk
partner counts 2, a self-loop of a high-risk vertex counts 2 for itself.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import COUNTERPARTY, ENTITY
from netfeat.operators.graph import Graph, _ends
from netfeat.operators.risk import flag_columns
from netfeat.operators.skew import hot_keys, salted_join
from netfeat.operators.timeline import CHUNK_COL, MASK, counts_by_snapshot


def high_risk_nodes(trxn: DataFrame, keys: Iterable[str] = (), level: str = "vhrg") -> DataFrame:
    """(*keys, id, is_high_risk=1): ids flagged on either side, in one scan."""
    k = list(keys)
    ef, cf = flag_columns(level)
    ids = F.array(
        F.when(F.col(ef) == 1, F.col(ENTITY)),
        F.when(F.col(cf) == 1, F.col(COUNTERPARTY)),
    )
    return (
        trxn.select(*k, F.explode(ids).alias("id"))
        .where(F.col("id").isNotNull())
        .distinct()
        .withColumn("is_high_risk", F.lit(1))
    )


def vertex_risk(graph: Graph, nodes: DataFrame) -> DataFrame:
    """(*keys, id, is_high_risk 0/1) for every vertex."""
    on = [*graph.keys, "id"]
    return (
        graph.vertices.join(nodes.select(*on, "is_high_risk"), on, "left")
        .na.fill({"is_high_risk": 0})
        .select(*on, "is_high_risk")
    )


def edge_risk(graph: Graph, risk: DataFrame) -> DataFrame:
    """(*keys, src, dst, src_is_high_risk, dst_is_high_risk)."""
    e = graph.edges.select(*graph.keys, "src", "dst")
    e = graph.join_endpoint(e, "src", risk.withColumnRenamed("is_high_risk", "src_is_high_risk"), "left")
    return graph.join_endpoint(e, "dst", risk.withColumnRenamed("is_high_risk", "dst_is_high_risk"), "left")


def neighbor_counts(graph: Graph, edges_with_risk: DataFrame) -> DataFrame:
    """(*keys, id, high_risk_neighbor_count) for every vertex with an edge."""
    k = graph.key_list
    ends = edges_with_risk.select(
        *k,
        F.explode(
            F.array(
                F.struct(F.col("src").alias("id"), F.col("dst_is_high_risk").alias("n")),
                F.struct(F.col("dst").alias("id"), F.col("src_is_high_risk").alias("n")),
            )
        ).alias("x"),
    ).select(*k, "x.id", "x.n")
    return ends.groupBy(*k, "id").agg(F.sum("n").cast("long").alias("high_risk_neighbor_count"))


def risky_neighbor_counts(graph: Graph, nodes: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """(*keys, id, high_risk_neighbor_count) for vertices with at least one
    high-risk neighbour; the same counts as :func:`neighbor_counts`, zeros left out.

    Only edges with a high-risk end are needed. With ``spans`` (``_chunk, id, _mask``: the snapshots in which a vertex is
    high-risk) an edge meets each of its ends once, its mask is cut to the snapshots in which that end is high-risk, and the
    counts are running sums of changes: nothing is copied for a snapshot. Without, the high-risk set meets the
    endpoint-bucketed edge copies (``Graph.gather``, inner join), so no edge is
    shuffled; each such end adds 1 to the vertex at the other end.
    """
    k = graph.key_list
    on = [*k, "id"]
    if spans is not None and graph.spans is not None:
        risk = spans.withColumnRenamed(MASK, "_risk")
        hot = None if graph.no_hub else hot_keys(_ends(graph.spans).groupBy(CHUNK_COL, "id").agg(F.count(F.lit(1)).alias("n")), [CHUNK_COL, "id"], "n", graph.skew, 2 * graph.sizes()[1], graph._paths)
        ends = []
        for end, other in (("src", "dst"), ("dst", "src")):
            named = None if hot is None else hot.withColumnRenamed("id", end)
            met = salted_join(graph.spans, risk.withColumnRenamed("id", end), [CHUNK_COL, end], named, F.col(other))
            both = F.col(MASK).bitwiseAND(F.col("_risk"))
            ends.append(met.select(CHUNK_COL, F.col(other).alias("id"), both.alias(MASK)).where(F.col(MASK) != 0))
        return counts_by_snapshot(ends[0].unionByName(ends[1]), "id", "high_risk_neighbor_count", graph.snapshots).select(*on, "high_risk_neighbor_count")
    risky = nodes.select(*on).join(graph.vertices, on, "left_semi")
    to_src = graph.gather("dst", risky).select(*k, F.col("src").alias("id"))
    to_dst = graph.gather("src", risky).select(*k, F.col("dst").alias("id"))
    return (
        to_src.unionByName(to_dst)
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("high_risk_neighbor_count"))
    )
