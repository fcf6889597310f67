"""Network features on Spark: per-entity graph features of payment snapshots."""

from netfeat.operators.graph import Graph, build_graph, degrees
from netfeat.operators.skew import SkewConfig
from netfeat.plans.features import centrality_features, neighbor_features, network_features, prepare, run

__all__ = [
    "Graph",
    "SkewConfig",
    "build_graph",
    "centrality_features",
    "degrees",
    "neighbor_features",
    "network_features",
    "prepare",
    "run",
]
