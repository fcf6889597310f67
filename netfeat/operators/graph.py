"""Graph construction, degree, and per-snapshot statistics.

A graph is a pair of DataFrames: vertices ``(*keys, id)`` and edges
``(*keys, src, dst)``. ``keys`` are the snapshot columns (or none for a
single graph); every operator groups and joins on them, so one pass serves
all snapshots at once.
"""

from __future__ import annotations

import math
import threading
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import COUNTERPARTY, ENTITY, SENTINEL_IDS
from netfeat.functions import valid_id
from netfeat.operators.skew import DEFAULT_SKEW, N_SALT, SkewConfig, hot_keys, salted_join
from netfeat.operators.timeline import CHUNK_COL, MASK, SNAP, counts_by_snapshot
from netfeat.session import checkpoint_dir, cut_lineage, delete_path

# Edge rows per partition of the endpoint-partitioned edge copies.
EDGES_PER_PARTITION = 2_000_000


class VertexTable(NamedTuple):
    """Per-vertex state ``(*keys, id, ...)``, written once and bucketed like the edge copies."""

    frame: DataFrame
    name: str
    path: str


@dataclass
class Graph:
    """Vertices ``(*keys, id)`` and edges ``(*keys, src, dst)`` of one graph, or of
    many snapshot graphs at once (``keys``), with what the algorithms share:
    sizes, hot vertices, salted endpoint joins for one-shot look-ups,
    endpoint-bucketed edge copies for per-round look-ups (:meth:`gather`) and vertex
    state bucketed alike (:meth:`put`).
    Call :meth:`release` when no lazy frame reads the bucketed copies any more.

    ``spans`` (``_chunk, src, dst, _mask``), if known, are the edges once each with the snapshots they
    hold in (:mod:`netfeat.operators.timeline`); ``keys`` is then ``("snap",)``, and ``snapshots`` their number.
    """

    vertices: DataFrame
    edges: DataFrame
    keys: tuple[str, ...] = ()
    skew: SkewConfig = DEFAULT_SKEW
    spans: DataFrame | None = None
    snapshots: int | None = None
    no_hub: bool = False
    _hot: object = field(default=None, repr=False)
    _hot_done: bool = field(default=False, repr=False)
    _sizes: tuple[int, int] | None = field(default=None, repr=False)
    _ids: int | None = field(default=None, repr=False)
    _by_endpoint: dict = field(default_factory=dict, repr=False)
    _tables: list = field(default_factory=list, repr=False)
    _paths: list = field(default_factory=list, repr=False)
    _vertex_table: VertexTable | None = field(default=None, repr=False)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _vertex_lock: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _endpoint_locks: dict = field(
        default_factory=lambda: {"src": threading.Lock(), "dst": threading.Lock()}, repr=False
    )

    @property
    def key_list(self) -> list[str]:
        return list(self.keys)

    def sizes(self) -> tuple[int, int]:
        """(vertex rows, edge rows) over all snapshots; known from the build, or two small count jobs, once."""
        with self._lock:
            if self._sizes is None:
                self._sizes = (self.vertices.count(), self.edges.count())
            return self._sizes

    def know_sizes(self, vertices: int, edges: int, ids: int | None = None) -> None:
        """``ids``: a bound above every id, if the ids are numbers from 0 on."""
        self._sizes, self._ids = (vertices, edges), ids

    def know_none_hot(self) -> None:
        """For a build that has seen that no id is in more edges, over all snapshots, than the skew threshold."""
        self._hot, self._hot_done, self.no_hub = None, True, True

    def hot(self) -> DataFrame | None:
        """Vertices whose degree exceeds the skew threshold (bounded table) or None."""
        bound = 2 * self.sizes()[1]  # a degree never exceeds twice the edge rows
        with self._lock:
            if not self._hot_done:
                self._hot = hot_keys(degrees(self), [*self.keys, "id"], "degree", self.skew, bound, self._paths)
                self._hot_done = True
            return self._hot

    def join_endpoint(self, edges: DataFrame, endpoint: str, table: DataFrame, how: str = "inner") -> DataFrame:
        """Attach a per-vertex table ``(*keys, id, ...)`` to ``edges`` on ``src`` or ``dst``.

        Edges of hub vertices are salted by the other endpoint, so one hub does
        not end in a single task.
        """
        other = "dst" if endpoint == "src" else "src"
        hot = self.hot()
        if hot is not None:
            hot = hot.withColumnRenamed("id", endpoint)
        return salted_join(
            edges, table.withColumnRenamed("id", endpoint), [*self.keys, endpoint], hot, F.col(other), how
        )

    def by_endpoint(self, endpoint: str) -> tuple[DataFrame, DataFrame | None]:
        """Edges for repeated look-ups on ``endpoint``, built once per graph.

        Returns (cold, hot): ``cold`` are the edges of non-hot endpoints,
        written once as a table bucketed on ``(*keys, endpoint)`` in the
        checkpoint folder, so every later join on the endpoint reads them
        in place and only the other (vertex-sized) side is shuffled; ``hot``
        are the edges of hot endpoints (or None), checkpointed as they are.
        """
        with self._endpoint_locks[endpoint]:
            if endpoint not in self._by_endpoint:
                spark = self.edges.sparkSession
                k = self.key_list
                n = self.buckets()
                e = self.edges.select(*k, "src", "dst")
                hot = self.hot()
                hot_edges = None
                if hot is not None:
                    h = hot.select(*k, F.col("id").alias(endpoint))
                    hot_edges = cut_lineage(e.join(h, [*k, endpoint], "left_semi"))
                    e = e.join(h, [*k, endpoint], "left_anti")
                name = f"netfeat_edges_by_{endpoint}_{uuid.uuid4().hex[:16]}"
                path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
                with self._lock:  # before the write, so that a failed one is cleaned up too
                    self._tables.append(name)
                    self._paths.append(path)
                (
                    e.repartition(n, *k, endpoint)  # one file per bucket
                    .write.bucketBy(n, *k, endpoint)
                    .mode("error")
                    .option("path", path)
                    .saveAsTable(name)
                )
                self._by_endpoint[endpoint] = (spark.table(name), hot_edges)
            return self._by_endpoint[endpoint]

    def buckets(self) -> int:
        """Buckets of the edge copies and the vertex state."""
        spark = self.edges.sparkSession
        # beyond Spark's limit the buckets grow instead
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
        n = max(spark.sparkContext.defaultParallelism, math.ceil(max(self.sizes()) / EDGES_PER_PARTITION))
        return min(n, most)

    def put(self, state: DataFrame, old: VertexTable | None = None) -> VertexTable:
        """Write ``state`` ``(*keys, id, ...)`` bucketed on ``(*keys, id)`` and drop ``old``, which it was made from.

        A round that joins the new state with the edge copies, or with sums per vertex, shuffles neither the state nor
        the edges: only the partial sums move. The table also cuts the lineage; it is in the shared folder and
        survives the loss of executors."""
        spark, on, n = state.sparkSession, [*self.keys, "id"], self.buckets()
        name = f"netfeat_state_{uuid.uuid4().hex[:16]}"
        path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
        with self._lock:
            self._tables.append(name)
            self._paths.append(path)
        (
            state.repartition(n, *on)  # already so after a join with another such table
            .write.bucketBy(n, *on).mode("error").option("path", path).saveAsTable(name)
        )
        if old is not None:
            spark.sql(f"DROP TABLE IF EXISTS {old.name}")
            delete_path(spark, old.path)
            with self._lock:
                self._tables.remove(old.name)
                self._paths.remove(old.path)
        return VertexTable(spark.table(name), name, path)

    def vertex_table(self) -> DataFrame:
        """The vertices, bucketed; written once."""
        with self._vertex_lock:
            if self._vertex_table is None:
                self._vertex_table = self.put(self.vertices.select(*self.keys, "id"))
            return self._vertex_table.frame

    def release(self, delete_files: bool = False) -> None:
        """Drop the catalog entries of the bucketed edge copies and vertex state; with ``delete_files``
        also their files (only when no frame reads them any more)."""
        spark = self.edges.sparkSession
        with self._endpoint_locks["src"], self._endpoint_locks["dst"], self._lock:
            for name in self._tables:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            self._tables.clear()
            self._by_endpoint.clear()
            self._vertex_table = None
            if delete_files:
                for path in self._paths:
                    delete_path(spark, path)
                self._paths.clear()

    def gather(self, endpoint: str, state: DataFrame) -> DataFrame:
        """Edges joined with per-vertex ``state`` ``(*keys, id, ...)`` on ``endpoint``,
        for iterative algorithms.

        The edge copy of :meth:`by_endpoint` is bucketed on the join key, so
        only the (vertex-sized) state is shuffled to meet it, in every round; the state of a bucket,
        a row for each vertex of at most ``EDGES_PER_PARTITION``, is hashed, so that the edges are not sorted again.
        Edges of hot vertices meet the state of those vertices in a salted join.
        """
        k = self.key_list
        on = [*k, endpoint]
        cold, hot_edges = self.by_endpoint(endpoint)
        s = state.withColumnRenamed("id", endpoint)
        out = cold.join(s.hint("shuffle_hash"), on)
        if hot_edges is not None:
            hot = self.hot().withColumnRenamed("id", endpoint)
            s_hot = s.join(hot.drop(N_SALT), on, "left_semi")
            other = "dst" if endpoint == "src" else "src"
            out = out.unionByName(salted_join(hot_edges, s_hot, on, hot, F.col(other)))
        return out


def build_graph(
    trxn: DataFrame,
    keys: Iterable[str] = (),
    src_col: str = ENTITY,
    dst_col: str = COUNTERPARTY,
    sentinels: Iterable[str] = SENTINEL_IDS,
    skew: SkewConfig = DEFAULT_SKEW,
) -> Graph:
    """Directed simple graph of a transaction table.

    Vertices: every valid id on either side, also when its partner is not
    valid. Edges: distinct (src, dst) with both ends valid; self-loops kept.
    """
    keys = tuple(keys)
    sentinels = tuple(sentinels)
    vertices = (
        trxn.select(*keys, F.explode(F.array(F.col(src_col), F.col(dst_col))).alias("id"))
        .where(valid_id(F.col("id"), sentinels))
        .distinct()
    )
    edges = (
        trxn.select(*keys, F.col(src_col).alias("src"), F.col(dst_col).alias("dst"))
        .where(valid_id(F.col("src"), sentinels) & valid_id(F.col("dst"), sentinels))
        .distinct()
    )
    return Graph(vertices, edges, keys, skew)


def _ends(spans: DataFrame) -> DataFrame:
    return spans.select(CHUNK_COL, MASK, F.explode(F.array("src", "dst")).alias("id"))


def degrees(graph: Graph) -> DataFrame:
    """In + out degree per vertex with at least one edge; a self-loop counts 2.

    Map-side partial counts make a hub vertex cheap. With ``spans`` the count of every snapshot is a running sum of
    changes, and no edge is copied for a snapshot.
    """
    k = graph.key_list
    if graph.spans is not None:
        return counts_by_snapshot(_ends(graph.spans), "id", "degree", graph.snapshots).select(SNAP, "id", "degree")
    return (
        graph.edges.select(*k, F.explode(F.array("src", "dst")).alias("id"))
        .groupBy(*k, "id")
        .agg(F.count(F.lit(1)).alias("degree"))
    )


def out_degrees(graph: Graph) -> DataFrame:
    if graph.spans is not None:
        return counts_by_snapshot(graph.spans.withColumnRenamed("src", "id"), "id", "out_degree", graph.snapshots)
    k = graph.key_list
    return graph.edges.groupBy(*k, F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def graph_stats(
    graph: Graph, components: DataFrame | None = None, labels: DataFrame | None = None
) -> DataFrame:
    """Per snapshot: vertices, edges, self-loops, isolated vertices, and optionally
    the number of components and of communities. One row per key.

    One aggregation over a union of tagged facts (one job, no joins between the
    counts), partial on the map side.
    """
    k = graph.key_list
    touched = degrees(graph).select(*k, "id")
    parts = [
        graph.vertices.select(*k, F.lit(1).alias("is_vertex")),
        graph.edges.select(
            *k, F.lit(1).alias("is_edge"), (F.col("src") == F.col("dst")).cast("int").alias("is_loop")
        ),
        graph.vertices.join(touched, [*k, "id"], "left_anti").select(*k, F.lit(1).alias("is_isolated")),
    ]
    aggs = [
        F.sum("is_vertex").cast("long").alias("n_vertices"),
        F.coalesce(F.sum("is_edge"), F.lit(0)).cast("long").alias("n_edges"),
        F.coalesce(F.sum("is_loop"), F.lit(0)).cast("long").alias("n_self_loops"),
        F.coalesce(F.sum("is_isolated"), F.lit(0)).cast("long").alias("n_isolated"),
    ]
    if components is not None:
        # a component is named by its own smallest member
        parts.append(components.where(F.col("id") == F.col("component")).select(*k, F.lit(1).alias("is_component")))
        aggs.append(F.coalesce(F.sum("is_component"), F.lit(0)).cast("long").alias("n_components"))
    if labels is not None:
        parts.append(labels.select(*k, "label").distinct().select(*k, F.lit(1).alias("is_community")))
        aggs.append(F.coalesce(F.sum("is_community"), F.lit(0)).cast("long").alias("n_communities"))
    facts = parts[0]
    for p in parts[1:]:
        facts = facts.unionByName(p, allowMissingColumns=True)
    return facts.groupBy(*k).agg(*aggs).where(F.col("n_vertices").isNotNull())
