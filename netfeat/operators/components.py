"""Weakly connected components by alternating large-star / small-star.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii, "Connected Components
in MapReduce and Beyond" (SoCC 2014). Edges are kept undirected as pairs
(a, b) with a < b. Each round:

- large-star: for every u, m(u) = min(u, neighbours of u); every neighbour
  v > u is linked to m(u);
- small-star: for every u, m(u) = min(u, neighbours smaller than u); u and
  those neighbours are linked to m(u).

The edge set converges to one star per component centred on its smallest
id, in O(log^2 n) rounds, unlike plain min-label spreading whose round count
is the diameter. The rounds begin with fewer edges than the graph has:

- a numbered graph (``Graph.spans``) is first reduced within its partitions: a union-find over the edges of a
  partition, for every snapshot, hands on one edge from each vertex to the smallest vertex it reaches there
  (fewer edges than the partition has vertices). In its rounds the small star is such a reduction as well: the edges are dealt by
  their larger end to a few tasks a snapshot, of ``GROUP_EDGES`` edges each (:func:`_merge_rounds`);
- otherwise two cheap rounds of min-label spreading on the static
  graph come first (edges stay in place, only labels move), and the star rounds run on
  the edges between labels.

The star centres grow into hubs by construction (the
centre of a giant component ends with one edge per member), so both
look-ups of m(u) are salted on hot centres, found each round from the same
aggregation that computes m(u).

A star step turns every edge into one edge, so the set never grows, and each edge carries whether it moved: the
loop ends, exactly, with the first round that moved none. The edge set is written to the
checkpoint folder in every round.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from netfeat.operators.graph import Graph
from netfeat.operators.skew import SkewConfig, hot_keys, salted_join
from netfeat.operators.timeline import CHUNK, CHUNK_COL, MASK, SNAP
from netfeat.session import checkpoint_dir, cut_lineage, delete_path

MAX_ROUNDS = 1_000
#: Edges that a task collects, over all snapshots, before it reduces them to a forest.
FOREST_EDGES = 2_000_000
#: Edges of a snapshot that are dealt to one task of a merge, about.
GROUP_EDGES = 4_000_000


def _written(df: DataFrame, paths: list[str]) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder; its folder is added to ``paths``, whose owner deletes it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/netfeat_stars_{uuid.uuid4().hex[:16]}"
    paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _lookup_min(
    edges: DataFrame, mins: DataFrame, key: str, other: str, k: list[str], skew: SkewConfig, bound: int, paths: list[str]
) -> DataFrame:
    """edges joined with m on ``key``; centres with many edges are salted. Where there may be such, ``mins`` is
    written, so that finding them does not compute it a second time."""
    mins = mins.withColumnRenamed("u", key)
    if bound > skew.threshold:
        mins = _written(mins, paths)
    hot = hot_keys(mins, [*k, key], "deg", skew, bound, paths)
    return salted_join(edges, mins.select(*k, key, "m"), [*k, key], hot, F.col(other))


def _star_round(edges: DataFrame, k: list[str], skew: SkewConfig, bound: int, paths: list[str]) -> DataFrame:
    """Large-star, then small-star on canonical edges (a < b): (*k, a, b, moved), each edge once."""
    ends = F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    mins = (
        edges.select(*k, F.explode(ends).alias("p")).select(*k, "p.u", "p.v")
        .groupBy(*k, "u")
        .agg(F.min("v").alias("mv"), F.count(F.lit(1)).alias("deg"))
        .select(*k, "u", F.least("u", "mv").alias("m"), "deg")
    )
    # every larger neighbour b of a goes to m(a); m(a) <= a < b
    large = _lookup_min(edges, mins, "a", "b", k, skew, 2 * bound, paths).select(
        *k, F.col("m").alias("a"), "b", (F.col("m") != F.col("a")).alias("moved")
    )
    large = _written(large, paths)  # read for the minimums and for their look-up
    least = large.groupBy(*k, F.col("b").alias("u")).agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("deg"))
    # the edge of b to its smallest neighbour m stays; its other smaller neighbours go to m
    stays = F.col("a") == F.col("m")
    small = _lookup_min(large, least, "b", "a", k, skew, bound, paths).select(
        *k, F.col("m").alias("a"), F.when(stays, F.col("b")).otherwise(F.col("a")).alias("b"),
        (F.col("moved") | ~stays).alias("moved"),
    )
    return small.groupBy(*k, "a", "b").agg(F.max("moved").alias("moved"))


def _min_label_rounds(graph: Graph, rounds: int) -> DataFrame:
    """(*keys, id, label): ``rounds`` rounds of min-label spreading on the static graph.

    Each label is an id of the same component, never above the vertex's own.
    The edges are read in place from the bucketed copies (``Graph.gather``);
    only vertex labels and partially aggregated minimums move.
    """
    k = graph.key_list
    on = [*k, "id"]
    labels, state = graph.vertex_table().select(*on, F.col("id").alias("label")), None
    for _ in range(rounds):
        to_dst = graph.gather("src", labels).select(*k, F.col("dst").alias("id"), "label")
        to_src = graph.gather("dst", labels).select(*k, F.col("src").alias("id"), "label")
        best = to_dst.unionByName(to_src).groupBy(*on).agg(F.min("label").alias("m"))
        state = graph.put(
            labels.join(best, on, "left").select(*on, F.least("label", F.coalesce("m", "label")).alias("label")), old=state
        )
        labels = state.frame
    return labels


def _forest_task(masks: bool):
    """For mapInArrow: rows (_chunk, src, dst, _mask) or, without ``masks``, (snap, a, b, moved) with a < b, ids as longs -> for
    every snapshot an edge (snap, a, b, moved) from the smallest vertex of each tree of a spanning forest of the task's edges to each
    other vertex of it. ``moved`` is true for a snapshot of which the task had an edge that moved or that is not among those it returns.

    The state of a task is one tree edge for each vertex that it has seen in a snapshot, and a bounded number of
    edges on top; the batches are Arrow arrays of longs. The function is pure, so a task may run again."""
    chunk, limit = CHUNK, FOREST_EDGES

    # all of it is inside, so that workers need no copy of this package
    def forests(batches):
        import numpy as np
        import pyarrow as pa

        def stars(a, b):
            ids, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
            label, first, second = np.arange(len(ids)), ends[: len(a)], ends[len(a) :]
            u, v = first, second
            while len(u):
                u, v = label[u], label[v]
                low, high = np.minimum(u, v), np.maximum(u, v)
                open_ = low < high
                u, v = low[open_], high[open_]
                np.minimum.at(label, v, u)
                while True:
                    jumped = label[label]
                    if (jumped == label).all():
                        break
                    label = jumped
            member = np.flatnonzero(label != np.arange(len(ids)))
            return ids[label[member]], ids[member], bool((label[second] != first).any())

        held, waiting, moved, n = {}, {}, set(), 0

        def reduce():
            for snap, parts in waiting.items():
                a, b = (np.concatenate(x) for x in zip(*parts, held.get(snap, (np.zeros(0, np.int64),) * 2)))
                *held[snap], changed = stars(a, b)
                if changed:
                    moved.add(snap)
            waiting.clear()

        def masked(batch):
            of, src, dst, mask = (batch.column(c).to_numpy() for c in range(4))
            for c in np.unique(of).tolist():
                mine = of == c
                some = int(np.bitwise_or.reduce(mask[mine]))
                for bit in range(chunk):
                    if some >> bit & 1:
                        edge = mine & ((mask >> bit) & 1 == 1) & (src != dst)
                        yield c * chunk + bit, src[edge], dst[edge]

        def plain(batch):
            of, a, b, before = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            moved.update(np.unique(of[before]).tolist())
            for snap in np.unique(of).tolist():
                yield snap, a[of == snap], b[of == snap]

        for batch in batches:
            for snap, a, b in masked(batch) if masks else plain(batch):
                waiting.setdefault(snap, []).append((a, b))
                n += len(a)
            if n >= limit:
                reduce()
                n = 0
        reduce()
        for snap, (a, b) in held.items():
            columns = [np.full(len(a), snap, np.int32), a, b, np.full(len(a), snap in moved)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["snap", "a", "b", "moved"])

    return forests


_FOREST = f"{SNAP} int, a long, b long, moved boolean"


def _local_forests(spans: DataFrame) -> DataFrame:
    """(snap, a, b, moved): the forests of the partitions of ``spans`` (_chunk, src, dst, _mask; ids as longs)."""
    return spans.select(CHUNK_COL, "src", "dst", MASK).mapInArrow(_forest_task(True), _FOREST)


def _merged(edges: DataFrame, groups: DataFrame, tasks: int) -> DataFrame:
    """The forests of ``edges`` (snap, a, b, moved) dealt by their larger end to the ``groups`` (snap, _groups, _before) of their
    snapshot, and these in turn to the ``tasks``. A vertex is the larger end of a task's edge once at most, so no vertex is hot in a later deal."""
    task = F.pmod(F.col("_before") + F.pmod(F.xxhash64("b"), F.col("_groups")), F.lit(tasks)).cast("int")
    dealt = edges.join(F.broadcast(groups), SNAP).select(SNAP, "a", "b", "moved", task.alias("_task"))
    return dealt.repartitionById(tasks, F.col("_task")).select(SNAP, "a", "b", "moved").mapInArrow(_forest_task(False), _FOREST)


def _groups(edges: DataFrame) -> DataFrame:
    """(snap, _groups, _before): the tasks that share a snapshot's edges, two at least, and the tasks of those before it. A row a
    snapshot comes to the driver (``MAX_SNAPSHOTS`` bounds them)."""
    rows, before = [], 0
    for snap, n in sorted(tuple(r) for r in edges.groupBy(SNAP).count().collect()):
        rows.append((snap, max(2, -(-n // GROUP_EDGES)), before))
        before += rows[-1][1]
    return edges.sparkSession.createDataFrame(rows, f"{SNAP} int, _groups long, _before long")


def _merge_rounds(edges: DataFrame, skew: SkewConfig, bound: int, tasks: int, max_rounds: int, paths: list[str]) -> DataFrame:
    """Rounds on the forests ``edges`` (snap, a, b, moved) of a numbered graph until none moves an edge; returns the final stars
    (centre a, member b), each edge once. ``paths`` as of :func:`_star_rounds`.

    The smallest vertex that a is linked to takes the place of a in each of its edges (the large star); then the edges of every
    b meet in one task, which links all that it reaches (the small star, and more), so a round is a look-up and a deal. Centres of many edges
    are salted in the look-up. If no centre has a smaller one and no task changes an edge, each b has one edge, to a vertex without any."""
    spark, on = edges.sparkSession, [SNAP, "a"]
    groups = _groups(edges)
    for k in range(max_rounds):
        before = list(paths)
        if k:
            hot = hot_keys(edges.groupBy(*on).agg(F.count(F.lit(1)).alias("deg")), on, "deg", skew, bound, paths)
            least = edges.groupBy(SNAP, F.col("b").alias("a")).agg(F.min("a").alias("m"))
            edges = salted_join(edges.select(SNAP, "a", "b"), least, on, hot, F.col("b"), "left").select(
                SNAP, F.coalesce("m", "a").alias("a"), "b", F.col("m").isNotNull().alias("moved")
            )
        helpers = paths[len(before):]
        edges = _written(_merged(edges, groups, tasks), paths)
        for path in (*before, *helpers):
            delete_path(spark, path)
            paths.remove(path)
        if k and edges.where("moved").isEmpty():
            return edges.drop("moved")
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")


def _star_rounds(
    edges: DataFrame, k: list[str], skew: SkewConfig, bound: int, max_rounds: int, paths: list[str]
) -> DataFrame:
    """Star rounds on canonical edges (a < b), each once, until none moves; returns the final stars (centre a, member b).
    ``bound``: an upper bound of their number. ``paths``: the folders behind ``edges``, and at the end those of the
    stars; each round's are deleted when the next one's edges are written."""
    spark = edges.sparkSession
    for _ in range(max_rounds):
        before = list(paths)
        small = _star_round(edges, k, skew, bound, paths)
        helpers = paths[len(before):]
        after = _written(small, paths)
        edges = after.drop("moved")
        for path in (*before, *helpers):
            delete_path(spark, path)
            paths.remove(path)
        if after.where("moved").isEmpty():
            return edges
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")


def connected_components(graph: Graph, spread_rounds: int = 2, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """(*keys, id, component) where component is the smallest id of the component.

    Isolated vertices are components of their own. A numbered graph hands on the forests of its partitions to the star
    rounds. For any other, ``spread_rounds``
    rounds of min-label spreading run on the static graph first, where only labels
    move; every edge is then replaced by the pair of its end labels, and the star rounds run on that contracted (much
    smaller) edge set. ``max_rounds`` only guards against a bug.
    """
    k = graph.key_list
    on = [*k, "id"]
    skew = graph.skew
    bound = graph.sizes()[1]
    paths: list[str] = []
    try:
        return _components(graph, k, on, skew, bound, spread_rounds, max_rounds, paths)
    finally:
        for path in paths:
            delete_path(graph.edges.sparkSession, path)


def _components(
    graph: Graph, k: list[str], on: list[str], skew: SkewConfig, bound: int, spread_rounds: int, max_rounds: int, paths: list[str]
) -> DataFrame:
    if graph.spans is not None and graph.spans.schema["src"].dataType == LongType():
        forest = _written(_local_forests(graph.spans), paths)
        stars = _merge_rounds(forest, skew, bound, graph.buckets(), max_rounds, paths)
        centre = stars.select(*k, F.col("b").alias("id"), F.col("a").alias("centre"))
        return cut_lineage(
            graph.vertex_table().join(centre, on, "left").select(*on, F.coalesce("centre", "id").alias("component"))
        )
    if spread_rounds > 0:
        labels = _min_label_rounds(graph, spread_rounds)
        ends = graph.gather("src", labels.withColumnRenamed("label", "ls"))
        ends = graph.join_endpoint(ends, "dst", labels.withColumnRenamed("label", "ld"))
        lo, hi = F.least("ls", "ld"), F.greatest("ls", "ld")
    else:
        labels = graph.vertices.select(*on, F.col("id").alias("label"))
        ends = graph.edges
        lo, hi = F.least("src", "dst"), F.greatest("src", "dst")
    contracted = _written(
        ends.select(*k, lo.alias("a"), hi.alias("b")).where(F.col("a") != F.col("b")).distinct(), paths
    )
    stars = _star_rounds(contracted, k, skew, bound, max_rounds, paths)
    # centre of every label that is a star member; other labels are centres themselves
    centre = stars.select(*k, F.col("b").alias("label"), F.col("a").alias("centre"))
    # many vertices share a label (that is the point of spreading): hot labels are salted
    per_label = labels.groupBy(*k, "label").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(per_label, [*k, "label"], "n", skew, graph.sizes()[0], paths)
    out = salted_join(labels, centre, [*k, "label"], hot, F.col("id"), "left").select(
        *k, "id", F.coalesce("centre", "label").alias("component")
    )
    return cut_lineage(out)


def component_sizes(components: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, component, network_size)."""
    return components.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("network_size"))


def network_sizes(
    components: DataFrame, keys: list[str], skew: SkewConfig, bound: int | None = None
) -> DataFrame:
    """(*keys, id, network_size): size of each vertex's component.

    Giant components are hot keys of the size look-up, so it is salted.
    ``bound``: the vertex count, if known (no component is larger).
    """
    sizes = component_sizes(components, keys)
    hot = hot_keys(sizes, [*keys, "component"], "network_size", skew, bound)
    return salted_join(components, sizes, [*keys, "component"], hot, F.col("id")).select(
        *keys, "id", "network_size"
    )
