"""Label propagation (community detection), synchronous, fixed rounds.

Start label = own id. In each round every edge sends the label of each end
to the other end (direction ignored; a reciprocal pair sends two votes, a
self-loop two votes for the vertex's own label). A vertex takes the label
with the most votes, ties broken by the smallest label; without votes it
keeps its label. Bipartite parts may swap labels forever; that is kept.

A vertex with an edge has votes in every round, and one without never has any. So the state of a round is its winners alone,
which meet no older state; the vertices without votes get their own id after the last round. In the first round the label of each end
is its id, and the votes are the edges.

Per later round: the labels meet the edges twice, once partitioned by source (the
source's label is a vote for the destination) and once by destination (a
vote for the source); both edge copies are partitioned once per run and the labels are written
partitioned alike, so only votes move, once: to the bucket of their vertex. Of a numbered graph a vote is one long (snapshot, vertex and
label), and a task sorts the votes of its bucket in numpy and takes the longest run of each vertex; ids and snapshots whose product does not
fit a long are counted per label by two aggregations. If a vertex is hot, votes are counted per (vertex, label) with partial
aggregation first, then the winner per vertex (again partial, so a hub with
millions of distinct labels is reduced before its final task). There the count and the label
are one long, if the graph is numbered, whose maximum needs no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netfeat.constants import LABEL_PROPAGATION_ITERATIONS
from netfeat.operators.graph import Graph


def _winner(graph: Graph) -> tuple[Column, Column]:
    """The aggregate of (n, label) rows that finds the most votes, ties to the smallest label, and the label of its value ``best``."""
    n, label, best = F.col("n"), F.col("label"), F.col("best")
    if graph._ids is not None:
        bits = graph._ids.bit_length()
        if bits + (2 * graph.sizes()[1]).bit_length() <= 62:  # a vertex has two votes an edge at most
            last = (1 << bits) - 1
            return F.max(F.shiftleft(n, bits) + (F.lit(last) - label)), F.lit(last) - best.bitwiseAND(F.lit(last))
    return F.min(F.struct((-n).alias("neg_votes"), label)), F.col("best.label")


def _winners_task(ids: int):
    """For mapInArrow: votes ``(snap * ids + id) * ids + label``, all of a vertex in one task -> (snap, id, label) of the label with the
    most votes for each vertex, ties to the smallest. A task holds a long for each of its votes."""

    # all of it is inside, so that workers need no copy of this package
    def winners(batches):
        import numpy as np
        import pyarrow as pa

        votes = [batch.column(0).to_numpy() for batch in batches]
        if not sum(map(len, votes)):
            return
        votes = np.concatenate(votes)
        votes.sort()

        def begins(x):
            return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))

        def lengths(starts, total):
            return np.diff(starts, append=total)

        runs = begins(votes)
        n = lengths(runs, len(votes))
        votes = votes[runs]
        vertex = votes // ids
        of_vertex = begins(vertex)
        most = np.repeat(np.maximum.reduceat(n, of_vertex), lengths(of_vertex, len(n)))
        best = np.flatnonzero(n == most)  # labels of a vertex ascend
        best = best[begins(vertex[best])]
        vertex, label = vertex[best], votes[best] % ids
        snap, id_ = vertex // ids, vertex % ids
        columns = [pa.array(snap.astype(np.int32)), pa.array(id_), pa.array(label)]
        yield pa.RecordBatch.from_arrays(columns, names=["snap", "id", "label"])

    return winners


def _winners(graph: Graph, votes: DataFrame) -> DataFrame:
    """``votes`` (*keys, id, label) -> (*keys, id, label): the winner of every vertex with votes."""
    on, spread, ids = [*graph.keys, "id"], graph.hot() is not None, graph._ids
    if not spread and ids and graph.snapshots and graph.snapshots * ids * ids < 1 << 63:
        vote = ((F.col(graph.keys[0]).cast("long") * ids + F.col("id")) * ids + F.col("label")).alias("vote")
        dealt = votes.select(vote).repartition(graph.buckets(), F.expr(f"vote div {ids}L"))
        return dealt.mapInArrow(_winners_task(ids), f"{graph.keys[0]} int, id long, label long")
    if not spread:
        votes = votes.repartition(graph.buckets(), *on)
    most, of_best = _winner(graph)
    return (
        votes.groupBy(*on, "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*on)
        .agg(most.alias("best"))
        .select(*on, of_best.alias("label"))
    )


def label_propagation(graph: Graph, max_iter: int = LABEL_PROPAGATION_ITERATIONS) -> DataFrame:
    """(*keys, id, label) for every vertex."""
    k = graph.key_list
    on = [*k, "id"]
    state = None
    for i in range(max_iter):
        if state is None:
            ends = F.array(
                F.struct(F.col("dst").alias("id"), F.col("src").alias("label")),
                F.struct(F.col("src").alias("id"), F.col("dst").alias("label")),
            )
            votes = graph.edges.select(*k, F.explode(ends).alias("v")).select(*k, "v.id", "v.label")
        else:
            to_dst = graph.gather("src", state.frame).select(*k, F.col("dst").alias("id"), "label")
            to_src = graph.gather("dst", state.frame).select(*k, F.col("src").alias("id"), "label")
            votes = to_dst.unionByName(to_src)
        best = _winners(graph, votes)
        if i == max_iter - 1:
            best = graph.vertex_table().join(best.hint("shuffle_hash"), on, "left").select(
                *on, F.coalesce("label", "id").alias("label")
            )
        state = graph.put(best, old=state)
    return graph.vertex_table().select(*on, F.col("id").alias("label")) if state is None else state.frame
