"""Composite feature jobs.

- :func:`centrality_features` (degree, PageRank, placeholder eigenvector
  score, community size / density / average degree, component size) and
  :func:`neighbor_features` (high-risk neighbour count) work on one graph or
  on many snapshot graphs at once (``graph.keys``).
- :func:`network_features` assigns transactions to every (vintage, window)
  snapshot of the driver table in one join, runs both feature sets over all
  snapshots together, turns windows into columns and joins the drivers.
- :func:`run` reads, computes and writes, optionally a few vintages per batch, and can go on
  where an earlier run of the same inputs stopped.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netfeat.constants import (
    CENTRALITY_COLUMNS,
    COUNTERPARTY,
    DEFAULT_WINDOWS,
    EIGENVECTOR_PLACEHOLDER,
    ENTITY,
    VINTAGE,
    WINDOW,
)
from netfeat.operators.community import community_metrics, vertex_communities
from netfeat.operators.components import connected_components, network_sizes
from netfeat.operators.graph import Graph, degrees
from netfeat.operators.labels import label_propagation
from netfeat.operators.neighbors import risky_neighbor_counts
from netfeat.operators.numbering import dense_numbers
from netfeat.operators.pagerank import pagerank
from netfeat.operators.risk import add_dated_risk_flags, add_risk_flags, flag_columns
from netfeat.operators.skew import DEFAULT_SKEW, SkewConfig, hot_keys, salted_join
from netfeat.operators.snapshots import snapshot_table, vintages
from netfeat.operators.timeline import CHUNK, CHUNK_COL, MASK, SNAP, Timeline
from netfeat.functions import valid_id
from netfeat.session import checkpoint_dir, cut_lineage, delete_path, in_parallel, path_exists
from netfeat.sources.sinks import write_features
from netfeat.sources.tables import Source, read_driver, read_transactions


# what a fact says of an id (an edge only has the first): it is a vertex, an entity, flagged
ROLES = ("valid", "entity", "risky")


def neighbor_column(level: str) -> str:
    return f"{'vhrg' if level == 'vhrg' else 'hrg'}_neighbor_ct"


#: Columns that hold ids in the frames of a numbered graph, and those of them in which one id may fill many rows.
ID_COLUMNS = ("id", ENTITY, "src", "dst", "label", "component")
_SHARED_IDS = ("src", "dst", "label", "component")
NUMBER = "_number"


@dataclass
class SnapshotGraph:
    """A (batched) graph with the per-snapshot sets the features need."""

    graph: Graph
    entities: DataFrame  # (*keys, id): distinct EXT_ENTITYID of the snapshot's rows
    risky: DataFrame  # (*keys, id, is_high_risk): ids flagged in the snapshot's rows
    facts_path: str | None = None  # the written facts table the frames read
    timeline: Timeline | None = None  # the snapshots, if the graph is keyed by their numbers
    risky_spans: DataFrame | None = None  # (_chunk, id, _mask): vertices and the snapshots that flag them
    numbers: DataFrame | None = None  # (name, _number): the ids behind the numbers of a numbered graph

    def named(self, df: DataFrame) -> DataFrame:
        """``df`` with (VINTAGE_DT, window_m) in place of the snapshot's number and ids in place of theirs."""
        if self.timeline is None:
            return df
        df, columns = self.timeline.named(df), [c for c in df.columns if c != SNAP]
        for c in columns:
            if c not in ID_COLUMNS or self.numbers is None:
                continue
            names = self.numbers.select(F.col(NUMBER).alias(c), F.col("name").alias("_name"))
            hot = None
            if c in _SHARED_IDS:  # a hub, a giant community or component
                counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                hot = hot_keys(counts, [c], "n", self.graph.skew, sum(self.graph.sizes()), self.graph._paths)
            others = [F.col(o) for o in df.columns if o != c]
            df = salted_join(df, names, [c], hot, F.xxhash64(*others)).withColumn(c, F.col("_name")).drop("_name")
        return df.select(VINTAGE, WINDOW, *columns)

    def discard(self) -> None:
        """Delete every folder written for this graph. Only once no frame built
        from it is computed any more (for example after the features are written)."""
        self.graph.release(delete_files=True)
        if self.facts_path:
            delete_path(self.graph.edges.sparkSession, self.facts_path)
            self.facts_path = None


def prepare(
    trxn: DataFrame, keys: Iterable[str] = (), level: str = "vhrg", skew: SkewConfig = DEFAULT_SKEW,
    timeline: Timeline | None = None, numbered: bool = True,
) -> SnapshotGraph:
    """Build the graph and the entity / high-risk sets from flagged transactions.

    One pass: every row emits at most three facts: an id on either side, with the roles it plays there
    (vertex, entity, high-risk), and an edge. One aggregation (partial on the map side) removes
    repeats, and the facts are written once as a table partitioned by kind in the checkpoint folder. Edges and ids are
    partition-pruned reads of it.

    With ``timeline`` the transactions are not yet sliced: each is one row with the mask of its
    snapshots, a role holds a mask instead of a bit, and the aggregation unites the masks. A fact is stored
    once with all its snapshots; the graph is keyed by the snapshot's number, and only what an algorithm
    needs per snapshot is expanded when it is read. The ids get dense numbers in their order
    (:func:`dense_numbers`), so every later shuffle moves integers; ``SnapshotGraph.named`` brings dates and ids back.
    Numbers pay for the iterative algorithms; for one-shot counts ``numbered=False`` saves the second write.
    Otherwise ``keys`` are columns of the rows, and ids stay as they are.
    """
    spark = trxn.sparkSession
    rows, k = (trxn, list(keys)) if timeline is None else (timeline.assign(trxn), [CHUNK_COL])
    mask = F.lit(1).cast("long") if timeline is None else F.col(MASK)
    ef, cf = flag_columns(level)
    src, dst = F.col(ENTITY), F.col(COUNTERPARTY)
    ok_src, ok_dst = valid_id(src), valid_id(dst)
    zero = F.lit(0).cast("long")

    def where(condition):
        return F.when(condition, mask).otherwise(zero)

    def fact(a, b, valid, entity, risky):
        return F.struct(a.alias("a"), b.alias("b"), valid.alias("valid"), entity.alias("entity"), risky.alias("risky"))

    none = F.lit(None).cast("string")
    facts = (
        rows.select(
            *k,
            F.explode(
                F.array(
                    F.when(src.isNotNull(), fact(src, none, where(ok_src), mask, where(F.col(ef) == 1))),
                    F.when(dst.isNotNull() & (ok_dst | (F.col(cf) == 1)), fact(dst, none, where(ok_dst), zero, where(F.col(cf) == 1))),
                    F.when(ok_src & ok_dst, fact(src, dst, mask, zero, zero)),
                )
            ).alias("f"),
        )
        .where(F.col("f").isNotNull())
        .groupBy(*k, F.col("f.a").alias("a"), F.col("f.b").alias("b"))
        .agg(*(F.bit_or(f"f.{role}").alias(role) for role in ROLES))
        .withColumn("kind", F.when(F.col("b").isNull(), "id").otherwise("edge"))
    )
    path = f"{checkpoint_dir(spark).rstrip('/')}/netfeat_facts_{uuid.uuid4().hex[:16]}"
    facts.write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(facts.schema).parquet(path)
    if timeline is not None:
        return _numbered(stored, path, timeline, skew) if numbered else _snapshot_graph(stored, path, timeline, skew)
    ids = stored.where(F.col("kind") == "id")

    def having(role: str) -> DataFrame:
        return ids.where(F.col(role) != 0).select(*k, F.col("a").alias("id"))

    edges = stored.where(F.col("kind") == "edge").select(*k, F.col("a").alias("src"), F.col("b").alias("dst"))
    graph = Graph(having("valid"), edges, tuple(k), skew)
    return SnapshotGraph(graph, having("entity"), having("risky").withColumn("is_high_risk", F.lit(1)), path)


def _numbered(facts: DataFrame, facts_path: str, timeline: Timeline, skew: SkewConfig) -> SnapshotGraph:
    """The graph of stored ``facts`` (_chunk, a, b, a mask for each role, kind), with numbers for its ids.

    The facts are written again with numbers in place of ids, and the first table is deleted; hub ids are salted in the
    look-ups of an edge's two ends."""
    spark = facts.sparkSession
    paths: list[str] = []
    by_kind = {
        r["kind"]: r
        for r in facts.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.bit_count("valid")).alias("bits")).collect()
    }
    rows, bits = ({kind: (by_kind[kind][c] if kind in by_kind else 0) for kind in ("id", "edge")} for c in ("rows", "bits"))
    ids, edges = facts.where(F.col("kind") == "id"), facts.where(F.col("kind") == "edge")
    names = ids.select(F.col("a").alias("name"))
    numbers = dense_numbers(names if len(timeline) <= CHUNK else names.distinct(), "name", NUMBER, paths)
    ends = edges.select(F.explode(F.array("a", "b")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(ends, ["name"], "n", skew, 2 * rows["edge"], paths)

    def numbered(df: DataFrame, column: str, other: str, hot_ids: DataFrame | None) -> DataFrame:
        look_up = numbers.withColumnRenamed("name", column)
        hot_ids = None if hot_ids is None else hot_ids.withColumnRenamed("name", column)
        return salted_join(df, look_up, [column], hot_ids, F.col(other)).drop(column).withColumnRenamed(NUMBER, column)

    of_ids = numbered(ids.drop("b"), "a", CHUNK_COL, None).withColumn("b", F.lit(None).cast("long"))
    of_edges = numbered(numbered(edges, "a", "b", hot), "b", "a", hot)
    path = f"{checkpoint_dir(spark).rstrip('/')}/netfeat_facts_{uuid.uuid4().hex[:16]}"
    both = of_ids.unionByName(of_edges)
    both.write.partitionBy("kind").parquet(path)
    delete_path(spark, facts_path)
    sg = _snapshot_graph(spark.read.schema(both.schema).parquet(path), path, timeline, skew, numbers)
    sg.graph.know_sizes(bits["id"] or 0, bits["edge"] or 0, rows["id"])
    if hot is None:
        sg.graph.know_none_hot()
    sg.graph._paths.extend(paths)
    return sg


def _snapshot_graph(
    stored: DataFrame, path: str, timeline: Timeline, skew: SkewConfig, numbers: DataFrame | None = None
) -> SnapshotGraph:
    """The graph of stored facts (_chunk, a, b, a mask for each role, kind)."""
    ids, edges = stored.where(F.col("kind") == "id"), stored.where(F.col("kind") == "edge")

    def having(role: str) -> DataFrame:
        held = ids.where(F.col(role) != 0).select(CHUNK_COL, F.col("a").alias("id"), F.col(role).alias(MASK))
        return timeline.expand(held).select(SNAP, "id")

    spans = edges.select(CHUNK_COL, F.col("a").alias("src"), F.col("b").alias("dst"), F.col("valid").alias(MASK))
    graph = Graph(having("valid"), timeline.expand(spans).select(SNAP, "src", "dst"), (SNAP,), skew, spans, len(timeline))
    flagged = F.col("valid").bitwiseAND(F.col("risky"))
    risky_spans = ids.select(CHUNK_COL, F.col("a").alias("id"), flagged.alias(MASK)).where(F.col(MASK) != 0)
    risky = having("risky").withColumn("is_high_risk", F.lit(1))
    return SnapshotGraph(graph, having("entity"), risky, path, timeline, risky_spans, numbers)


def centrality_features(sg: SnapshotGraph) -> DataFrame:
    """(*keys, EXT_ENTITYID, degree_centrality, pagerank_centrality,
    eigenvector_centrality, community_size, community_density, average_degree,
    network_size) for vertices with at least one edge that occur as entity.

    The algorithm results are checkpointed, so the returned frame does not
    read the graph's bucketed edge copies; call ``sg.graph.release()`` when done.
    """
    g = sg.graph
    k = g.key_list
    on = [*k, "id"]
    n_vertices = g.sizes()[0]

    def communities() -> DataFrame:
        labels = label_propagation(g)
        return cut_lineage(
            vertex_communities(labels, community_metrics(g, labels), k, g.skew, n_vertices).select(
                *on, "community_size", "community_density", "community_avg_degree"
            )
        )

    # the three algorithms only share the (checkpointed) graph: run them side by side
    sizes, ranks, comm, _ = in_parallel(
        lambda: cut_lineage(network_sizes(connected_components(g), k, g.skew, n_vertices)),
        lambda: pagerank(g),  # writes the source-bucketed edge copy; its ranks are a written table
        communities,
        lambda: g.by_endpoint("dst"),  # the destination copy, meanwhile
    )
    # one aggregation over the union of all parts instead of a join for each; every part has one row a vertex at most
    parts = [
        degrees(g).select(*on, "degree"),
        sg.entities.select(*on, F.lit(1).alias("is_entity")),
        ranks.select(*on, "pagerank"),
        sizes.select(*on, "network_size"),
        comm,
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    columns = [c for c in union.columns if c not in on]
    feats = union.groupBy(*on).agg(*(F.max(c).alias(c) for c in columns)).where("degree is not null and is_entity = 1")
    return feats.select(
        *k,
        F.col("id").alias(ENTITY),
        F.col("degree").cast("long").alias("degree_centrality"),
        F.col("pagerank").cast("double").alias("pagerank_centrality"),
        F.lit(EIGENVECTOR_PLACEHOLDER).cast("double").alias("eigenvector_centrality"),
        F.col("community_size").cast("long").alias("community_size"),
        F.col("community_density").cast("double").alias("community_density"),
        F.col("community_avg_degree").cast("double").alias("average_degree"),
        F.col("network_size").cast("long").alias("network_size"),
    )


def neighbor_features(sg: SnapshotGraph, level: str = "vhrg") -> DataFrame:
    """(*keys, EXT_ENTITYID, vhrg_neighbor_ct) for every entity of the snapshot
    (sentinel ids included), 0 when it has no high-risk neighbour.

    Lazy. Without spans it reads the graph's bucketed edge copies: materialise it before
    ``sg.graph.release()``.
    """
    g = sg.graph
    k = g.key_list
    counts = risky_neighbor_counts(g, sg.risky, sg.risky_spans)
    return (
        sg.entities.join(counts, [*k, "id"], "left")
        .na.fill({"high_risk_neighbor_count": 0})
        .select(*k, F.col("id").alias(ENTITY), F.col("high_risk_neighbor_count").cast("long").alias(neighbor_column(level)))
    )


def snapshot_features(sg: SnapshotGraph, level: str = "vhrg") -> DataFrame:
    """Both feature sets, long form: up to two rows per (*keys, entity), null where the other
    block has the value (the two blocks have different null rules)."""
    try:
        cent, nb = in_parallel(
            lambda: centrality_features(sg), lambda: cut_lineage(neighbor_features(sg, level))
        )
    finally:
        sg.graph.release()  # neither result reads the bucketed edge copies any more
    return cent.unionByName(nb, allowMissingColumns=True)


def wide_columns(windows: Iterable[int], level: str = "vhrg") -> list[str]:
    cols = [*CENTRALITY_COLUMNS, neighbor_column(level)]
    return [f"{c}_{int(w)}m" for w in windows for c in cols]


def network_features(
    driver: DataFrame,
    trxn: DataFrame,
    windows: Iterable[int] = DEFAULT_WINDOWS,
    level: str = "vhrg",
    skew: SkewConfig = DEFAULT_SKEW,
    graphs: list[SnapshotGraph] | None = None,
) -> DataFrame:
    """Driver keys with eight features per look-back window.

    ``trxn`` must carry the risk flags (:func:`add_risk_flags`). All
    (vintage, window) graphs are computed in one pass; windows become columns
    by a fixed-list conditional aggregation (no data-dependent pivot). The graph is
    added to ``graphs``; its ``discard`` deletes the intermediate tables once the result is written.
    """
    return _network_features(driver, trxn, windows, level, skew, [] if graphs is None else graphs)


def _network_features(driver, trxn, windows, level, skew, graphs: list[SnapshotGraph]) -> DataFrame:
    windows = list(dict.fromkeys(int(w) for w in windows))  # unique, in the given order
    drivers = driver.select(ENTITY, VINTAGE).distinct()
    snaps = snapshot_table(drivers.select(VINTAGE), windows)
    sg = prepare(trxn, level=level, skew=skew, timeline=Timeline.of(snaps))
    graphs.append(sg)
    # by number: only the drivers' rows meet an id
    keys = drivers.join(sg.numbers.withColumnRenamed("name", ENTITY), ENTITY, "left")
    long = sg.timeline.named(snapshot_features(sg, level)).withColumnRenamed(ENTITY, NUMBER)
    long = long.join(keys.where(F.col(NUMBER).isNotNull()), [NUMBER, VINTAGE], "left_semi")  # before the pivot
    metrics = [*CENTRALITY_COLUMNS, neighbor_column(level)]
    wide = long.groupBy(NUMBER, VINTAGE).agg(
        *[F.max(F.when(F.col(WINDOW) == w, F.col(c))).alias(f"{c}_{w}m") for w in windows for c in metrics]
    )
    return keys.join(wide, [NUMBER, VINTAGE], "left").select(ENTITY, VINTAGE, *wide_columns(windows, level))


def input_version(*frames: DataFrame) -> str:
    """A digest of the files that the frames read, by name and order: another set of files is another version."""
    digest = hashlib.sha256()
    for df in frames:
        for name in sorted(df.inputFiles()):
            digest.update(name.encode() + b"\n")
        digest.update(b"\0")
    return digest.hexdigest()


class Ledger:
    """What a target holds already: a row for each finished vintage of a (windows, level, input version).

    A small table beside the target: in the folder ``_ledger`` of a path (Spark's readers skip it), or the
    catalog table ``<target>_ledger``. A batch's rows are appended when its features are committed."""

    SCHEMA = f"{VINTAGE} date, windows array<int>, level string, version string"

    def __init__(self, spark: SparkSession, target: str, windows: list[int], level: str, version: str):
        self.spark, self.is_table = spark, "/" not in target
        self.place = f"{target}_ledger" if self.is_table else f"{target.rstrip('/')}/_ledger"
        self.key = (windows, level, version)

    def _table(self) -> DataFrame | None:
        if self.is_table:
            return self.spark.table(self.place) if self.spark.catalog.tableExists(self.place) else None
        return self.spark.read.schema(self.SCHEMA).parquet(self.place) if path_exists(self.spark, self.place) else None

    def finished(self) -> set[dt.date]:
        """Vintages whose features with these windows, level and inputs are in the target."""
        rows = self._table()
        if rows is None:
            return set()
        windows, level, version = self.key
        same = (F.col("windows") == F.array(*map(F.lit, windows))) & (F.col("level") == level) & (F.col("version") == version)
        return {r[0] for r in rows.where(same).select(VINTAGE).distinct().collect()}

    def add(self, vintages: list[dt.date]) -> None:
        rows = self.spark.createDataFrame([(v, *self.key) for v in vintages], self.SCHEMA).coalesce(1).write.mode("append")
        if self.is_table:
            rows.saveAsTable(self.place)
        else:
            rows.parquet(self.place)


def run(
    spark: SparkSession,
    driver_source: Source,
    trxn_source: Source,
    target: str,
    start: dt.date | str,
    months: int = 24,
    windows: Iterable[int] = DEFAULT_WINDOWS,
    level: str = "vhrg",
    mode: str = "overwrite_partitions",
    vintages_per_batch: int | None = None,
    skew: SkewConfig = DEFAULT_SKEW,
    risk_lists: DataFrame | None = None,
    resume: bool = False,
    version: str | None = None,
    before_batch: Callable[[list[dt.date]], None] | None = None,
) -> list[dt.date]:
    """Compute and write the features of every vintage in ``[start, start + months]``.

    All vintages go in one pass unless ``vintages_per_batch`` is set, in which
    case each batch is one pass and one write (a batch of 1 is the
    vintage-by-vintage loop). The list of vintages is the only data collected
    to the driver; its size is bounded by the day count of the horizon.
    ``risk_lists`` are dated country lists (:func:`add_dated_risk_flags`); without them the fixed lists hold.

    With ``resume`` a run that failed goes on where it stopped: vintages that the target's :class:`Ledger` holds for the same windows,
    level and inputs are neither computed nor written again. ``version`` names the inputs; by default it is
    :func:`input_version` of the sources (and lists). A batch enters the ledger after its write, and a batch that was written but
    not entered is written again, so ``resume`` needs ``overwrite_partitions``. ``before_batch`` is called with
    the vintages of each batch; what it raises ends the run. Returns the vintages written by this call.
    """
    windows = list(dict.fromkeys(int(w) for w in windows))
    if resume and mode != "overwrite_partitions":
        raise ValueError("resume needs mode overwrite_partitions")
    driver = read_driver(spark, driver_source)
    found = [r[VINTAGE] for r in vintages(driver, start, months).collect()]
    if not found:
        return []
    lo = min(found) - relativedelta(months=max(windows))
    trxn = read_transactions(spark, trxn_source, date_from=lo, date_to=max(found))
    ledger = None
    if resume:
        sources = [driver, trxn] if risk_lists is None else [driver, trxn, risk_lists]
        ledger = Ledger(spark, target, windows, level, version or input_version(*sources))
        done = ledger.finished()
        found = [v for v in found if v not in done]
    trxn = add_risk_flags(trxn) if risk_lists is None else add_dated_risk_flags(trxn, risk_lists)
    step = vintages_per_batch or len(found) or 1
    for i in range(0, len(found), step):
        batch = found[i : i + step]
        if before_batch is not None:
            before_batch(batch)
        graphs: list[SnapshotGraph] = []
        try:
            feats = _network_features(driver.where(F.col(VINTAGE).isin(batch)), trxn, windows, level, skew, graphs)
            write_features(feats, target, mode=mode)
        finally:  # written or failed: the batch's intermediate tables are not read again
            for sg in graphs:
                sg.discard()
        if ledger is not None:
            ledger.add(batch)
    return found
