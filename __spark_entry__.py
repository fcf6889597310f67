"""

Every query reads the TPC-H-style test tables of ``sf_dir`` and derives the
payment table from them (``netfeat.sources.tpch``): customers pay parts, in
one id space, with sentinel ids and null partners mixed in. Snapshots are the
vintages 1997-12-31 and 1998-06-30 with look-back windows of 1, 6 and 12
months, all computed in one batched pass.

The oracle of each query is DuckDB SQL over the same Parquet views, written
from the definitions (unrolled rounds for PageRank and label propagation, a
recursive CTE for components). PageRank is rounded to 6 places on both
sides (sums depend on order); all other values are exact.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

# the package lives next to this file; make it importable however this file is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netfeat.constants import (
    ACCOUNT_ID_COLUMNS,
    ACCOUNT_PREFIX,
    CENTRALITY_COLUMNS,
    EXCLUDED_SIC_CODES,
    RISKY_ACCOUNT_PREFIXES,
    SANCTION_EVASION_COUNTRIES,
    SENTINEL_IDS,
    SNAPSHOT_KEYS,
    WIRE_COLUMNS,
    WIRE_PARTY_COLUMNS,
)
from netfeat.operators.clean import strip_account_prefix
from netfeat.operators.community import community_metrics
from netfeat.operators.components import connected_components, network_sizes
from netfeat.operators.graph import degrees, graph_stats
from netfeat.operators.labels import label_propagation
from netfeat.operators.neighbors import edge_risk, risky_neighbor_counts, vertex_risk
from netfeat.operators.pagerank import pagerank
from netfeat.operators.risk import (
    add_country_flag,
    add_dated_risk_flags,
    add_prefix_flag,
    add_risk_flags,
    risk_countries,
)
from netfeat.operators.skew import SkewConfig
from netfeat.operators.snapshots import assign_snapshots, in_date_range, snapshot_table, vintages
from netfeat.operators.timeline import Timeline
from netfeat.operators.wire import exclude_codes, select_wire, wire_parties
from netfeat.plans.features import (
    centrality_features,
    neighbor_features,
    network_features,
    prepare,
    run,
)
from netfeat.session import cut_lineage, in_parallel
from netfeat.sources.sinks import read_features, write_features
from netfeat.sources.tables import read_driver, read_transactions, write_by_month
from netfeat.sources.tpch import (
    EXTRA_DRIVER_PREFIX,
    NATION_ISO3,
    TEST_VINTAGES,
    TEST_WINDOWS,
    tpch_drivers,
    tpch_transactions,
    tpch_wire,
)

try:
    import corpus_pipeline
    from netfeat.llm import queries as _llm
except ModuleNotFoundError as e:  # the training-data part may be left out
    if e.name not in ("corpus_pipeline", "netfeat.llm"):
        raise
    _llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
KEYS = list(SNAPSHOT_KEYS)
HORIZON_START = dt.date(1997, 6, 30)
RUN_WINDOWS = (6, 12)
# vintages for the batched run: one before and one after its horizon, month ends, 29 February
BATCH_VINTAGES = (
    dt.date(1996, 1, 31), dt.date(1996, 2, 29), dt.date(1996, 5, 31), dt.date(1996, 8, 30), dt.date(1998, 6, 30),
)
BATCH_START, BATCH_MONTHS, BATCH_WINDOWS = dt.date(1996, 2, 15), 12, (1, 6)
BATCH_END = dt.date(1997, 2, 15)
# outside the horizon of run_features
OUTSIDE_VINTAGES = (dt.date(1995, 1, 31), dt.date(1999, 12, 31))
APART_VINTAGES = (dt.date(1994, 6, 30), dt.date(1996, 12, 31))
LISTS_START = dt.date(1992, 1, 1)
LIMIT = 200
RANGE_START = dt.date(1997, 6, 30)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _ready(spark: SparkSession) -> None:
    """The algorithms cut lineage in the shared checkpoint folder; a session
    without one gets a folder in its warehouse, which is shared as well."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_netfeat_checkpoints")


def _trxn(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    """Flagged transactions. ``distinct`` mirrors the reader's SELECT DISTINCT
    where row multiplicity is visible in the output; graph features do not
    depend on it."""
    return add_risk_flags(read_transactions(spark, tpch_transactions(spark, sf_dir), distinct=distinct))


def _drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_driver(spark, tpch_drivers(spark, sf_dir))


def _sliced(spark: SparkSession, sf_dir: str, distinct: bool = False) -> DataFrame:
    drivers = _drivers(spark, sf_dir)
    return assign_snapshots(_trxn(spark, sf_dir, distinct), snapshot_table(drivers, TEST_WINDOWS))


def _graph(spark: SparkSession, sf_dir: str, level: str = "vhrg", numbered: bool = True):
    _ready(spark)
    snaps = snapshot_table(_drivers(spark, sf_dir), TEST_WINDOWS)
    return prepare(_trxn(spark, sf_dir), level=level, timeline=Timeline.of(snaps), numbered=numbered)


def _done(sg, df: DataFrame) -> DataFrame:
    """``df`` by vintage and window. The catalog entries of the graph's bucketed tables are dropped; ``df``
    reads checkpoints, or files that stay."""
    sg.graph.release()
    return sg.named(df)


def _round(df: DataFrame, cols: list[str], places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


def q_driver_scan(spark, sf_dir):
    return read_driver(spark, tpch_drivers(spark, sf_dir), vintages=[TEST_VINTAGES[0]])


def q_trxn_clean(spark, sf_dir):
    t = read_transactions(spark, tpch_transactions(spark, sf_dir), distinct=True)
    return t.select(
        "EXT_ENTITYID",
        F.array_join("combinedCountryCodes", ",").alias("entity_countries"),
        "COUNTER_PARTY_ENTITYID",
        F.array_join("COUNTER_PARTY_COMBINEDCOUNTRYCODES", ",").alias("cp_countries"),
        "TRXN_REF_ID",
        "POSTING_DATE",
    )


def q_risk_flags(spark, sf_dir):
    return _trxn(spark, sf_dir, distinct=True).select(
        "TRXN_REF_ID", "entity_hrg_flag", "cp_hrg_flag", "entity_vhrg_flag", "cp_vhrg_flag"
    )


def q_vintage_horizon(spark, sf_dir):
    return vintages(read_driver(spark, tpch_drivers(spark, sf_dir, BATCH_VINTAGES)), BATCH_START, BATCH_MONTHS)


def q_date_range(spark, sf_dir):
    t = in_date_range(_trxn(spark, sf_dir, distinct=True), RANGE_START, months=31, lookback=12)
    return t.groupBy(F.trunc("POSTING_DATE", "month").alias("posting_month")).agg(
        F.count(F.lit(1)).alias("n_trxn")
    )


def q_window_slice(spark, sf_dir):
    return _sliced(spark, sf_dir, distinct=True).select(*KEYS, "TRXN_REF_ID", "POSTING_DATE")


def q_graph_vertices(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    return sg.named(sg.graph.vertices)


def q_graph_edges(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    return sg.named(sg.graph.edges)


def q_degrees(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    return sg.named(degrees(sg.graph))


def q_pagerank(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return _done(sg, _round(pagerank(sg.graph), ["pagerank"]))


def q_components(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return _done(sg, connected_components(sg.graph))


def q_network_size(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return _done(sg, network_sizes(connected_components(sg.graph), sg.graph.key_list, sg.graph.skew))


def q_label_propagation(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return _done(sg, label_propagation(sg.graph))


def q_community_metrics(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return _done(sg, cut_lineage(community_metrics(sg.graph, label_propagation(sg.graph))))


def q_high_risk_nodes(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    return sg.named(sg.risky).select(*KEYS, "id")


def q_vertex_risk(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    return sg.named(vertex_risk(sg.graph, sg.risky))


def q_edge_risk(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return sg.named(edge_risk(sg.graph, vertex_risk(sg.graph, sg.risky)))


def q_neighbor_counts(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    counts = risky_neighbor_counts(sg.graph, sg.risky, sg.risky_spans)
    out = degrees(sg.graph).select("snap", "id").join(counts, ["snap", "id"], "left")
    return sg.named(out.na.fill({"high_risk_neighbor_count": 0}))


def q_neighbor_features(spark, sf_dir):
    sg = _graph(spark, sf_dir, numbered=False)
    return _done(sg, cut_lineage(neighbor_features(sg)))


def q_centrality_features(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    return _done(sg, _round(centrality_features(sg), ["pagerank_centrality"]))


def q_network_features(spark, sf_dir):
    _ready(spark)
    out = network_features(_drivers(spark, sf_dir), _trxn(spark, sf_dir), TEST_WINDOWS)
    return _round(out, [f"pagerank_centrality_{w}m" for w in TEST_WINDOWS])


def q_run_features(spark, sf_dir):
    """The whole job (F4): vintages of the horizon (and not those outside it), features for
    windows 6 and 12, written partitioned by vintage, read back."""
    target = _output_dir(spark, "run")
    run(
        spark, tpch_drivers(spark, sf_dir, TEST_VINTAGES + OUTSIDE_VINTAGES), tpch_transactions(spark, sf_dir), target,
        start=HORIZON_START, months=24, windows=RUN_WINDOWS,
    )
    out = read_features(spark, target)
    return _round(out, [f"pagerank_centrality_{w}m" for w in RUN_WINDOWS])


def q_run_batched(spark, sf_dir):
    """The whole job with two vintages a batch, three batches' worth of drivers of which two lie
    outside the horizon."""
    target = _output_dir(spark, "batched")
    run(
        spark, tpch_drivers(spark, sf_dir, BATCH_VINTAGES), tpch_transactions(spark, sf_dir), target,
        start=BATCH_START, months=BATCH_MONTHS, windows=BATCH_WINDOWS, vintages_per_batch=2,
    )
    out = read_features(spark, target)
    return _round(out, [f"pagerank_centrality_{w}m" for w in BATCH_WINDOWS])


class _Stopped(Exception):
    pass


def q_run_resumed(spark, sf_dir):
    """A run that stops before its second batch, then one over the same inputs that goes on there."""
    target = _output_dir(spark, "resumed")
    seen: list[list[dt.date]] = []

    def stop(batch):
        seen.append(batch)
        if len(seen) == 2:
            raise _Stopped

    def again(before_batch):
        return run(
            spark, tpch_drivers(spark, sf_dir, BATCH_VINTAGES), tpch_transactions(spark, sf_dir), target,
            start=BATCH_START, months=BATCH_MONTHS, windows=BATCH_WINDOWS, vintages_per_batch=1, resume=True,
            before_batch=before_batch,
        )

    try:
        again(stop)
    except _Stopped:
        pass
    rest = again(seen.append)
    if seen[0][0] in rest or [b for batch in seen[1:] for b in batch] != [seen[1][0], *rest]:
        raise RuntimeError(f"batches {seen}, written at last {rest}")
    out = read_features(spark, target)
    return _round(out, [f"pagerank_centrality_{w}m" for w in BATCH_WINDOWS])


def q_run_by_month(spark, sf_dir):
    """The job over transactions stored by posting month, vintages two and a half years apart: the months between
    them are not read."""
    source, target = _output_dir(spark, "by-month"), _output_dir(spark, "apart")
    write_by_month(tpch_transactions(spark, sf_dir), source)
    run(
        spark, tpch_drivers(spark, sf_dir, APART_VINTAGES), source, target,
        start=APART_VINTAGES[0], months=31, windows=BATCH_WINDOWS,
    )
    out = read_features(spark, target)
    return _round(out, [f"pagerank_centrality_{w}m" for w in BATCH_WINDOWS])


def q_risk_flags_dated(spark, sf_dir):
    """Flags by country lists that change over time: each nation is listed from a date of its own, every second
    one for a while only, and the lowest ones always were; every third one is on the very-high-risk list."""
    key = F.col("n_nationkey").cast("int")
    iso = F.element_at(F.array(*map(F.lit, NATION_ISO3)), key + 1)
    begin = F.when(key >= 5, F.date_add(F.lit(LISTS_START), key * 90))
    lists = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet").select(
        iso.alias("country"),
        F.when(key % 3 == 0, "vhrg").otherwise("hrg").alias("level"),
        begin.alias("valid_from"),
        F.when(key % 2 == 0, F.date_add(F.coalesce(begin, F.lit(LISTS_START)), 400)).alias("valid_to"),
    )
    trxn = read_transactions(spark, tpch_transactions(spark, sf_dir), distinct=True)
    return add_dated_risk_flags(trxn, lists).select(
        "TRXN_REF_ID", "entity_hrg_flag", "cp_hrg_flag", "entity_vhrg_flag", "cp_vhrg_flag"
    )


def _new_window(spark, sf_dir, mode):
    """Sources and target as catalog tables: a run with window 6, then one with windows 6 and 12
    into the same table."""
    _ready(spark)
    tag = uuid.uuid4().hex[:12]
    drivers, trxn, target = (f"netfeat_{kind}_{tag}" for kind in ("drivers", "trxn", "features"))
    tpch_drivers(spark, sf_dir).write.saveAsTable(drivers)
    tpch_transactions(spark, sf_dir).write.saveAsTable(trxn)
    for windows in (RUN_WINDOWS[:1], RUN_WINDOWS):
        run(spark, drivers, trxn, target, start=HORIZON_START, months=24, windows=windows, mode=mode)
    out = read_features(spark, target)
    return _round(out, [f"pagerank_centrality_{w}m" for w in RUN_WINDOWS])


def q_write_new_window(spark, sf_dir):
    """The second run replaces the vintages, with the new window's columns."""
    return _new_window(spark, sf_dir, "overwrite_partitions")


def q_append_new_window(spark, sf_dir):
    """The second run adds rows; the first run's rows are null in the new window's columns."""
    return _new_window(spark, sf_dir, "append")


def q_network_features_hot(spark, sf_dir):
    """The flagship with a threshold so low that thousands of vertices count as hot."""
    _ready(spark)
    out = network_features(
        _drivers(spark, sf_dir), _trxn(spark, sf_dir), RUN_WINDOWS, skew=SkewConfig(threshold=20)
    )
    return _round(out, [f"pagerank_centrality_{w}m" for w in RUN_WINDOWS])


def q_country_risk(spark, sf_dir):
    """Every country code seen on either side, with its mentions and list membership."""
    t = _trxn(spark, sf_dir, distinct=True)
    codes = t.select(F.explode("combinedCountryCodes").alias("country")).unionByName(
        t.select(F.explode("COUNTER_PARTY_COMBINEDCOUNTRYCODES").alias("country"))
    )
    return codes.groupBy("country").agg(F.count(F.lit(1)).alias("n_mentions")).select(
        "country",
        "n_mentions",
        F.col("country").isin(*risk_countries("hrg")).cast("int").alias("in_hrg"),
        F.col("country").isin(*risk_countries("vhrg")).cast("int").alias("in_vhrg"),
    )


def q_graph_stats(spark, sf_dir):
    sg = _graph(spark, sf_dir)
    g = sg.graph
    comp, labels = in_parallel(lambda: connected_components(g), lambda: label_propagation(g))
    return _done(sg, graph_stats(g, comp, labels))


def q_trxn_limit(spark, sf_dir):
    t = read_transactions(spark, tpch_transactions(spark, sf_dir), distinct=True, limit=LIMIT)
    return t.select(
        "TRXN_REF_ID", "EXT_ENTITYID", "COUNTER_PARTY_ENTITYID", "POSTING_DATE",
        F.array_join("combinedCountryCodes", ",").alias("entity_countries"),
    )


def q_neighbor_features_hrg(spark, sf_dir):
    """Neighbour counts at the combined level: both country lists."""
    sg = _graph(spark, sf_dir, level="hrg", numbered=False)
    return _done(sg, cut_lineage(neighbor_features(sg, level="hrg")))


def q_ordered_limit(spark, sf_dir):
    return read_driver(spark, tpch_drivers(spark, sf_dir), limit=100)


def q_strip_prefix(spark, sf_dir):
    return strip_account_prefix(tpch_wire(spark, sf_dir)).select("TRXN_REF_ID", *ACCOUNT_ID_COLUMNS)


def q_wire_projection(spark, sf_dir):
    return select_wire(tpch_wire(spark, sf_dir))


def q_wire_parties(spark, sf_dir):
    return wire_parties(tpch_wire(spark, sf_dir))


def q_sanction_flag(spark, sf_dir):
    w = tpch_wire(spark, sf_dir).withColumn("countries", F.array("ORIG_REMITTER_COUNTRY", "BENEF_COUNTRY"))
    return add_country_flag(w, "countries").select("TRXN_REF_ID", "sanction_evasion_flag")


def q_prefix_flag(spark, sf_dir):
    w = add_prefix_flag(tpch_wire(spark, sf_dir), "ORIG_REMITTER_ACCT_ID")
    return w.select("TRXN_REF_ID", "risky_prefix_flag")


def q_exclude_codes(spark, sf_dir):
    return exclude_codes(tpch_wire(spark, sf_dir), "SIC_CODE").select("TRXN_REF_ID", "SIC_CODE")


def _output_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder next to the checkpoints (shared storage on a cluster)."""
    _ready(spark)
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_write_append(spark, sf_dir):
    """Neighbour features written twice in append mode: every row twice."""
    target = _output_dir(spark, "append")
    feats = q_neighbor_features(spark, sf_dir)
    write_features(feats, target, mode="append")
    write_features(feats, target, mode="append")
    return read_features(spark, target).select(*KEYS, "EXT_ENTITYID", "vhrg_neighbor_ct")


def q_write_overwrite_partitions(spark, sf_dir):
    """All vintages written, then the last vintage written again with
    dynamic partition overwrite: every row once."""
    target = _output_dir(spark, "overwrite")
    feats = q_neighbor_features(spark, sf_dir)
    write_features(feats, target, mode="overwrite_partitions")
    write_features(feats.where(F.col("VINTAGE_DT") == F.lit(TEST_VINTAGES[-1])), target, mode="overwrite_partitions")
    return read_features(spark, target).select(*KEYS, "EXT_ENTITYID", "vhrg_neighbor_ct")


def q_write_widened(spark, sf_dir):
    """A vintage written with a narrow count column, then another with a wider one: the target widens."""
    target = _output_dir(spark, "widened")
    feats = q_neighbor_features(spark, sf_dir)
    first = F.col("VINTAGE_DT") == F.lit(TEST_VINTAGES[0])
    narrow = feats.where(first).withColumn("vhrg_neighbor_ct", F.col("vhrg_neighbor_ct").cast("int"))
    write_features(narrow, target)
    write_features(feats.where(~first), target)
    return read_features(spark, target).select(*KEYS, "EXT_ENTITYID", "vhrg_neighbor_ct")


def q_write_unpartitioned(spark, sf_dir):
    target = _output_dir(spark, "plain")
    write_features(q_neighbor_features(spark, sf_dir), target, mode="overwrite", partition_col=None)
    return read_features(spark, target).select(*KEYS, "EXT_ENTITYID", "vhrg_neighbor_ct")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "driver_scan": q_driver_scan,
    "trxn_clean": q_trxn_clean,
    "risk_flags": q_risk_flags,
    "country_risk": q_country_risk,
    "vintage_horizon": q_vintage_horizon,
    "date_range": q_date_range,
    "window_slice": q_window_slice,
    "graph_vertices": q_graph_vertices,
    "graph_edges": q_graph_edges,
    "degrees": q_degrees,
    "pagerank": q_pagerank,
    "components": q_components,
    "network_size": q_network_size,
    "label_propagation": q_label_propagation,
    "community_metrics": q_community_metrics,
    "high_risk_nodes": q_high_risk_nodes,
    "vertex_risk": q_vertex_risk,
    "edge_risk": q_edge_risk,
    "neighbor_counts": q_neighbor_counts,
    "neighbor_features": q_neighbor_features,
    "centrality_features": q_centrality_features,
    "network_features": q_network_features,
    "graph_stats": q_graph_stats,
    "ordered_limit": q_ordered_limit,
    "strip_prefix": q_strip_prefix,
    "wire_projection": q_wire_projection,
    "wire_parties": q_wire_parties,
    "sanction_flag": q_sanction_flag,
    "prefix_flag": q_prefix_flag,
    "exclude_codes": q_exclude_codes,
    "write_append": q_write_append,
    "write_overwrite_partitions": q_write_overwrite_partitions,
    "run_features": q_run_features,
    "run_batched": q_run_batched,
    "write_new_window": q_write_new_window,
    "append_new_window": q_append_new_window,
    "write_unpartitioned": q_write_unpartitioned,
    "network_features_hot": q_network_features_hot,
    "neighbor_features_hrg": q_neighbor_features_hrg,
    "trxn_limit": q_trxn_limit,
    "run_resumed": q_run_resumed,
    "run_by_month": q_run_by_month,
    "risk_flags_dated": q_risk_flags_dated,
    "write_widened": q_write_widened,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: wide network features of every driver at sf0.001."""
    return q_network_features(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **({**_llm.QUERIES, "pipeline": corpus_pipeline.run} if _llm else {})}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _on(a: str, b: str) -> str:
    return f"{a}.VINTAGE_DT = {b}.VINTAGE_DT AND {a}.window_m = {b}.window_m"


K = "VINTAGE_DT, window_m"
SENT = _in(SENTINEL_IDS)


def _base_ctes(windows=TEST_WINDOWS, vintage_list=TEST_VINTAGES) -> list[str]:
    iso = ", ".join(f"({i}, '{c}')" for i, c in enumerate(NATION_ISO3))
    vint = ", ".join(f"(DATE '{v.isoformat()}')" for v in vintage_list)
    wins = ", ".join(f"({w})" for w in windows)
    hrg, vhrg = _list(risk_countries("hrg")), _list(risk_countries("vhrg"))
    return [
        f"iso(k, c) AS (VALUES {iso})",
        """raw AS (
  SELECT CASE WHEN o_orderkey % 53 = 0 THEN '9999'
              WHEN o_orderkey % 59 = 0 THEN ''
              ELSE CAST(o_custkey AS VARCHAR) END AS EXT_ENTITYID,
         a.c AS ext_country,
         CASE WHEN l_orderkey % 11 = 0 AND l_linenumber = 7 THEN NULL
              ELSE CAST(l_partkey AS VARCHAR) END AS COUNTER_PARTY_ENTITYID,
         CASE WHEN l_linenumber = 6 THEN NULL ELSE b.c END AS cp_country,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TRXN_REF_ID,
         CAST(o_orderdate AS DATE) AS POSTING_DATE
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN iso a ON a.k = c_nationkey
  JOIN iso b ON b.k = l_partkey % 25)""",
        "t0 AS (SELECT DISTINCT * FROM raw)",
        """trxn AS (
  SELECT EXT_ENTITYID,
         CASE WHEN ext_country IS NULL THEN NULL ELSE [ext_country] END AS combinedCountryCodes,
         coalesce(COUNTER_PARTY_ENTITYID, 'NaN') AS COUNTER_PARTY_ENTITYID,
         CASE WHEN cp_country IS NULL THEN NULL ELSE [cp_country] END AS COUNTER_PARTY_COMBINEDCOUNTRYCODES,
         TRXN_REF_ID, POSTING_DATE
  FROM t0 WHERE EXT_ENTITYID IS NOT NULL)""",
        f"""tf AS (
  SELECT *,
         CAST(coalesce(list_has_any(combinedCountryCodes, {hrg}), false) AS INTEGER) AS entity_hrg_flag,
         CAST(coalesce(list_has_any(COUNTER_PARTY_COMBINEDCOUNTRYCODES, {hrg}), false) AS INTEGER) AS cp_hrg_flag,
         CAST(coalesce(list_has_any(combinedCountryCodes, {vhrg}), false) AS INTEGER) AS entity_vhrg_flag,
         CAST(coalesce(list_has_any(COUNTER_PARTY_COMBINEDCOUNTRYCODES, {vhrg}), false) AS INTEGER) AS cp_vhrg_flag
  FROM trxn)""",
        f"""drv AS (
  SELECT DISTINCT i.EXT_ENTITYID, d.VINTAGE_DT
  FROM (SELECT CAST(c_custkey AS VARCHAR) AS EXT_ENTITYID FROM customer
        UNION ALL SELECT '{EXTRA_DRIVER_PREFIX}' || CAST(r_regionkey AS VARCHAR) FROM region) i
  CROSS JOIN (VALUES {vint}) d(VINTAGE_DT))""",
        f"""snap AS (
  SELECT d.VINTAGE_DT, w.window_m,
         CAST(d.VINTAGE_DT - to_months(w.window_m) AS DATE) AS lo, d.VINTAGE_DT AS hi
  FROM (SELECT DISTINCT VINTAGE_DT FROM drv) d CROSS JOIN (VALUES {wins}) w(window_m))""",
        """ts AS (
  SELECT s.VINTAGE_DT, s.window_m, t.*
  FROM tf t JOIN snap s ON t.POSTING_DATE > s.lo AND t.POSTING_DATE <= s.hi)""",
        f"""v AS (
  SELECT DISTINCT {K}, id FROM (
    SELECT {K}, EXT_ENTITYID AS id FROM ts
    UNION ALL SELECT {K}, COUNTER_PARTY_ENTITYID FROM ts) x
  WHERE id IS NOT NULL AND id NOT IN {SENT})""",
        f"""e AS (
  SELECT DISTINCT {K}, EXT_ENTITYID AS src, COUNTER_PARTY_ENTITYID AS dst FROM ts
  WHERE EXT_ENTITYID IS NOT NULL AND EXT_ENTITYID NOT IN {SENT}
    AND COUNTER_PARTY_ENTITYID IS NOT NULL AND COUNTER_PARTY_ENTITYID NOT IN {SENT})""",
        f"""deg AS (
  SELECT {K}, id, count(*) AS degree FROM (
    SELECT {K}, src AS id FROM e UNION ALL SELECT {K}, dst FROM e) x
  GROUP BY ALL)""",
        f"ent AS (SELECT DISTINCT {K}, EXT_ENTITYID AS id FROM ts)",
    ]


def _pagerank_ctes(rounds: int = 5, reset: float = 0.15) -> list[str]:
    ctes = [
        f"od AS (SELECT {K}, src AS id, count(*) AS n FROM e GROUP BY ALL)",
        f"r0 AS (SELECT {K}, id, CAST(1.0 AS DOUBLE) AS r FROM v)",
    ]
    for i in range(1, rounds + 1):
        ctes.append(
            f"""r{i} AS (
  SELECT v.VINTAGE_DT, v.window_m, v.id,
         CAST({reset} AS DOUBLE) + CAST({1.0 - reset} AS DOUBLE) * coalesce(c.s, 0.0) AS r
  FROM v LEFT JOIN (
    SELECT e.VINTAGE_DT, e.window_m, e.dst AS id, sum(p.r / od.n) AS s
    FROM e JOIN od ON {_on('e', 'od')} AND od.id = e.src
           JOIN r{i - 1} p ON {_on('e', 'p')} AND p.id = e.src
    GROUP BY ALL) c ON {_on('v', 'c')} AND c.id = v.id)"""
        )
    ctes.append(
        f"""pr AS (
  SELECT {K}, id, r * count(*) OVER w / sum(r) OVER w AS pagerank
  FROM r{rounds} WINDOW w AS (PARTITION BY {K}))"""
    )
    return ctes


def _label_ctes(rounds: int = 5) -> list[str]:
    ctes = [f"l0 AS (SELECT {K}, id, id AS label FROM v)"]
    for i in range(1, rounds + 1):
        p = f"l{i - 1}"
        ctes.append(
            f"""l{i} AS (
  SELECT p.VINTAGE_DT, p.window_m, p.id, coalesce(b.label, p.label) AS label
  FROM {p} p LEFT JOIN (
    SELECT {K}, id, arg_min(label, (-n, label)) AS label FROM (
      SELECT {K}, id, label, count(*) AS n FROM (
        SELECT e.VINTAGE_DT, e.window_m, e.dst AS id, ls.label FROM e JOIN {p} ls ON {_on('e', 'ls')} AND ls.id = e.src
        UNION ALL
        SELECT e.VINTAGE_DT, e.window_m, e.src AS id, ld.label FROM e JOIN {p} ld ON {_on('e', 'ld')} AND ld.id = e.dst) m
      GROUP BY ALL) c
    GROUP BY ALL) b ON {_on('p', 'b')} AND b.id = p.id)"""
        )
    ctes.append(f"lp AS (SELECT * FROM l{rounds})")
    return ctes


def _community_ctes() -> list[str]:
    return [
        f"""intra AS (
  SELECT e.VINTAGE_DT, e.window_m, ls.label, count(*) AS edge_count
  FROM e JOIN lp ls ON {_on('e', 'ls')} AND ls.id = e.src
         JOIN lp ld ON {_on('e', 'ld')} AND ld.id = e.dst
  WHERE ls.label = ld.label GROUP BY ALL)""",
        f"csz AS (SELECT {K}, label, count(*) AS community_size FROM lp GROUP BY ALL)",
        f"""cmm AS (
  SELECT c.VINTAGE_DT, c.window_m, c.label, c.community_size,
         coalesce(i.edge_count, 0) AS edge_count,
         CASE WHEN c.community_size * (c.community_size - 1) / 2 > 0
              THEN coalesce(i.edge_count, 0) / (c.community_size * (c.community_size - 1) / 2)
              ELSE 0.0 END AS community_density,
         CASE WHEN c.community_size > 0 THEN coalesce(i.edge_count, 0) * 2 / c.community_size
              ELSE 0.0 END AS community_avg_degree
  FROM csz c LEFT JOIN intra i ON {_on('c', 'i')} AND i.label = c.label)""",
    ]


def _component_ctes() -> list[str]:
    return [
        f"u AS (SELECT {K}, src AS a, dst AS b FROM e UNION SELECT {K}, dst, src FROM e)",
        f"""cc(VINTAGE_DT, window_m, id, comp) USING KEY (VINTAGE_DT, window_m, id) AS (
  SELECT {K}, id, id FROM v
  UNION
  (SELECT x.VINTAGE_DT, x.window_m, x.id, min(x.comp)
   FROM (SELECT u.VINTAGE_DT, u.window_m, u.a AS id, cc.comp
         FROM cc JOIN u ON {_on('u', 'cc')} AND u.b = cc.id) x
   JOIN recurring.cc r ON {_on('r', 'x')} AND r.id = x.id
   WHERE x.comp < r.comp
   GROUP BY x.VINTAGE_DT, x.window_m, x.id))""",
        f"nsz AS (SELECT {K}, comp, count(*) AS network_size FROM cc GROUP BY ALL)",
        f"""ns AS (
  SELECT cc.VINTAGE_DT, cc.window_m, cc.id, nsz.network_size
  FROM cc JOIN nsz ON {_on('cc', 'nsz')} AND nsz.comp = cc.comp)""",
    ]


def _neighbor_ctes(level: str = "vhrg") -> list[str]:
    ef, cf = ("entity_vhrg_flag", "cp_vhrg_flag") if level == "vhrg" else ("entity_hrg_flag", "cp_hrg_flag")
    return [
        f"""hr AS (
  SELECT DISTINCT {K}, id FROM (
    SELECT {K}, EXT_ENTITYID AS id FROM ts WHERE {ef} = 1
    UNION ALL SELECT {K}, COUNTER_PARTY_ENTITYID FROM ts WHERE {cf} = 1) x
  WHERE id IS NOT NULL)""",
        f"""vr AS (
  SELECT v.VINTAGE_DT, v.window_m, v.id, CASE WHEN hr.id IS NULL THEN 0 ELSE 1 END AS is_high_risk
  FROM v LEFT JOIN hr ON {_on('v', 'hr')} AND hr.id = v.id)""",
        f"""er AS (
  SELECT e.VINTAGE_DT, e.window_m, e.src, e.dst,
         a.is_high_risk AS src_is_high_risk, b.is_high_risk AS dst_is_high_risk
  FROM e LEFT JOIN vr a ON {_on('e', 'a')} AND a.id = e.src
         LEFT JOIN vr b ON {_on('e', 'b')} AND b.id = e.dst)""",
        f"""nc AS (
  SELECT {K}, id, CAST(sum(n) AS BIGINT) AS high_risk_neighbor_count FROM (
    SELECT {K}, src AS id, dst_is_high_risk AS n FROM er
    UNION ALL SELECT {K}, dst, src_is_high_risk FROM er) x
  GROUP BY ALL)""",
        f"""nf AS (
  SELECT ent.VINTAGE_DT, ent.window_m, ent.id AS EXT_ENTITYID,
         CAST(coalesce(nc.high_risk_neighbor_count, 0) AS BIGINT) AS vhrg_neighbor_ct
  FROM ent LEFT JOIN nc ON {_on('ent', 'nc')} AND nc.id = ent.id)""",
    ]


def _centrality_ctes() -> list[str]:
    return [
        f"""cf AS (
  SELECT d.VINTAGE_DT, d.window_m, d.id AS EXT_ENTITYID,
         d.degree AS degree_centrality,
         round(pr.pagerank, 6) AS pagerank_centrality,
         CAST(0.5 AS DOUBLE) AS eigenvector_centrality,
         m.community_size, m.community_density,
         m.community_avg_degree AS average_degree,
         ns.network_size
  FROM deg d
  JOIN ent ON {_on('d', 'ent')} AND ent.id = d.id
  LEFT JOIN pr ON {_on('d', 'pr')} AND pr.id = d.id
  LEFT JOIN ns ON {_on('d', 'ns')} AND ns.id = d.id
  LEFT JOIN lp ON {_on('d', 'lp')} AND lp.id = d.id
  LEFT JOIN cmm m ON {_on('lp', 'm')} AND m.label = lp.label)"""
    ]


def _with(ctes: list[str], select: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + select


def _graph_sql(extra: list[str], select: str, recursive: bool = False) -> str:
    return _with(_base_ctes() + extra, select, recursive)


def _wide_ctes(windows=TEST_WINDOWS) -> list[str]:
    metrics = [*CENTRALITY_COLUMNS, "vhrg_neighbor_ct"]
    types = {
        "degree_centrality": "BIGINT", "community_size": "BIGINT", "network_size": "BIGINT",
        "vhrg_neighbor_ct": "BIGINT",
    }
    cent_cols = ", ".join(CENTRALITY_COLUMNS)
    null_cent = ", ".join(f"CAST(NULL AS {types.get(c, 'DOUBLE')}) AS {c}" for c in CENTRALITY_COLUMNS)
    piv = ",\n    ".join(
        f"max(CASE WHEN window_m = {w} THEN {c} END) AS {c}_{w}m" for w in windows for c in metrics
    )
    return [
        f"""lng AS (
  SELECT {K}, EXT_ENTITYID, {cent_cols}, CAST(NULL AS BIGINT) AS vhrg_neighbor_ct FROM cf
  UNION ALL
  SELECT {K}, EXT_ENTITYID, {null_cent}, vhrg_neighbor_ct FROM nf)""",
        f"""wide AS (
  SELECT EXT_ENTITYID, VINTAGE_DT,
    {piv}
  FROM lng GROUP BY EXT_ENTITYID, VINTAGE_DT)""",
    ]


_CENTRALITY_TYPES = tuple(
    (c, "BIGINT" if c in ("degree_centrality", "community_size", "network_size") else "DOUBLE") for c in CENTRALITY_COLUMNS
)


def _wide_select(windows=TEST_WINDOWS) -> str:
    metrics = [*CENTRALITY_COLUMNS, "vhrg_neighbor_ct"]
    cols = ", ".join(f"w.{c}_{wn}m" for wn in windows for c in metrics)
    return f"""SELECT d.EXT_ENTITYID, d.VINTAGE_DT, {cols}
FROM (SELECT DISTINCT EXT_ENTITYID, VINTAGE_DT FROM drv) d
LEFT JOIN wide w ON w.EXT_ENTITYID = d.EXT_ENTITYID AND w.VINTAGE_DT = d.VINTAGE_DT"""


def _wire_ctes() -> list[str]:
    iso = ", ".join(f"({i}, '{c}')" for i, c in enumerate(NATION_ISO3))
    return [
        f"iso(k, c) AS (VALUES {iso})",
        """wire AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TRXN_REF_ID,
         'ACCT-' || pfx.p || CAST(l_partkey AS VARCHAR) AS BENEF_ACCT_ID,
         bi.c AS BENEF_COUNTRY,
         'PART-' || CAST(l_partkey AS VARCHAR) AS BENEF_NAME,
         CASE WHEN l_linenumber % 3 = 0 THEN 'ORG' ELSE 'IND' END AS BENEF_TYPE,
         pfx.p || 'ACCT-' || CAST(o_custkey AS VARCHAR) AS ORIG_REMITTER_ACCT_ID,
         l_extendedprice AS ORIG_REMITTER_AMT_ACTIVITY,
         ci.c AS ORIG_REMITTER_COUNTRY,
         c_name AS ORIG_REMITTER_NAME,
         CASE WHEN l_linenumber % 2 = 0 THEN 'ACCT' END AS ORIG_REMITTER_ID_TYPE,
         CAST(o_orderdate AS DATE) AS POSTING_DATE,
         'ACCT-' || CAST(l_suppkey AS VARCHAR) || '-ACCT-' AS SENDING_INSTN_ACCT_ID,
         si.c AS SENDING_INSTN_COUNTRY,
         s_name AS SENDING_INSTN_NAME,
         'ACCT-ACCT-' || CAST(l_suppkey AS VARCHAR) AS RCV_INSTN_ACCT_ID,
         CASE WHEN l_linenumber % 4 = 1 THEN 'ACCT-' || CAST(o_custkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) END AS TP_ORIGIN_ACCT_ID,
         CASE WHEN l_linenumber % 4 = 1 THEN s_name END AS TP_ORIGIN_NAME,
         CASE WHEN l_linenumber % 4 = 1 THEN si.c END AS TP_ORIGIN_COUNTRY,
         CASE WHEN l_linenumber % 4 = 1 THEN 'ORG' END AS TP_ORIGIN_TYPE,
         CASE WHEN l_linenumber % 5 = 2 THEN 'ACCT-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) END AS TP_BENEF_ACCT_ID,
         CASE WHEN l_linenumber % 5 = 2 THEN 'TP-' || CAST(l_partkey AS VARCHAR) END AS TP_BENEF_NAME,
         CASE WHEN l_linenumber % 5 = 2 THEN ti.c END AS TP_BENEF_COUNTRY,
         CASE WHEN l_linenumber % 5 = 2 THEN 'IND' END AS TP_BENEF_TYPE,
         l_extendedprice AS TRXN_AMOUNT,
         'USD' AS TRXN_CURRENCY_CD,
         lpad(CAST(7300 + o_custkey % 100 AS VARCHAR), 4, '0') AS SIC_CODE
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN (VALUES (0, 'NRA'), (1, 'OSA'), (2, 'FIN'), (3, 'CHK')) pfx(k, p) ON pfx.k = l_linenumber % 4
  LEFT JOIN iso bi ON bi.k = l_partkey % 25
  LEFT JOIN iso ci ON ci.k = c_nationkey
  LEFT JOIN iso si ON si.k = s_nationkey
  LEFT JOIN iso ti ON ti.k = l_suppkey % 25)""",
    ]


def _wire_sql(select: str) -> str:
    return _with(_wire_ctes(), select)


def _oracles() -> dict[str, str]:
    v0 = TEST_VINTAGES[0].isoformat()
    wire_present = [c for c in WIRE_COLUMNS if c in _WIRE_FIXTURE_COLUMNS]
    party_selects = []
    for side, by_type in WIRE_PARTY_COLUMNS.items():
        for type_col, (acct, name, country) in by_type.items():
            cols = [_wire_col(c) for c in (type_col, acct, name, country)]
            party_selects.append(
                f"SELECT TRXN_REF_ID, '{side}' AS side, '{type_col}' AS party_column, {cols[0]} AS party_type, "
                f"{cols[1]} AS acct_id, {cols[2]} AS name, {cols[3]} AS country FROM wire"
            )
    parties = " UNION ALL ".join(party_selects)
    sanction = _list(SANCTION_EVASION_COUNTRIES.values())
    prefix_test = " OR ".join(f"coalesce(starts_with(ORIG_REMITTER_ACCT_ID, '{p}'), false)" for p in RISKY_ACCOUNT_PREFIXES)
    strip_cols = ", ".join(f"replace({c}, '{ACCOUNT_PREFIX}', '') AS {c}" if c in _WIRE_FIXTURE_COLUMNS else f"CAST(NULL AS VARCHAR) AS {c}" for c in ACCOUNT_ID_COLUMNS)
    lp_all = _pagerank_ctes() + _label_ctes() + _community_ctes() + _component_ctes()
    batch_dates = ", ".join(f"(DATE '{v.isoformat()}')" for v in BATCH_VINTAGES)
    wide_tail = lp_all + _centrality_ctes() + _neighbor_ctes()  # noqa: E501
    run_windows = _with(_base_ctes(RUN_WINDOWS) + wide_tail + _wide_ctes(RUN_WINDOWS), _wide_select(RUN_WINDOWS), recursive=True)
    old = [f"CAST(NULL AS {t}) AS {c}_{RUN_WINDOWS[1]}m" for c, t in (*_CENTRALITY_TYPES, ("vhrg_neighbor_ct", "BIGINT"))]
    first_window = _wide_select(RUN_WINDOWS[:1]).replace("\nFROM (SELECT DISTINCT", f", {', '.join(old)}\nFROM (SELECT DISTINCT", 1)
    batched = _with(
        _base_ctes(BATCH_WINDOWS, [v for v in BATCH_VINTAGES if BATCH_START <= v <= BATCH_END])
        + wide_tail + _wide_ctes(BATCH_WINDOWS),
        _wide_select(BATCH_WINDOWS),
        recursive=True,
    )
    start = f"DATE '{LISTS_START.isoformat()}'"

    def dated(column: str, levels: str) -> str:
        return (
            "CAST(EXISTS (SELECT 1 FROM lists l WHERE l.level IN "
            f"{levels} AND list_contains({column}, l.country) AND (l.lo IS NULL OR l.lo <= t.POSTING_DATE) "
            "AND (l.hi IS NULL OR t.POSTING_DATE <= l.hi)) AS INTEGER)"
        )

    return {
        "run_batched": batched,
        "run_resumed": batched,
        "run_by_month": _with(
            _base_ctes(BATCH_WINDOWS, APART_VINTAGES) + wide_tail + _wide_ctes(BATCH_WINDOWS),
            _wide_select(BATCH_WINDOWS),
            recursive=True,
        ),
        "risk_flags_dated": _graph_sql(
            [f"""lists AS (
  SELECT c AS country, CASE WHEN k % 3 = 0 THEN 'vhrg' ELSE 'hrg' END AS level,
         CASE WHEN k >= 5 THEN {start} + CAST(k * 90 AS INTEGER) END AS lo,
         CASE WHEN k % 2 = 0 THEN {start} + CAST(CASE WHEN k >= 5 THEN k * 90 ELSE 0 END + 400 AS INTEGER) END AS hi
  FROM nation JOIN iso ON k = n_nationkey)"""],
            "SELECT TRXN_REF_ID, "
            + ", ".join(
                f"{dated(column, levels)} AS {side}_{level}_flag"
                for side, column in (("entity", "combinedCountryCodes"), ("cp", "COUNTER_PARTY_COMBINEDCOUNTRYCODES"))
                for level, levels in (("hrg", "('hrg', 'vhrg')"), ("vhrg", "('vhrg')"))
            )
            + " FROM trxn t",
        ),
        "write_widened": _graph_sql(_neighbor_ctes(), f"SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct FROM nf"),
        "write_new_window": run_windows,
        "append_new_window": _with(
            _base_ctes(RUN_WINDOWS) + wide_tail + _wide_ctes(RUN_WINDOWS),
            f"{_wide_select(RUN_WINDOWS)} UNION ALL BY NAME {first_window}",
            recursive=True,
        ),
        "write_unpartitioned": _graph_sql(_neighbor_ctes(), f"SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct FROM nf"),
        "network_features_hot": run_windows,
        "neighbor_features_hrg": _graph_sql(
            _neighbor_ctes("hrg"), f"SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct AS hrg_neighbor_ct FROM nf"
        ),
        "trxn_limit": _graph_sql(
            [f"""lim AS (
  SELECT * FROM t0 ORDER BY TRXN_REF_ID NULLS FIRST, EXT_ENTITYID NULLS FIRST, COUNTER_PARTY_ENTITYID NULLS FIRST,
    POSTING_DATE NULLS FIRST, ext_country NULLS FIRST, cp_country NULLS FIRST LIMIT {LIMIT})"""],
            "SELECT TRXN_REF_ID, EXT_ENTITYID, coalesce(COUNTER_PARTY_ENTITYID, 'NaN') AS COUNTER_PARTY_ENTITYID, "
            "POSTING_DATE, ext_country AS entity_countries FROM lim WHERE EXT_ENTITYID IS NOT NULL",
        ),
        "driver_scan": _graph_sql([], f"SELECT DISTINCT EXT_ENTITYID, VINTAGE_DT FROM drv WHERE VINTAGE_DT = DATE '{v0}'"),
        "trxn_clean": _graph_sql(
            [],
            "SELECT EXT_ENTITYID, array_to_string(combinedCountryCodes, ',') AS entity_countries, "
            "COUNTER_PARTY_ENTITYID, array_to_string(COUNTER_PARTY_COMBINEDCOUNTRYCODES, ',') AS cp_countries, "
            "TRXN_REF_ID, POSTING_DATE FROM trxn",
        ),
        "country_risk": _graph_sql(
            [],
            f"""SELECT country, count(*) AS n_mentions,
       CAST(country IN {_in(risk_countries('hrg'))} AS INTEGER) AS in_hrg,
       CAST(country IN {_in(risk_countries('vhrg'))} AS INTEGER) AS in_vhrg
FROM (SELECT unnest(combinedCountryCodes) AS country FROM trxn
      UNION ALL SELECT unnest(COUNTER_PARTY_COMBINEDCOUNTRYCODES) FROM trxn) c
GROUP BY country""",
        ),
        "risk_flags": _graph_sql(
            [], "SELECT TRXN_REF_ID, entity_hrg_flag, cp_hrg_flag, entity_vhrg_flag, cp_vhrg_flag FROM tf"
        ),
        "vintage_horizon": _graph_sql(
            [],
            f"SELECT DISTINCT VINTAGE_DT FROM (VALUES {batch_dates}) x(VINTAGE_DT), customer "
            f"WHERE VINTAGE_DT BETWEEN DATE '{BATCH_START.isoformat()}' "
            f"AND CAST(DATE '{BATCH_START.isoformat()}' + INTERVAL {BATCH_MONTHS} MONTH AS DATE)",
        ),
        "date_range": _graph_sql(
            [],
            "SELECT CAST(date_trunc('month', POSTING_DATE) AS DATE) AS posting_month, count(*) AS n_trxn FROM tf "
            f"WHERE POSTING_DATE BETWEEN CAST(DATE '{RANGE_START.isoformat()}' - INTERVAL 12 MONTH AS DATE) "
            f"AND CAST(DATE '{RANGE_START.isoformat()}' + INTERVAL 31 MONTH AS DATE) GROUP BY ALL",
        ),
        "window_slice": _graph_sql([], f"SELECT {K}, TRXN_REF_ID, POSTING_DATE FROM ts"),
        "graph_vertices": _graph_sql([], f"SELECT {K}, id FROM v"),
        "graph_edges": _graph_sql([], f"SELECT {K}, src, dst FROM e"),
        "degrees": _graph_sql([], f"SELECT {K}, id, degree FROM deg"),
        "pagerank": _graph_sql(_pagerank_ctes(), f"SELECT {K}, id, round(pagerank, 6) AS pagerank FROM pr"),
        "components": _graph_sql(_component_ctes(), f"SELECT {K}, id, comp AS component FROM cc", recursive=True),
        "network_size": _graph_sql(_component_ctes(), f"SELECT {K}, id, network_size FROM ns", recursive=True),
        "label_propagation": _graph_sql(_label_ctes(), f"SELECT {K}, id, label FROM lp"),
        "community_metrics": _graph_sql(
            _label_ctes() + _community_ctes(),
            f"SELECT {K}, label, community_size, edge_count, community_density, community_avg_degree FROM cmm",
        ),
        "high_risk_nodes": _graph_sql(_neighbor_ctes(), f"SELECT {K}, id FROM hr"),
        "vertex_risk": _graph_sql(_neighbor_ctes(), f"SELECT {K}, id, is_high_risk FROM vr"),
        "edge_risk": _graph_sql(_neighbor_ctes(), f"SELECT {K}, src, dst, src_is_high_risk, dst_is_high_risk FROM er"),
        "neighbor_counts": _graph_sql(_neighbor_ctes(), f"SELECT {K}, id, high_risk_neighbor_count FROM nc"),
        "neighbor_features": _graph_sql(_neighbor_ctes(), f"SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct FROM nf"),
        "centrality_features": _graph_sql(
            lp_all + _centrality_ctes(),
            f"SELECT {K}, EXT_ENTITYID, degree_centrality, pagerank_centrality, eigenvector_centrality, "
            "community_size, community_density, average_degree, network_size FROM cf",
            recursive=True,
        ),
        "network_features": _graph_sql(
            lp_all + _centrality_ctes() + _neighbor_ctes() + _wide_ctes(), _wide_select(), recursive=True
        ),
        "graph_stats": _graph_sql(
            _label_ctes() + _component_ctes(),
            f"""SELECT s.VINTAGE_DT, s.window_m, s.n_vertices,
       coalesce(x.n_edges, 0) AS n_edges, CAST(coalesce(x.n_self_loops, 0) AS BIGINT) AS n_self_loops,
       coalesce(i.n_isolated, 0) AS n_isolated, c.n_components, l.n_communities
FROM (SELECT {K}, count(*) AS n_vertices FROM v GROUP BY ALL) s
LEFT JOIN (SELECT {K}, count(*) AS n_edges, sum(CASE WHEN src = dst THEN 1 ELSE 0 END) AS n_self_loops
           FROM e GROUP BY ALL) x ON {_on('s', 'x')}
LEFT JOIN (SELECT v.VINTAGE_DT, v.window_m, count(*) AS n_isolated FROM v
           LEFT JOIN deg ON {_on('v', 'deg')} AND deg.id = v.id WHERE deg.id IS NULL GROUP BY ALL) i ON {_on('s', 'i')}
LEFT JOIN (SELECT {K}, count(DISTINCT comp) AS n_components FROM cc GROUP BY ALL) c ON {_on('s', 'c')}
LEFT JOIN (SELECT {K}, count(DISTINCT label) AS n_communities FROM lp GROUP BY ALL) l ON {_on('s', 'l')}""",
            recursive=True,
        ),
        "ordered_limit": _graph_sql(
            [], "SELECT DISTINCT EXT_ENTITYID, VINTAGE_DT FROM drv ORDER BY EXT_ENTITYID, VINTAGE_DT LIMIT 100"
        ),
        "strip_prefix": _wire_sql(f"SELECT TRXN_REF_ID, {strip_cols} FROM wire"),
        "wire_projection": _wire_sql(f"SELECT {', '.join(wire_present)} FROM wire"),
        "wire_parties": _wire_sql(
            f"SELECT * FROM ({parties}) p WHERE coalesce(party_type, acct_id, name, country) IS NOT NULL"
        ),
        "sanction_flag": _wire_sql(
            f"SELECT TRXN_REF_ID, CAST(coalesce(list_has_any([ORIG_REMITTER_COUNTRY, BENEF_COUNTRY], {sanction}), false) "
            "AS INTEGER) AS sanction_evasion_flag FROM wire"
        ),
        "prefix_flag": _wire_sql(f"SELECT TRXN_REF_ID, CAST(({prefix_test}) AS INTEGER) AS risky_prefix_flag FROM wire"),
        "exclude_codes": _wire_sql(
            f"SELECT TRXN_REF_ID, SIC_CODE FROM wire WHERE NOT coalesce(SIC_CODE IN {_in(EXCLUDED_SIC_CODES)}, false)"
        ),
        "write_append": _graph_sql(
            _neighbor_ctes(),
            f"SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct FROM nf UNION ALL SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct FROM nf",
        ),
        "write_overwrite_partitions": _graph_sql(
            _neighbor_ctes(), f"SELECT {K}, EXT_ENTITYID, vhrg_neighbor_ct FROM nf"
        ),
        "run_features": _with(
            _base_ctes(RUN_WINDOWS) + lp_all + _centrality_ctes() + _neighbor_ctes() + _wide_ctes(RUN_WINDOWS),
            _wide_select(RUN_WINDOWS),
            recursive=True,
        ),
    }


_WIRE_FIXTURE_COLUMNS = (
    "TRXN_REF_ID", "BENEF_ACCT_ID", "BENEF_COUNTRY", "BENEF_NAME", "BENEF_TYPE", "ORIG_REMITTER_ACCT_ID",
    "ORIG_REMITTER_AMT_ACTIVITY", "ORIG_REMITTER_COUNTRY", "ORIG_REMITTER_NAME", "ORIG_REMITTER_ID_TYPE",
    "POSTING_DATE", "SENDING_INSTN_ACCT_ID", "SENDING_INSTN_COUNTRY", "SENDING_INSTN_NAME", "RCV_INSTN_ACCT_ID",
    "TP_ORIGIN_ACCT_ID",
    "TP_ORIGIN_NAME", "TP_ORIGIN_COUNTRY", "TP_ORIGIN_TYPE", "TP_BENEF_ACCT_ID", "TP_BENEF_NAME",
    "TP_BENEF_COUNTRY", "TP_BENEF_TYPE", "TRXN_AMOUNT", "TRXN_CURRENCY_CD", "SIC_CODE",
)


def _wire_col(c: str) -> str:
    return f"CAST({c} AS VARCHAR)" if c in _WIRE_FIXTURE_COLUMNS else "CAST(NULL AS VARCHAR)"


def oracle_sql() -> dict[str, str]:
    return {**_oracles(), **(_llm.ORACLE_SQL if _llm else {})}
