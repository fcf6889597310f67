"""Invariants of the derived test graphs, batching, order independence, FIXTURES sizes."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from netfeat.operators.community import community_metrics
from netfeat.operators.components import connected_components, network_sizes
from netfeat.operators.graph import degrees, graph_stats
from netfeat.operators.labels import label_propagation
from netfeat.operators.neighbors import edge_risk, neighbor_counts, vertex_risk
from netfeat.operators.pagerank import pagerank
from netfeat.plans.features import network_features, prepare

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
K = entry.KEYS
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def sg(spark):
    entry._ready(spark)
    return prepare(entry._sliced(spark, SF), K)


def _by_key(df, col):
    return {(r[0], r[1]): r[2] for r in df.groupBy(*K).agg(F.sum(col)).collect()}


def test_degree_sum_is_twice_edges(sg):
    g = sg.graph
    e = {(r[0], r[1]): r[2] for r in g.edges.groupBy(*K).count().collect()}
    d = _by_key(degrees(g), "degree")
    assert d == {k: 2 * n for k, n in e.items()}


def test_pagerank_sums_to_vertex_count(sg):
    g = sg.graph
    v = {(r[0], r[1]): r[2] for r in g.vertices.groupBy(*K).count().collect()}
    p = _by_key(pagerank(g), "pagerank")
    assert p.keys() == v.keys()
    for k in v:
        assert p[k] == pytest.approx(v[k], rel=1e-9)


def test_components_partition_the_vertices(sg):
    g = sg.graph
    comp = connected_components(g)
    sizes = network_sizes(comp, K, g.skew)
    per_comp = comp.groupBy(*K, "component").count()
    total = {(r[0], r[1]): r[2] for r in per_comp.groupBy(*K).agg(F.sum("count")).collect()}
    v = {(r[0], r[1]): r[2] for r in g.vertices.groupBy(*K).count().collect()}
    assert total == v
    # no edge joins two components
    c = comp.select(*K, "id", "component")
    cross = (
        g.edges.join(c.withColumnRenamed("id", "src").withColumnRenamed("component", "cs"), [*K, "src"])
        .join(c.withColumnRenamed("id", "dst").withColumnRenamed("component", "cd"), [*K, "dst"])
        .where(F.col("cs") != F.col("cd"))
        .count()
    )
    assert cross == 0
    # component name is the smallest member
    bad = comp.groupBy(*K, "component").agg(F.min("id").alias("m")).where(F.col("m") != F.col("component")).count()
    assert bad == 0
    assert sizes.count() == g.vertices.count()


def test_community_edges_within_total(sg):
    g = sg.graph
    m = community_metrics(g, label_propagation(g))
    inner = _by_key(m, "edge_count")
    e = {(r[0], r[1]): r[2] for r in g.edges.groupBy(*K).count().collect()}
    for k, n in inner.items():
        assert n <= e[k]


def test_neighbor_count_total(sg):
    """Sum of counts = number of edge ends whose other end is high-risk."""
    g = sg.graph
    er = edge_risk(g, vertex_risk(g, sg.risky))
    total = _by_key(neighbor_counts(g, er), "high_risk_neighbor_count")
    ends = _by_key(er.withColumn("n", F.col("src_is_high_risk") + F.col("dst_is_high_risk")), "n")
    assert total == ends


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batched_equals_single_vintage(spark):
    entry._ready(spark)
    drivers = entry._drivers(spark, SF)
    trxn = entry._trxn(spark, SF)
    both = entry._round(network_features(drivers, trxn, [1, 6]), ["pagerank_centrality_1m", "pagerank_centrality_6m"])
    for v in entry.TEST_VINTAGES:
        one = network_features(drivers.where(F.col("VINTAGE_DT") == F.lit(v)), trxn, [1, 6])
        one = entry._round(one, ["pagerank_centrality_1m", "pagerank_centrality_6m"])
        assert _rows(one) == _rows(both.where(F.col("VINTAGE_DT") == F.lit(v)))


def test_order_independence(spark):
    entry._ready(spark)
    drivers = entry._drivers(spark, SF)
    trxn = entry._trxn(spark, SF)
    a = network_features(drivers, trxn, [6])
    b = network_features(drivers.repartition(3), trxn.repartition(5, "TRXN_REF_ID").orderBy(F.rand(7)), [6])
    cols = ["pagerank_centrality_6m"]
    assert _rows(entry._round(a, cols)) == _rows(entry._round(b, cols))


@pytest.mark.skipif(not os.path.isdir(SF01), reason="sf0.01 not present")
def test_fixture_sizes_sf001(spark):
    """Graph sizes of FIXTURES.md section 3 at sf0.01 (V, E, isolated, components, labels)."""
    entry._ready(spark)
    g = prepare(entry._sliced(spark, SF01), K).graph
    stats = {
        (str(r.VINTAGE_DT), r.window_m): (r.n_vertices, r.n_edges, r.n_isolated, r.n_components, r.n_communities)
        for r in graph_stats(g, connected_components(g), label_propagation(g)).collect()
    }
    expected = {
        ("1997-12-31", 1): (747, 707, 21, 54, 293),
        ("1997-12-31", 6): (1880, 4285, 7, 8, 224),
        ("1997-12-31", 12): (1988, 8604, 3, 4, 35),
        ("1998-06-30", 1): (730, 711, 19, 50, 277),
        ("1998-06-30", 6): (1860, 4274, 17, 18, 249),
        ("1998-06-30", 12): (1987, 8532, 4, 5, 42),
    }
    assert stats == expected


def test_flagship_with_hot_vertices_equals_plain(spark):
    """The whole feature job with a tiny hot threshold (many salted / broadcast hot
    vertices, hot components and communities) gives the same table."""
    from netfeat.operators.skew import SkewConfig

    entry._ready(spark)
    drivers = entry._drivers(spark, SF)
    trxn = entry._trxn(spark, SF)
    cols = ["pagerank_centrality_6m", "pagerank_centrality_12m"]
    plain = entry._round(network_features(drivers, trxn, [6, 12]), cols)
    hot = entry._round(network_features(drivers, trxn, [6, 12], skew=SkewConfig(threshold=3)), cols)
    assert _rows(plain) == _rows(hot)
