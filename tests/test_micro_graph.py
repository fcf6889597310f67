"""Golden values of the hand-made micro graph (FIXTURES.md section 2), every operator."""

import pytest

import micro
from netfeat.constants import SNAPSHOT_KEYS
from netfeat.operators.clean import clean_transactions
from netfeat.operators.community import community_metrics, vertex_communities
from netfeat.operators.components import connected_components, network_sizes
from netfeat.operators.graph import degrees
from netfeat.operators.labels import label_propagation
from netfeat.operators.pagerank import pagerank
from netfeat.operators.risk import add_risk_flags
from netfeat.operators.skew import SkewConfig
from netfeat.operators.snapshots import assign_snapshots, snapshot_table
from netfeat.plans.features import neighbor_features, network_features, prepare

KEYS = list(SNAPSHOT_KEYS)


def _graph(spark, skew):
    trxn = add_risk_flags(clean_transactions(micro.transactions(spark)))
    snaps = snapshot_table(micro.drivers(spark), [6, 12])
    return prepare(assign_snapshots(trxn, snaps), KEYS, skew=skew)


@pytest.mark.parametrize("threshold", [1_000_000, 1], ids=["plain", "all-salted"])
def test_golden_values(spark, threshold):
    skew = SkewConfig(threshold=threshold)
    sg = _graph(spark, skew)
    g = sg.graph
    deg = {(r.window_m, r.id): r.degree for r in degrees(g).collect()}
    pr = {(r.window_m, r.id): r.pagerank for r in pagerank(g).collect()}
    lab = label_propagation(g)
    labels = {(r.window_m, r.id): r.label for r in lab.collect()}
    comm = {(r.window_m, r.id): r for r in vertex_communities(lab, community_metrics(g, lab), KEYS, skew).collect()}
    ns = {(r.window_m, r.id): r.network_size for r in network_sizes(connected_components(g), KEYS, skew).collect()}
    nb = {(r.window_m, r.EXT_ENTITYID): r.vhrg_neighbor_ct for r in neighbor_features(sg).collect()}
    for w, gold in micro.GOLDEN.items():
        assert sum(1 for (ww, _) in pr if ww == w) == len(gold)
        for vid, (dg, p, lb, cs, den, avg, size, nbc) in gold.items():
            c = comm[(w, vid)]
            assert deg.get((w, vid)) == dg, (w, vid)
            assert pr[(w, vid)] == pytest.approx(p, abs=1e-8), (w, vid)
            assert labels[(w, vid)] == lb, (w, vid)
            assert (c.community_size, c.community_density, c.community_avg_degree) == (cs, den, avg), (w, vid)
            assert ns[(w, vid)] == size, (w, vid)
            assert nb.get((w, vid), 0) == nbc, (w, vid)


def test_edge_counts(spark):
    g = _graph(spark, SkewConfig()).graph
    e = {r.window_m: r.n for r in g.edges.groupBy("window_m").count().withColumnRenamed("count", "n").collect()}
    v = {r.window_m: r.n for r in g.vertices.groupBy("window_m").count().withColumnRenamed("count", "n").collect()}
    assert v == {6: 10, 12: 11}
    assert e == {6: 8, 12: 10}


def test_driver_output(spark):
    trxn = add_risk_flags(clean_transactions(micro.transactions(spark)))
    out = {r.EXT_ENTITYID: r for r in network_features(micro.drivers(spark), trxn, [6, 12]).collect()}
    assert sorted(out) == sorted(micro.DRIVERS)
    for vid in "ABCFPQR":
        r = out[vid]
        assert r.eigenvector_centrality_6m == 0.5
        assert r.degree_centrality_6m == micro.GOLDEN[6][vid][0]
    for vid in "DE":
        assert out[vid].degree_centrality_6m is None
        assert out[vid].pagerank_centrality_6m is None
        assert out[vid].vhrg_neighbor_ct_6m == 0
    z = out["Z"]
    assert all(z[c] is None for c in z.asDict() if c not in ("EXT_ENTITYID", "VINTAGE_DT"))
    assert "G" not in out and "H" not in out


def test_density_above_one(spark):
    """Fully reciprocal triangle: one community, density 2.0, average degree 4.0."""
    import datetime as dt

    rows = [(a, b) for a in "XYZ" for b in "XYZ" if a != b]
    trxn = spark.createDataFrame(
        [(a, None, b, None, f"r{i}", None, dt.date(2024, 9, 1)) for i, (a, b) in enumerate(rows)], micro.SCHEMA
    )
    sg = prepare(add_risk_flags(clean_transactions(trxn)), [])
    g = sg.graph
    lab = label_propagation(g)
    m = community_metrics(g, lab).collect()
    assert len(m) == 1
    assert (m[0].community_size, m[0].edge_count) == (3, 6)
    assert m[0].community_density == 2.0 and m[0].community_avg_degree == 4.0


def test_single_graph_without_keys(spark):
    """The 6-month slice as one graph (no snapshot keys): same centrality values."""
    from netfeat.operators.snapshots import slice_window
    from netfeat.plans.features import centrality_features

    trxn = add_risk_flags(clean_transactions(micro.transactions(spark)))
    sg = prepare(slice_window(trxn, micro.VINTAGE, 6), [])
    try:
        rows = {r.EXT_ENTITYID: r for r in centrality_features(sg).collect()}
    finally:
        sg.discard()
    gold = micro.GOLDEN[6]
    # vertices with an edge that occur as entity in the slice (G is only ever a counterparty)
    expected_ids = {v for v, g in gold.items() if g[0] is not None} - {"G"}
    assert set(rows) == expected_ids
    for vid in expected_ids:
        dg, p, _, cs, den, avg, size, _ = gold[vid]
        r = rows[vid]
        assert (r.degree_centrality, r.community_size, r.community_density, r.average_degree, r.network_size) == (
            dg, cs, den, avg, size)
        assert r.pagerank_centrality == pytest.approx(p, abs=1e-8)
        assert r.eigenvector_centrality == 0.5
