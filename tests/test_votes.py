"""Votes of a numbered graph, and steps that the build of a graph saves."""

import os
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from netfeat.constants import VERY_HIGH_RISK_COUNTRIES
from netfeat.functions.columns import FEW_COUNTRIES, country_flag
from netfeat.operators import labels as L
from netfeat.operators.community import community_metrics
from netfeat.operators.skew import SkewConfig
from netfeat.operators.timeline import CHUNK_COL, MASK, Timeline, run_changes
from netfeat.plans.features import prepare
from netfeat.sources.tpch import tpch_transactions
from test_plans import SF, conf
from test_timeline import MONTH_ENDS, random_trxn, snapshots


def graph_of(spark, skew=SkewConfig()):
    trxn = random_trxn(spark, 400)
    return prepare(trxn, timeline=Timeline.of(snapshots(spark, MONTH_ENDS[:3], (1, 6))), skew=skew)


def rounds(vertices, edges, n):
    """Label propagation and the inner edges of its communities, by hand."""
    label = {v: v[1] for v in vertices}
    for _ in range(n):
        votes = {v: Counter() for v in vertices}
        for s, a, b in edges:
            votes[s, a][label[s, b]] += 1
            votes[s, b][label[s, a]] += 1
        label = {v: min(votes[v], key=lambda x: (-votes[v][x], x)) if votes[v] else label[v] for v in vertices}
    return label, Counter((s, label[s, a]) for s, a, b in edges if label[s, a] == label[s, b])


@pytest.mark.parametrize("way", ["one long", "counted", "hot"])
def test_labels_and_communities_of_a_numbered_graph(spark, way):
    sg = graph_of(spark, SkewConfig(threshold=4) if way == "hot" else SkewConfig())
    g = sg.graph
    if way == "counted":
        g.snapshots = None
    assert (g.hot() is not None) == (way == "hot")
    vertices = [tuple(r) for r in g.vertices.select("snap", "id").collect()]
    edges = [tuple(r) for r in g.edges.select("snap", "src", "dst").collect()]
    for n in (0, 1, 2, 5):
        want, inner = rounds(vertices, edges, n)
        got = L.label_propagation(g, n)
        assert {(r.snap, r.id): r.label for r in got.collect()} == want
        found = {(r.snap, r.label): (r.community_size, r.edge_count) for r in community_metrics(g, got).collect()}
        sizes = Counter((s, x) for (s, _), x in want.items())
        assert found == {key: (sizes[key], inner[key]) for key in sizes}
    sg.discard()


def test_a_task_finds_the_winner_of_each_vertex():
    rng, ids = random.Random(3), 50
    votes = [(rng.randrange(3), rng.randrange(20), rng.randrange(6)) for _ in range(600)]
    rows = [(s * ids + v) * ids + x for s, v, x in votes]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + 70], pa.int64())], names=["vote"]) for i in range(0, 600, 70)]
    out = [tuple(r.values()) for b in L._winners_task(ids)(iter(batches)) for r in b.to_pylist()]
    n = Counter(votes)
    want = {(s, v): min((x for a, b, x in n if (a, b) == (s, v)), key=lambda x: (-n[s, v, x], x)) for s, v, _ in votes}
    assert sorted(out) == sorted((s, v, x) for (s, v), x in want.items())
    assert list(L._winners_task(ids)(iter([]))) == []


def test_the_build_knows_that_no_vertex_is_hot(spark, monkeypatch):
    sg = graph_of(spark)
    monkeypatch.setattr("netfeat.operators.graph.degrees", lambda g: pytest.fail("degrees were counted"))
    monkeypatch.setattr(sg.graph, "skew", SkewConfig(threshold=1))  # were it asked, there would be hot ones
    assert sg.graph.no_hub and sg.graph.hot() is None
    sg.discard()


def test_changes_visit_the_places_of_the_snapshots_only(spark):
    spans = spark.createDataFrame([(0, "a", 0b101), (0, "b", 0b110)], f"{CHUNK_COL} int, id string, {MASK} long")
    short, long = run_changes(spans, ["id"], 3), run_changes(spans, ["id"])
    assert sorted(short.collect()) == sorted(long.collect())
    assert "62" not in short._jdf.queryExecution().analyzed().toString()


def test_country_flags_of_short_and_long_arrays(spark):
    rng, codes = random.Random(1), VERY_HIGH_RISK_COUNTRIES
    some = [None, "USA", "DEU", codes[0], codes[-1]]
    rows = [(None,), ([],)] + [([rng.choice(some[: rng.choice((3, 5))]) for _ in range(rng.randint(1, FEW_COUNTRIES + 3))],) for _ in range(300)]
    df = spark.createDataFrame(rows, "c array<string>").select("c", country_flag("c", codes).alias("flag"))
    assert [r.flag for r in df.collect()] == [int(bool({*(c or ())} & {*codes})) for (c,) in rows]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_customers_meet_the_orders_before_the_lines(spark):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        df = tpch_transactions(spark, SF).select(F.count(F.lit(1)))
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {key: next(line.index("Join") for line in lines if "Join" in line and key in line) for key in ("c_custkey", "l_orderkey")}
    assert depth["l_orderkey"] < depth["c_custkey"]
