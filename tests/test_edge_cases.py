"""Empty inputs, graphs without edges, batch size of run()."""

import datetime as dt
import os

from pyspark.sql import functions as F

import micro
from netfeat.operators.clean import clean_transactions
from netfeat.operators.components import connected_components
from netfeat.operators.graph import build_graph, degrees, graph_stats
from netfeat.operators.labels import label_propagation
from netfeat.operators.pagerank import pagerank
from netfeat.operators.risk import add_risk_flags
from netfeat.plans.features import network_features, run
from netfeat.sources.sinks import read_features


def test_no_drivers(spark):
    trxn = add_risk_flags(clean_transactions(micro.transactions(spark)))
    empty = micro.drivers(spark).where(F.lit(False))
    out = network_features(empty, trxn, [6])
    assert out.count() == 0
    assert out.columns[:2] == ["EXT_ENTITYID", "VINTAGE_DT"] and len(out.columns) == 10


def test_graph_without_edges(spark):
    """Only invalid partners: every vertex isolated."""
    rows = [(x, None, "9999", None, f"t{i}", None, dt.date(2024, 1, 5)) for i, x in enumerate("ABC")]
    trxn = clean_transactions(spark.createDataFrame(rows, micro.SCHEMA))
    g = build_graph(trxn)
    assert g.edges.count() == 0 and g.vertices.count() == 3
    assert degrees(g).count() == 0
    assert {r.id: r.component for r in connected_components(g).collect()} == {"A": "A", "B": "B", "C": "C"}
    assert {r.id: r.pagerank for r in pagerank(g).collect()} == {"A": 1.0, "B": 1.0, "C": 1.0}
    assert {r.id: r.label for r in label_propagation(g).collect()} == {"A": "A", "B": "B", "C": "C"}
    stats = graph_stats(g, connected_components(g), label_propagation(g)).collect()
    assert [tuple(r) for r in stats] == [(3, 0, 0, 3, 3, 3)]
    g.release()


def test_run_batch_sizes_agree(spark, scratch_dir):
    """Two vintages in one pass or one vintage per pass: same table."""
    drivers = micro.drivers(spark).unionByName(
        micro.drivers(spark).withColumn("VINTAGE_DT", F.lit(dt.date(2024, 6, 30)))
    )
    outs = []
    for k in (None, 1):
        target = os.path.join(scratch_dir, f"batch_{k}")
        done = run(spark, drivers, micro.transactions(spark), target, start="2024-01-01", months=12, vintages_per_batch=k)
        assert done == [dt.date(2024, 6, 30), dt.date(2024, 9, 30)]
        df = read_features(spark, target)
        cols = sorted(df.columns)
        outs.append(sorted(tuple(r) for r in df.select(*cols).withColumn("VINTAGE_DT", F.col("VINTAGE_DT").cast("string")).collect()))
    assert outs[0] == outs[1]
    assert len(outs[0]) == 2 * len(micro.DRIVERS)
