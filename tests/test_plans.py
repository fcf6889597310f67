"""Physical-plan properties that the design relies on at scale."""

import contextlib
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from netfeat.operators.skew import SkewConfig
from netfeat.plans.features import prepare

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_snapshot_assignment_is_a_broadcast_equi_join(spark):
    p = plan(entry._sliced(spark, SF))
    assert "BroadcastHashJoin [_month" in p
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_scan_reads_few_columns_with_pushed_date_bounds(spark):
    p = plan(entry._sliced(spark, SF))
    orders = [line for line in p.splitlines() if "FileScan parquet" in line and "orders.parquet" in line]
    assert orders, p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in orders[0]
    assert "GreaterThanOrEqual(o_orderdate" in orders[0] and "LessThan(o_orderdate" in orders[0]


def test_iterative_lookup_reads_edges_in_place(spark):
    entry._ready(spark)
    g = prepare(entry._sliced(spark, SF), entry.KEYS).graph
    labels = g.vertices.select(*entry.KEYS, "id", F.col("id").alias("label"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = plan(g.gather("src", labels))
    g.release()
    assert "Bucketed: true" in p
    # the only exchange is the vertex-state side; the edge table is not shuffled
    assert p.count("Exchange hashpartitioning") == 1, p


def test_hot_vertices_are_salted(spark):
    entry._ready(spark)
    g = prepare(entry._sliced(spark, SF), entry.KEYS, skew=SkewConfig(threshold=3)).graph
    assert g.hot() is not None
    labels = g.vertices.select(*entry.KEYS, "id", F.col("id").alias("label"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        salted = plan(g.join_endpoint(g.edges, "src", labels))
        gathered = plan(g.gather("src", labels))
    g.release()
    assert "_salt" in salted and "xxhash64(dst" in salted
    assert "_salt" in gathered and "BroadcastHashJoin" not in gathered  # hot edges are split, nothing is broadcast


def test_flagship_has_no_python_udf_and_no_cartesian_product(spark):
    entry._ready(spark)
    p = plan(entry.q_network_features(spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in p


def test_graph_parts_are_partition_pruned_reads(spark):
    entry._ready(spark)
    sg = prepare(entry._sliced(spark, SF), entry.KEYS)
    for df, kind in ((sg.graph.vertices, "id"), (sg.graph.edges, "edge"), (sg.entities, "id"), (sg.risky, "id")):
        p = plan(df)
        assert f"PartitionFilters: [isnotnull(kind" in p and f"(kind#" in p and f"= {kind})" in p, p
