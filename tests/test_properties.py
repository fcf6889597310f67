"""Property tests: salted joins equal plain joins; the risk level switches the neighbour set."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import micro
from netfeat.constants import HIGH_RISK_COUNTRIES, VERY_HIGH_RISK_COUNTRIES
from netfeat.operators.clean import clean_transactions
from netfeat.operators.risk import add_risk_flags
from netfeat.operators.skew import SkewConfig, hot_keys, salted_join
from netfeat.operators.snapshots import slice_window
from netfeat.plans.features import neighbor_features, prepare


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.integers(0, 6), min_size=1, max_size=120),
    threshold=st.integers(1, 20),
    how=st.sampled_from(["inner", "left"]),
)
def test_salted_join_is_a_join(spark, keys, threshold, how):
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v long")
    table = spark.createDataFrame([(k, k * 10) for k in range(0, 7, 2)], "k int, attr int")
    hot = hot_keys(big.groupBy("k").count(), ["k"], "count", SkewConfig(threshold=threshold))
    got = sorted(map(tuple, salted_join(big, table, ["k"], hot, F.col("v"), how).select("k", "v", "attr").collect()), key=repr)
    want = sorted(map(tuple, big.join(table, ["k"], how).select("k", "v", "attr").collect()), key=repr)
    assert got == want


def test_level_hrg_counts_against_brute_force(spark):
    """High-risk (both lists) neighbour counts on the micro graph, 12-month window."""
    trxn = add_risk_flags(clean_transactions(micro.transactions(spark)))
    window = slice_window(trxn, micro.VINTAGE, 12)
    sg = prepare(window, [], level="hrg")
    try:
        got = {r.EXT_ENTITYID: r.hrg_neighbor_ct for r in neighbor_features(sg, level="hrg").collect()}
    finally:
        sg.graph.release()
    codes = set(HIGH_RISK_COUNTRIES) | set(VERY_HIGH_RISK_COUNTRIES)
    lo = dt.date(2023, 9, 30)
    rows = [(e, c, dt.date.fromisoformat(d)) for _, e, c, d in micro.ROWS if e is not None]
    rows = [(e, c if c is not None else "NaN", d) for e, c, d in rows if lo < d <= micro.VINTAGE]
    risky = {x for e, c, _ in rows for x in (e, c) if set(micro.COUNTRIES.get(x) or []) & codes}
    valid = lambda x: x not in ("9999", "NaN", "")
    edges = {(e, c) for e, c, _ in rows if valid(e) and valid(c)}
    count = defaultdict(int)
    for a, b in edges:
        count[a] += b in risky
        count[b] += a in risky
    want = {e: count.get(e, 0) for e, _, _ in rows}
    assert got == want
