"""Snapshot masks, counts from changes, and the plans that rest on them."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import micro
from netfeat.operators import timeline as T
from netfeat.operators.graph import Graph, degrees, out_degrees
from netfeat.operators.neighbors import risky_neighbor_counts
from netfeat.operators.risk import add_risk_flags
from netfeat.operators.clean import clean_transactions
from netfeat.operators.skew import SkewConfig
from netfeat.operators.snapshots import assign_snapshots, snapshot_table
from netfeat.operators.timeline import CHUNK_COL, MASK, SNAP, Timeline
from netfeat.plans.features import prepare
from test_plans import conf, plan

KEYS = ["VINTAGE_DT", "window_m"]


def snapshots(spark, vintages, windows):
    return snapshot_table(spark.createDataFrame([(v,) for v in vintages], "VINTAGE_DT date"), windows)


def random_trxn(spark, n=1500, seed=4):
    """Payments over three years between a few ids; sentinels and null partners mixed in."""
    rng = random.Random(seed)
    ids = [f"e{k}" for k in range(25)] + ["9999", ""]
    countries = [None, [], ["USA"], ["AFG"], ["IRN", "USA"], ["ALB"]]
    rows = [
        (rng.choice(ids), rng.choice(countries), rng.choice([*ids, None]), rng.choice(countries), f"T{k}", None,
         dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(1100)))
        for k in range(n)
    ]
    return add_risk_flags(clean_transactions(spark.createDataFrame(rows, micro.SCHEMA)))


MONTH_ENDS = [dt.date(2022, m, 28) for m in range(1, 13)] + [dt.date(2023, 2, 28), dt.date(2023, 10, 31), dt.date(2024, 2, 29)]


@pytest.mark.parametrize("chunk", [62, 7, 1])
def test_masks_hold_the_snapshots_of_each_row(spark, monkeypatch, chunk):
    monkeypatch.setattr(T, "CHUNK", chunk)
    trxn = random_trxn(spark)
    snaps = snapshots(spark, MONTH_ENDS, (1, 6, 12))
    line = Timeline.of(snaps)
    assert len(line) == 45
    got = line.named(line.expand(line.assign(trxn))).select(*KEYS, "TRXN_REF_ID")
    want = assign_snapshots(trxn, snaps).select(*KEYS, "TRXN_REF_ID")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("chunk", [62, 7, 1])
def test_counts_are_running_sums_of_changes(spark, monkeypatch, chunk):
    """Any set of snapshots, also with gaps and up to the last bit, for several rows of one id."""
    monkeypatch.setattr(T, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows, want = [], {}
    for _ in range(120):
        i, held = rng.choice("abc"), {s for s in range(130) if rng.random() < rng.choice([0.03, 0.5, 0.97])}
        for c in range(-(-130 // chunk)):
            mask = sum(1 << (s - c * chunk) for s in held if s // chunk == c)
            if mask:
                rows.append((c, i, mask))
        for s in held:
            want[s, i] = want.get((s, i), 0) + 1
    df = spark.createDataFrame(rows, f"{CHUNK_COL} int, id string, {MASK} long")
    assert {(r[SNAP], r.id): r.n for r in T.counts_by_snapshot(df, "id", "n").collect()} == want


def test_a_graph_of_masks_is_the_graph_of_sliced_rows(spark):
    trxn, snaps = random_trxn(spark), snapshots(spark, MONTH_ENDS, (1, 12))
    old = prepare(assign_snapshots(trxn, snaps), KEYS)
    for skew in (SkewConfig(), SkewConfig(threshold=3)):
        new = prepare(trxn, skew=skew, timeline=Timeline.of(snaps))

        def same(a, b):
            a = new.named(a)
            assert sorted(map(repr, a.select(*b.columns).collect())) == sorted(map(repr, b.collect()))

        same(new.graph.vertices, old.graph.vertices)
        same(new.graph.edges, old.graph.edges)
        same(new.entities, old.entities)
        same(new.risky, old.risky)
        same(degrees(new.graph), degrees(old.graph))
        same(out_degrees(new.graph), out_degrees(old.graph))
        same(risky_neighbor_counts(new.graph, new.risky, new.risky_spans), risky_neighbor_counts(old.graph, old.risky))
        assert new.graph.sizes() == (old.graph.vertices.count(), old.graph.edges.count())
        new.discard()
    old.discard()


def test_a_fact_is_written_once_for_all_its_snapshots(spark):
    """24 vintages and two windows: a fact with a mask instead of one row a snapshot."""
    vintages = [dt.date(2022 + k // 12, k % 12 + 1, 28) for k in range(24)]
    trxn, snaps = random_trxn(spark), snapshots(spark, vintages, (6, 12))
    new = prepare(trxn, timeline=Timeline.of(snaps))
    old = prepare(assign_snapshots(trxn, snaps), KEYS)
    n_new, n_old = (spark.read.parquet(sg.facts_path).count() for sg in (new, old))
    facts = spark.read.parquet(new.facts_path)
    assert n_new * 10 < n_old
    assert facts.count() == facts.select("kind", CHUNK_COL, "a", "b").distinct().count()
    new.discard()
    old.discard()


def test_no_row_is_copied_for_a_snapshot_before_the_graph(spark):
    """Neither the build nor the counts join the snapshot table; the build aggregates one row a payment and fact."""
    trxn, snaps = random_trxn(spark, 50), snapshots(spark, MONTH_ENDS, (6, 12))
    line = Timeline.of(snaps)
    assert line.assign(trxn).count() <= trxn.count()
    p = plan(line.assign(trxn))
    assert "BroadcastHashJoin [POSTING_DATE" in p and "NestedLoopJoin" not in p and "CartesianProduct" not in p
    sg = prepare(trxn, timeline=line)
    for df in (degrees(sg.graph), risky_neighbor_counts(sg.graph, sg.risky, sg.risky_spans)):
        p = plan(df)
        assert "_bit" not in p and "explode(filter" in p.replace("transform(", "") or "_bit" not in p
        assert "Window" in p and "CartesianProduct" not in p
    assert "_bit" in plan(sg.graph.edges)  # the expansion, where an algorithm asks for it
    sg.discard()


def test_rounds_shuffle_only_partial_sums(spark):
    """State and edges are read in place; a round's one exchange is that of the sums."""
    sg = prepare(random_trxn(spark), timeline=Timeline.of(snapshots(spark, MONTH_ENDS, (6, 12))))
    g = sg.graph
    state = g.put(g.vertex_table().withColumn("rank", F.lit(1.0)))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        sums = g.gather("src", state.frame).groupBy(SNAP, F.col("dst").alias("id")).agg(F.sum("rank").alias("s"))
        p = plan(state.frame.join(sums, [SNAP, "id"], "left"))
    assert p.count("Exchange hashpartitioning") == 1 and p.count("Bucketed: true") == 3, p
    path = state.path
    state = g.put(state.frame, old=state)
    from netfeat.session import path_exists

    assert not path_exists(spark, path) and path_exists(spark, state.path)
    sg.discard()
    assert not path_exists(spark, state.path)


def test_changes_and_rounds_run_in_generated_code(spark):
    """No interpreted lambda a mask, no sort of the edges in a round, and of a numbered graph no sort of the votes."""
    from netfeat.operators import labels as L

    sg = prepare(random_trxn(spark), timeline=Timeline.of(snapshots(spark, MONTH_ENDS, (6, 12))))
    g = sg.graph
    assert "lambda" not in plan(degrees(g))
    own = g.vertex_table().withColumn("label", F.col("id"))
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        p = plan(g.gather("src", own))
    assert "ShuffledHashJoin" in p and "Sort" not in p.replace("SortOrder", ""), p
    most, of_best = L._winner(g)
    votes = spark.createDataFrame([(1, 5, 2), (1, 3, 2), (1, 0, 1), (2, 0, 7), (2, 24, 7), (3, 24, 1)], "id long, label long, n long")
    best = votes.groupBy("id").agg(most.alias("best"))
    assert "SortAggregate" not in plan(best)
    got = {r.id: r.label for r in best.select("id", of_best.alias("label")).collect()}
    assert got == {1: 3, 2: 0, 3: 24}
    g.know_sizes(g.sizes()[0], 1 << 61, g._ids)  # too many for one long
    most, of_best = L._winner(g)
    best = votes.groupBy("id").agg(most.alias("best")).select("id", of_best.alias("label"))
    assert {r.id: r.label for r in best.collect()} == got
    sg.discard()


def test_star_rounds_leave_no_folder(spark):
    from netfeat.operators.components import connected_components
    from netfeat.session import checkpoint_dir

    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())

    def folders():
        return {s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith(("netfeat_hot", "netfeat_stars"))}

    for numbered in (True, False):
        sg = prepare(random_trxn(spark), skew=SkewConfig(threshold=3), timeline=Timeline.of(snapshots(spark, MONTH_ENDS[:2], (6,))), numbered=numbered)
        sg.graph.hot()
        before = folders()
        connected_components(sg.graph, spread_rounds=0).collect()
        assert folders() == before
        sg.discard()


def test_edges_of_a_snapshot_meet_in_a_few_rounds(spark, monkeypatch):
    """Two chains, whose links lie in many partitions: a round writes its edges once, and with any number of tasks rounds are few."""
    from netfeat.operators import components as C

    writes, written = [], C._written
    monkeypatch.setattr(C, "_written", lambda *args: writes.append(1) or written(*args))
    links = [(i * 7919 % 400 * 10 + c, (i + 1) * 7919 % 400 * 10 + c) for c in (1, 2) for i in range(399)]
    spans = spark.createDataFrame([(0, a, b, 3 if a % 10 == 1 else 2) for a, b in links], "_chunk int, src long, dst long, _mask long").repartition(16)
    ids = sorted({i for link in links for i in link})
    vertices = spark.createDataFrame([(s, i) for s in (0, 1) for i in ids if s or i % 10 == 1], "snap int, id long")
    want = {(s, i): i % 10 for s in (0, 1) for i in ids if s or i % 10 == 1}
    for edges in (4_000_000, 100):
        monkeypatch.setattr(C, "GROUP_EDGES", edges, raising=False)
        writes.clear()
        graph = Graph(vertices, spans.select(F.lit(1).alias("snap"), "src", "dst"), ("snap",), spans=spans)
        got = C.connected_components(graph).collect()
        assert len(got) == len(want) and {(r.snap, r.id): r.component for r in got} == want
        assert len(writes) <= 12, writes
        graph.release(delete_files=True)


def test_no_snapshots_give_empty_frames(spark):
    line = Timeline.of(snapshots(spark, [dt.date(2022, 1, 31)], (1,)).where("false"))
    trxn = random_trxn(spark, 20)
    assert len(line) == 0 and line.months() == []
    sg = prepare(trxn, timeline=line)
    for df in (sg.graph.vertices, sg.graph.edges, sg.entities, sg.risky, degrees(sg.graph)):
        assert sg.named(df).isEmpty() and sg.named(df).columns[:2] == KEYS
    sg.discard()


def test_months_are_those_that_a_snapshot_touches(spark):
    line = Timeline.of(snapshots(spark, [dt.date(2020, 3, 31), dt.date(2022, 2, 28)], (1,)))
    # lo is excluded: 29 February to 31 March, and 28 January to 28 February
    assert line.months() == [dt.date(2020, 3, 1), dt.date(2022, 1, 1), dt.date(2022, 2, 1)]


def test_too_many_snapshots_are_refused(spark, monkeypatch):
    snaps = snapshots(spark, MONTH_ENDS, (1, 6))
    monkeypatch.setattr(T, "MAX_DAYS", 10)
    with pytest.raises(ValueError, match="days"):
        Timeline.of(snaps).days(spark)
    monkeypatch.setattr(T, "MAX_SNAPSHOTS", 10)
    with pytest.raises(ValueError, match="snapshots"):
        Timeline.of(snaps)
