"""Writer modes, readers, run(), and the hot-key salting helpers."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

import micro
from netfeat.operators.skew import SkewConfig, hot_keys, salted_join
from netfeat.plans.features import run
from netfeat.sources.sinks import read_features, write_features
from netfeat.sources.tables import read_driver, read_transactions


def test_write_modes(spark, scratch_dir):
    target = os.path.join(scratch_dir, "features")
    a = spark.createDataFrame(
        [("A", dt.date(2024, 1, 31), 1), ("B", dt.date(2024, 2, 29), 2)], "EXT_ENTITYID string, VINTAGE_DT date, x int"
    )
    write_features(a, target, mode="append")
    write_features(a, target, mode="append")
    assert read_features(spark, target).count() == 4
    b = spark.createDataFrame([("C", dt.date(2024, 2, 29), 3, 9.0)], "EXT_ENTITYID string, VINTAGE_DT date, x int, y double")
    write_features(b, target, mode="overwrite_partitions")
    back = {(r.EXT_ENTITYID, str(r.VINTAGE_DT)): r for r in read_features(spark, target).collect()}
    # January untouched (twice), February replaced by C; the new column is readable
    assert sorted(back) == [("A", "2024-01-31"), ("C", "2024-02-29")]
    assert read_features(spark, target).where("EXT_ENTITYID = 'A'").count() == 2
    assert back[("C", "2024-02-29")].y == 9.0


def test_readers(spark):
    t = read_transactions(spark, micro.transactions(spark), date_from="2024-01-01", date_to="2024-09-30")
    ids = {r.EXT_ENTITYID for r in t.collect()}
    assert None not in ids and "H" not in ids  # T10 before the range, T16 null entity
    cps = {r.COUNTER_PARTY_ENTITYID for r in t.collect()}
    assert "NaN" in cps and None not in cps
    d = read_driver(spark, micro.drivers(spark), vintages=["2024-09-30"], limit=3)
    assert [r.EXT_ENTITYID for r in d.collect()] == ["A", "B", "C"]


def test_run_writes_every_vintage(spark, scratch_dir):
    target = os.path.join(scratch_dir, "run")
    done = run(spark, micro.drivers(spark), micro.transactions(spark), target, start="2024-01-01", months=12)
    assert done == [dt.date(2024, 9, 30)]
    out = read_features(spark, target)
    assert out.count() == len(micro.DRIVERS)
    assert "vhrg_neighbor_ct_12m" in out.columns
    # re-run is idempotent with dynamic partition overwrite
    run(spark, micro.drivers(spark), micro.transactions(spark), target, start="2024-01-01", months=12)
    assert read_features(spark, target).count() == len(micro.DRIVERS)


def test_salted_join_equals_plain_join(spark):
    big = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    table = spark.range(50).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("attr"))
    table = table.unionByName(spark.range(1).select(F.lit("hub").alias("k"), F.lit(-1).cast("long").alias("attr")))
    counts = big.groupBy("k").count()
    hot = hot_keys(counts, ["k"], "count", SkewConfig(threshold=1000))
    got = {r.k for r in hot.collect()}
    assert got == {"hub"}
    n_salt = hot.collect()[0]["_n_salt"]
    assert n_salt == 7  # ceil(6667 / 1000)
    a = salted_join(big, table, ["k"], hot, F.col("v"))
    b = big.join(table, ["k"])
    assert sorted(map(tuple, a.select("k", "v", "attr").collect())) == sorted(map(tuple, b.select("k", "v", "attr").collect()))
    # no salt bucket holds more than about the threshold rows of the hub
    buckets = (
        big.where("k = 'hub'").withColumn("s", F.pmod(F.xxhash64("v"), F.lit(n_salt))).groupBy("s").count().collect()
    )
    assert len(buckets) == n_salt and max(r["count"] for r in buckets) < 1300


def test_every_hot_key_is_salted(spark):
    """However many keys are hot, all of them are split, each by its own count."""
    many = spark.range(5000).select(F.col("id").alias("k"), F.lit(100).cast("long").alias("n"))
    one = spark.range(1).select(F.lit(9000).cast("long").alias("k"), F.lit(1_000_000).cast("long").alias("n"))
    cold = spark.range(1).select(F.lit(9001).cast("long").alias("k"), F.lit(10).cast("long").alias("n"))
    counts = many.unionByName(one).unionByName(cold)
    paths = []
    rows = hot_keys(counts, ["k"], "n", SkewConfig(threshold=10), paths=paths).collect()
    assert {r.k: r["_n_salt"] for r in rows} == {**{k: 10 for k in range(5000)}, 9000: 100_000}
    assert len(paths) == 1
    assert hot_keys(counts, ["k"], "n", SkewConfig(threshold=10), bound=10) is None


def test_refused_bucketed_copy_is_an_error_and_leaves_nothing(spark, monkeypatch):
    """No silent change of plan; what was written belongs to the graph and goes with it."""
    from pyspark.sql.readwriter import DataFrameWriter

    from netfeat.operators.clean import clean_transactions
    from netfeat.operators.graph import build_graph
    from netfeat.operators.pagerank import pagerank

    def refuse(self, *a, **k):
        raise RuntimeError("no catalog here")

    g = build_graph(clean_transactions(micro.transactions(spark)))
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", refuse)
    with pytest.raises(RuntimeError, match="no catalog here"):
        pagerank(g)
    g.release(delete_files=True)
    assert g._tables == [] and g._paths == []


def test_bucket_count_stays_within_sparks_limit(spark):
    from netfeat.operators.clean import clean_transactions
    from netfeat.operators.graph import build_graph

    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        g = build_graph(clean_transactions(micro.transactions(spark)))
        cold, _ = g.by_endpoint("src")
        assert "3 buckets" in spark.sql(f"DESCRIBE EXTENDED {g._tables[0]}").toPandas().to_string() or cold.count() > 0
        assert cold.count() == g.edges.count()
        g.release(delete_files=True)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")


def test_missing_country_columns_are_an_error(spark):
    t = micro.transactions(spark)
    with pytest.raises(ValueError, match="lacks columns"):
        read_transactions(spark, t.drop("combinedCountryCodes"))


@pytest.mark.parametrize("mode", ["append", "overwrite_partitions"])
def test_new_columns_reach_an_existing_table(spark, mode):
    name = f"nf_merge_{os.urandom(4).hex()}"
    a = spark.createDataFrame([("A", dt.date(2024, 1, 31), 1), ("B", dt.date(2024, 2, 29), 2)], "EXT_ENTITYID string, VINTAGE_DT date, x int")
    b = spark.createDataFrame([("C", dt.date(2024, 2, 29), 9.0)], "EXT_ENTITYID string, VINTAGE_DT date, y double")
    try:
        write_features(a, name, mode=mode)
        write_features(b, name, mode=mode)
        rows = {r.EXT_ENTITYID: (r.x, r.y) for r in spark.table(name).collect()}
        want = {"A": (1, None), "B": (2, None), "C": (None, 9.0)}
        if mode == "overwrite_partitions":
            del want["B"]
        assert rows == want
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_run_cleans_up_after_a_failed_write(spark, scratch_dir, monkeypatch):
    from netfeat.plans import features as PF

    graphs = []
    original = PF.prepare
    monkeypatch.setattr(PF, "prepare", lambda *a, **k: graphs.append(original(*a, **k)) or graphs[-1])

    def fail(*a, **k):
        raise OSError("disk full")

    monkeypatch.setattr(PF, "write_features", fail)
    with pytest.raises(OSError, match="disk full"):
        PF.run(spark, micro.drivers(spark), micro.transactions(spark), os.path.join(scratch_dir, "never"), start="2024-01-01", months=12)
    assert len(graphs) == 1 and graphs[0].facts_path is None and graphs[0].graph._paths == []


def test_no_checkpoint_folder_is_an_error():
    """The library never falls back to a machine-local folder."""
    from netfeat.session import checkpoint_dir

    class Ctx:
        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Ctx()
        conf = Conf()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_catalog_tables_as_sources_and_target(spark):
    """Driver and transactions read by table name; features written to a partitioned
    table; re-running one vintage replaces only that vintage."""
    tag = os.urandom(4).hex()
    drv, trx, out = f"nf_drivers_{tag}", f"nf_trxn_{tag}", f"nf_features_{tag}"
    drivers = micro.drivers(spark).unionByName(
        micro.drivers(spark).withColumn("VINTAGE_DT", F.lit(dt.date(2024, 6, 30)))
    )
    drivers.write.saveAsTable(drv)
    micro.transactions(spark).write.saveAsTable(trx)
    try:
        run(spark, drv, trx, out, start="2024-01-01", months=12)
        first = sorted(map(repr, spark.table(out).collect()))
        assert len(first) == 2 * len(micro.DRIVERS)
        run(spark, drv, trx, out, start="2024-09-01", months=1)  # only 2024-09-30
        again = sorted(map(repr, spark.table(out).collect()))
        assert again == first
    finally:
        for t in (drv, trx, out):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_run_deletes_its_intermediate_tables(spark, scratch_dir, monkeypatch):
    """After each written batch, the facts table and the bucketed edge copies are gone."""
    from netfeat.plans import features as PF

    seen = []
    original = PF._network_features

    def spy(*a, **k):
        out = original(*a, **k)
        seen.extend((sg, sg.facts_path) for sg in a[-1])
        return out

    monkeypatch.setattr(PF, "_network_features", spy)
    target = os.path.join(scratch_dir, "run_clean")
    PF.run(spark, micro.drivers(spark), micro.transactions(spark), target, start="2024-01-01", months=12)
    assert len(seen) == 1
    sg, facts_path = seen[0]
    assert sg.facts_path is None and sg.graph._paths == []
    local = facts_path[len("file:"):] if facts_path.startswith("file:") else facts_path
    assert not os.path.exists(local)
    assert read_features(spark, target).count() == len(micro.DRIVERS)


def test_command_line_job(spark, scratch_dir):
    """``python -m netfeat`` arguments drive run() over Parquet sources."""
    from netfeat.__main__ import main

    drv, trx = os.path.join(scratch_dir, "cli_drv"), os.path.join(scratch_dir, "cli_trx")
    micro.drivers(spark).write.mode("overwrite").parquet(drv)
    micro.transactions(spark).write.mode("overwrite").parquet(trx)
    target = os.path.join(scratch_dir, "cli_out")
    done = main(["--driver", drv, "--trxn", trx, "--target", target, "--start", "2024-01-01",
                 "--months", "12", "--windows", "6,12", "--vintages-per-batch", "1"])
    assert done == [dt.date(2024, 9, 30)]
    out = read_features(spark, target)
    assert out.count() == len(micro.DRIVERS) and "degree_centrality_12m" in out.columns
