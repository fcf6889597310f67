"""Resumed runs, dated risk lists, schema changes, tables stored by month."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import micro
from netfeat.constants import HIGH_RISK_COUNTRIES, POSTING_MONTH, VERY_HIGH_RISK_COUNTRIES
from netfeat.operators.risk import add_dated_risk_flags, add_risk_flags, list_periods
from netfeat.plans.features import Ledger, input_version, run
from netfeat.sources.schema import IncompatibleSchema, common_type, merged
from netfeat.sources.sinks import read_features, write_features
from netfeat.sources.tables import read_transactions, write_by_month
from test_plans import conf, plan

FLAGS = ["entity_hrg_flag", "cp_hrg_flag", "entity_vhrg_flag", "cp_vhrg_flag"]

# --- resumed runs


def drivers(spark, n=3):
    return spark.createDataFrame([(d, dt.date(2024, 7 + k, 28)) for d in micro.DRIVERS for k in range(n)], "EXT_ENTITYID string, VINTAGE_DT date")


class Stop(Exception):
    pass


@pytest.mark.parametrize("table", [False, True])
def test_a_run_goes_on_where_it_stopped(spark, scratch_dir, table):
    tag = os.urandom(4).hex()
    target = f"nf_resumed_{tag}" if table else os.path.join(scratch_dir, f"resumed-{tag}")
    trxn = os.path.join(scratch_dir, f"trxn-{tag}")
    micro.transactions(spark).write.parquet(trxn)
    drv = os.path.join(scratch_dir, f"drv-{tag}")
    drivers(spark).write.parquet(drv)
    args = dict(start="2024-07-01", months=5, windows=(6,), vintages_per_batch=1, resume=True)
    seen = []

    def stop(batch):
        seen.append(batch)
        if len(seen) == 2:
            raise Stop

    try:
        with pytest.raises(Stop):
            run(spark, drv, trxn, target, before_batch=stop, **args)
        assert {r.VINTAGE_DT for r in read_features(spark, target).collect()} == {dt.date(2024, 7, 28)}
        assert run(spark, drv, trxn, target, before_batch=seen.append, **args) == [dt.date(2024, 8, 28), dt.date(2024, 9, 28)]
        assert seen == [[dt.date(2024, 7, 28)], [dt.date(2024, 8, 28)], [dt.date(2024, 8, 28)], [dt.date(2024, 9, 28)]]
        assert run(spark, drv, trxn, target, **args) == []
        if not table:
            whole = os.path.join(scratch_dir, f"whole-{tag}")
            run(spark, drv, trxn, whole, start="2024-07-01", months=5, windows=(6,))
            a, b = (read_features(spark, t) for t in (target, whole))
            # sums depend on their order in the last places
            a, b = (df.withColumns({c: F.round(c, 9) for c in df.columns if c.startswith("pagerank")}) for df in (a, b))
            assert sorted(map(repr, a.select(*b.columns).collect())) == sorted(map(repr, b.collect()))
    finally:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {target}")
            spark.sql(f"DROP TABLE IF EXISTS {target}_ledger")


def test_a_failed_write_is_not_in_the_ledger(spark, scratch_dir, monkeypatch):
    from netfeat.plans import features as PF

    target, calls = os.path.join(scratch_dir, "ledger-fail"), []
    original = PF.write_features

    def fail_once(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("disk full")
        return original(*a, **k)

    monkeypatch.setattr(PF, "write_features", fail_once)
    args = dict(start="2024-07-01", months=5, windows=(6,), vintages_per_batch=1, resume=True, version="v")
    with pytest.raises(OSError):
        run(spark, drivers(spark, 2), micro.transactions(spark), target, **args)
    assert run(spark, drivers(spark, 2), micro.transactions(spark), target, **args) == [dt.date(2024, 8, 28)]


@pytest.mark.parametrize("table", [False, True])
def test_other_windows_levels_or_inputs_are_other_work(spark, scratch_dir, table):
    name = f"nf_ledger_{os.urandom(4).hex()}"
    target = name if table else os.path.join(scratch_dir, name)
    day, key = dt.date(2024, 7, 28), ([6, 12], "vhrg", "v1")
    try:
        assert Ledger(spark, target, *key).finished() == set()
        Ledger(spark, target, *key).add([day])
        Ledger(spark, target, [6], "hrg", "v1").add([day + dt.timedelta(days=1)])
        assert Ledger(spark, target, *key).finished() == {day}
        for other in (([6], "vhrg", "v1"), ([12, 6], "vhrg", "v1"), ([6, 12], "hrg", "v1"), ([6, 12], "vhrg", "v2")):
            assert Ledger(spark, target, *other).finished() == set()
    finally:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {target}_ledger")


def test_resume_needs_an_idempotent_mode(spark, scratch_dir):
    with pytest.raises(ValueError, match="overwrite_partitions"):
        run(spark, drivers(spark), micro.transactions(spark), os.path.join(scratch_dir, "x"), start="2024-07-01", mode="append", resume=True)


def test_input_version_names_the_files(spark, scratch_dir):
    path = os.path.join(scratch_dir, "version")
    spark.range(3).write.parquet(path)
    before = input_version(spark.read.parquet(path))
    assert before == input_version(spark.read.parquet(path)) != input_version(spark.read.parquet(path), spark.read.parquet(path))
    spark.range(3).write.mode("append").parquet(path)
    assert before != input_version(spark.read.parquet(path))


# --- dated risk lists

LISTS = "country string, level string, valid_from date, valid_to date"


def test_dated_lists_against_brute_force(spark):
    rng = random.Random(6)
    day = lambda: dt.date(2022, 1, 1) + dt.timedelta(days=rng.randrange(60))
    names = ["AFG", "IRN", "USA", "ALB", "DPRK"]
    lists = [(rng.choice([*names, None]), rng.choice(["hrg", "vhrg"]), rng.choice([None, day()]), rng.choice([None, day()])) for _ in range(14)]
    rows = [
        (f"T{k}", rng.choice([None, [], [rng.choice(names)], rng.sample(names, 2), [None]]), rng.choice([None, [rng.choice(names)]]),
         rng.choice([None, day(), dt.date(1990, 1, 1), dt.date(2090, 1, 1)]))
        for k in range(400)
    ]
    df = spark.createDataFrame(rows, "ref string, combinedCountryCodes array<string>, COUNTER_PARTY_COMBINEDCOUNTRYCODES array<string>, POSTING_DATE date")

    def flag(codes, when, levels):
        return int(when is not None and any(
            c is not None and c in (codes or []) and lev in levels and (lo is None or lo <= when) and (hi is None or when <= hi)
            for c, lev, lo, hi in lists
        ))

    want = {r[0]: tuple(flag(c, r[3], lv) for lv in (("hrg", "vhrg"), ("vhrg",)) for c in r[1:3]) for r in rows}
    out = add_dated_risk_flags(df, spark.createDataFrame(lists, LISTS))
    assert {r.ref: tuple(r[f] for f in FLAGS) for r in out.collect()} == want
    p = plan(out)
    assert "Join" not in p and "Exchange" not in p


def test_open_lists_are_the_fixed_ones(spark):
    lists = [(c, "hrg", None, None) for c in HIGH_RISK_COUNTRIES] + [(c, "vhrg", None, None) for c in VERY_HIGH_RISK_COUNTRIES]
    lists = spark.createDataFrame(lists, LISTS)
    t = micro.transactions(spark)
    a, b = (f.select("TRXN_REF_ID", *FLAGS) for f in (add_dated_risk_flags(t, lists), add_risk_flags(t)))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert [p[0] for p in list_periods(lists)] == [None]


def test_own_lists_and_bad_lists(spark):
    out = {r.TRXN_REF_ID: tuple(r[f] for f in FLAGS) for r in add_risk_flags(micro.transactions(spark), high=["USA"], very_high=["ALB"]).collect()}
    assert out["T1"] == (1, 0, 0, 0) and out["T8"] == (1, 0, 1, 0)
    empty = spark.createDataFrame([], LISTS)
    assert all(tuple(r[f] for f in FLAGS) == (0, 0, 0, 0) for r in add_dated_risk_flags(micro.transactions(spark), empty).collect())
    with pytest.raises(ValueError, match="unknown risk levels"):
        list_periods(spark.createDataFrame([("USA", "low", None, None)], LISTS))


def test_run_with_dated_lists(spark, scratch_dir):
    """B pays and is paid before its country is listed only: no risky neighbour is counted."""
    lists = spark.createDataFrame([("AFG", "vhrg", dt.date(2024, 6, 2), None), ("IRN", "vhrg", None, dt.date(2024, 1, 1))], LISTS)
    target = os.path.join(scratch_dir, "dated")
    run(spark, micro.drivers(spark), micro.transactions(spark), target, start="2024-01-01", months=12, risk_lists=lists)
    got = {r.EXT_ENTITYID: r.vhrg_neighbor_ct_6m for r in read_features(spark, target).collect()}
    # T3 (B to A on 2024-06-02) makes B risky; A has an edge to and one from B; C's country is no longer listed
    assert got["A"] == 2 and got["C"] == 0


# --- schema changes


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"), ("int", "double", "double"),
        ("int", "float", "double"), ("smallint", "float", "float"), ("bigint", "double", None), ("string", "date", None), ("int", "string", None),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(8,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", None),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", None), ("void", "string", "string"), ("boolean", "int", None),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("struct<x:int>", "struct<x:bigint,y:date>", "struct<x:bigint,y:date>"), ("struct<x:int>", "struct<x:string>", None),
    ],
)
def test_common_types(spark, a, b, want):
    kind = lambda t: T.StructType.fromDDL(f"c {t}").fields[0].dataType
    for x, y in ((a, b), (b, a)):
        found = common_type(kind(x), kind(y))
        assert (found and sorted(found.simpleString().split(","))) == (want and sorted(want.split(",")))
    assert merged(T.StructType.fromDDL(f"c {a}, d int"), T.StructType.fromDDL("e int, D bigint")).simpleString() == f"struct<c:{a},d:bigint,e:int>"


def frame(spark, month, kind, value):
    return spark.createDataFrame([("A", dt.date(2024, month, 28), 1)], "EXT_ENTITYID string, VINTAGE_DT date, x int").withColumn("x", F.lit(value).cast(kind))


@pytest.mark.parametrize("mode", ["append", "overwrite_partitions"])
@pytest.mark.parametrize("first, second, kind", [("int", "bigint", "bigint"), ("bigint", "int", "bigint"), ("int", "double", "double"), ("float", "double", "double")])
def test_a_path_target_widens(spark, scratch_dir, mode, first, second, kind):
    target = os.path.join(scratch_dir, f"widen-{os.urandom(4).hex()}")
    write_features(frame(spark, 1, first, 7), target, mode=mode)
    write_features(frame(spark, 2, second, 8), target, mode=mode)
    out = read_features(spark, target)
    assert out.schema["x"].dataType.simpleString() == kind
    assert sorted(r.x for r in out.collect()) == [7, 8]
    if kind == "bigint":
        write_features(frame(spark, 3, "bigint", 2**40), target, mode=mode)
        assert sorted(r.x for r in read_features(spark, target).collect()) == [7, 8, 2**40]


@pytest.mark.parametrize("table", [False, True])
def test_types_without_a_common_one_are_refused_before_the_write(spark, scratch_dir, table):
    tag = os.urandom(4).hex()
    target = f"nf_types_{tag}" if table else os.path.join(scratch_dir, f"types-{tag}")
    try:
        write_features(frame(spark, 1, "string", "2024-01-01"), target)
        with pytest.raises(IncompatibleSchema, match="column x"):
            write_features(frame(spark, 1, "date", "2024-01-01"), target)
        assert [r.x for r in read_features(spark, target).collect()] == ["2024-01-01"]
    finally:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {target}")


def test_a_table_takes_narrower_columns_and_refuses_wider_ones(spark):
    name = f"nf_widen_{os.urandom(4).hex()}"
    try:
        write_features(frame(spark, 1, "bigint", 7), name)
        write_features(frame(spark, 2, "int", 8), name)
        assert sorted(r.x for r in spark.table(name).collect()) == [7, 8]
        with pytest.raises(IncompatibleSchema, match="double"):
            write_features(frame(spark, 2, "int", 8).withColumn("x", F.lit(1.5)), name)
        assert sorted(r.x for r in spark.table(name).collect()) == [7, 8]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_target_of_other_hands_is_checked_too(spark, scratch_dir):
    target = os.path.join(scratch_dir, "foreign")
    frame(spark, 1, "int", 7).write.partitionBy("VINTAGE_DT").parquet(target)
    write_features(frame(spark, 2, "bigint", 8), target)
    assert sorted(r.x for r in read_features(spark, target).collect()) == [7, 8]
    with pytest.raises(IncompatibleSchema):
        write_features(frame(spark, 2, "string", "y"), target)


# --- tables stored by month


def test_only_the_months_of_the_snapshots_are_read(spark, scratch_dir):
    from netfeat.operators.snapshots import snapshot_table
    from netfeat.operators.timeline import Timeline

    rng = random.Random(3)
    rows = [
        (f"e{rng.randrange(9)}", ["AFG"], f"e{rng.randrange(9)}", None, f"T{k}", None, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(1400)))
        for k in range(600)
    ]
    trxn = spark.createDataFrame(rows, micro.SCHEMA)
    source = os.path.join(scratch_dir, "by-month")
    write_by_month(trxn, source)
    vintages = [dt.date(2020, 12, 31), dt.date(2023, 3, 31)]
    line = Timeline.of(snapshot_table(spark.createDataFrame([(v,) for v in vintages], "VINTAGE_DT date"), (1, 2)))
    t = read_transactions(spark, source, date_from=dt.date(2020, 10, 31), date_to=vintages[1])
    assert POSTING_MONTH in t.columns
    assigned = line.assign(t)
    with conf(spark, **{"spark.sql.maxMetadataStringLength": "10000"}):
        scan = next(x for x in plan(assigned).splitlines() if "FileScan parquet" in x)
    filters = scan.split("PartitionFilters: [")[1]
    # the months themselves are in the filter of the scan, those between the vintages are not
    months = ["2020-11-01", "2020-12-01", "2023-02-01", "2023-03-01"]
    assert f"{POSTING_MONTH}#" in filters and ",".join(months) in filters.replace(", ", ","), filters
    plain = line.assign(read_transactions(spark, trxn))
    assert sorted(map(repr, assigned.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
