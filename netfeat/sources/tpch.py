"""Transaction, driver and wire tables derived from the TPC-H-style test tables.

Customers are entities and parts are counterparties in one id space, so the
graphs have reciprocal pairs, self-loops, sentinel ids and null partners.
Every table here is a Spark plan over the given Parquet files, so its size
grows with the scale factor.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netfeat.constants import (
    COUNTERPARTY,
    COUNTERPARTY_COUNTRIES,
    ENTITY,
    ENTITY_COUNTRIES,
    POSTING,
    TRXN_REF,
    VINTAGE,
)

# Fixed values of the test fixture: nation key -> ISO3 country, in key order.
NATION_ISO3 = (
    "AFG", "ALB", "ARG", "AUS", "BGD", "BRA", "CAN", "CHN", "CUB", "DEU", "EGY", "FRA", "GBR",
    "IND", "IRN", "ITA", "JPN", "KEN", "MEX", "NGA", "RUS", "TUR", "USA", "VNM", "KAZ",
)
TEST_VINTAGES = (dt.date(1997, 12, 31), dt.date(1998, 6, 30))
TEST_WINDOWS = (1, 6, 12)
EXTRA_DRIVER_PREFIX = "X"  # drivers 'X' || r_regionkey: ids without any transaction


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(key: F.Column) -> F.Column:
    """ISO3 of a key in 0..24 (null outside)."""
    codes = F.array(*[F.lit(c) for c in NATION_ISO3])
    return F.when(key.between(0, len(NATION_ISO3) - 1), F.element_at(codes, (key + 1).cast("int")))


def tpch_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions (before cleaning): order lines as payments customer -> part."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ok, lk, ln = F.col("o_orderkey"), F.col("l_orderkey"), F.col("l_linenumber")
    ext = (
        F.when(ok % 53 == 0, F.lit("9999"))
        .when(ok % 59 == 0, F.lit(""))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    cp = F.when((lk % 11 == 0) & (ln == 7), F.lit(None).cast("string")).otherwise(F.col("l_partkey").cast("string"))
    ext_c = _iso(F.col("c_nationkey"))
    cp_c = F.when(ln == 6, F.lit(None).cast("string")).otherwise(_iso(F.col("l_partkey") % 25))
    as_array = lambda x: F.when(x.isNotNull(), F.array(x))
    # the customers meet the orders, of which there are fewer than lines
    placed = o.join(c, F.col("c_custkey") == F.col("o_custkey")).where(F.col("c_nationkey").between(0, len(NATION_ISO3) - 1))
    return (
        placed.join(li, ok == lk)
        .select(
            ext.alias(ENTITY),
            as_array(ext_c).alias(ENTITY_COUNTRIES),
            cp.alias(COUNTERPARTY),
            as_array(cp_c).alias(COUNTERPARTY_COUNTRIES),
            F.concat(lk.cast("string"), F.lit("-"), ln.cast("string")).alias(TRXN_REF),
            F.lit(None).cast("date").alias(VINTAGE),
            F.col("o_orderdate").cast("date").alias(POSTING),
        )
    )


def tpch_drivers(
    spark: SparkSession,
    sf_dir: str,
    vintages: Iterable[dt.date] = TEST_VINTAGES,
) -> DataFrame:
    """Every customer, plus one id per region that never transacts, at each vintage."""
    cust = table(spark, sf_dir, "customer")
    ids = cust.select(F.col("c_custkey").cast("string").alias(ENTITY))
    extra = table(spark, sf_dir, "region").select(
        F.concat(F.lit(EXTRA_DRIVER_PREFIX), F.col("r_regionkey").cast("string")).alias(ENTITY)
    )
    return ids.unionByName(extra).select(ENTITY, F.explode(F.array(*[F.lit(v) for v in vintages])).alias(VINTAGE))


def tpch_wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire rows: one per order line, originator = customer, beneficiary = part,
    the supplier as sending institution. Account ids carry the ``ACCT-`` text
    (also in the middle of a value) and some risky prefixes."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    ln = F.col("l_linenumber")
    prefix = F.element_at(F.array(F.lit("NRA"), F.lit("OSA"), F.lit("FIN"), F.lit("CHK")), (ln % 4 + 1).cast("int"))
    cust = F.col("o_custkey").cast("string")
    part = F.col("l_partkey").cast("string")
    supp = F.col("l_suppkey").cast("string")
    return (
        o.join(li, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(c, F.col("c_custkey") == F.col("o_custkey"))
        .join(s, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string")).alias(TRXN_REF),
            F.concat(F.lit("ACCT-"), prefix, part).alias("BENEF_ACCT_ID"),
            _iso(F.col("l_partkey") % 25).alias("BENEF_COUNTRY"),
            F.concat(F.lit("PART-"), part).alias("BENEF_NAME"),
            F.when(ln % 3 == 0, F.lit("ORG")).otherwise(F.lit("IND")).alias("BENEF_TYPE"),
            F.concat(prefix, F.lit("ACCT-"), cust).alias("ORIG_REMITTER_ACCT_ID"),
            F.col("l_extendedprice").alias("ORIG_REMITTER_AMT_ACTIVITY"),
            _iso(F.col("c_nationkey")).alias("ORIG_REMITTER_COUNTRY"),
            F.col("c_name").alias("ORIG_REMITTER_NAME"),
            F.when(ln % 2 == 0, F.lit("ACCT")).alias("ORIG_REMITTER_ID_TYPE"),
            F.col("o_orderdate").cast("date").alias(POSTING),
            F.concat(F.lit("ACCT-"), supp, F.lit("-ACCT-")).alias("SENDING_INSTN_ACCT_ID"),
            _iso(F.col("s_nationkey")).alias("SENDING_INSTN_COUNTRY"),
            F.col("s_name").alias("SENDING_INSTN_NAME"),
            F.concat(F.lit("ACCT-ACCT-"), supp).alias("RCV_INSTN_ACCT_ID"),
            F.when(ln % 4 == 1, F.concat(F.lit("ACCT-"), cust, F.lit("-"), supp)).alias("TP_ORIGIN_ACCT_ID"),
            F.when(ln % 4 == 1, F.col("s_name")).alias("TP_ORIGIN_NAME"),
            F.when(ln % 4 == 1, _iso(F.col("s_nationkey"))).alias("TP_ORIGIN_COUNTRY"),
            F.when(ln % 4 == 1, F.lit("ORG")).alias("TP_ORIGIN_TYPE"),
            F.when(ln % 5 == 2, F.concat(F.lit("ACCT-"), part, F.lit("-"), supp)).alias("TP_BENEF_ACCT_ID"),
            F.when(ln % 5 == 2, F.concat(F.lit("TP-"), part)).alias("TP_BENEF_NAME"),
            F.when(ln % 5 == 2, _iso(F.col("l_suppkey") % 25)).alias("TP_BENEF_COUNTRY"),
            F.when(ln % 5 == 2, F.lit("IND")).alias("TP_BENEF_TYPE"),
            F.col("l_extendedprice").alias("TRXN_AMOUNT"),
            F.lit("USD").alias("TRXN_CURRENCY_CD"),
            F.format_string("%04d", (F.lit(7300) + F.col("o_custkey") % 100).cast("int")).alias("SIC_CODE"),
        )
    )
