"""Readers of the driver and transaction tables.

A source is a DataFrame, a catalog table name, or a Parquet path.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, StructField, StructType

from netfeat.constants import (
    COUNTERPARTY,
    COUNTERPARTY_COUNTRIES,
    ENTITY,
    ENTITY_COUNTRIES,
    POSTING,
    POSTING_MONTH,
    TRXN_REF,
    VINTAGE,
)
from netfeat.operators.clean import clean_transactions

DRIVER_SCHEMA = StructType([StructField(ENTITY, StringType()), StructField(VINTAGE, DateType())])

TRANSACTION_SCHEMA = StructType(
    [
        StructField(ENTITY, StringType()),
        StructField(ENTITY_COUNTRIES, ArrayType(StringType())),
        StructField(COUNTERPARTY, StringType()),
        StructField(COUNTERPARTY_COUNTRIES, ArrayType(StringType())),
        StructField(TRXN_REF, StringType()),
        StructField(VINTAGE, DateType()),
        StructField(POSTING, DateType()),
    ]
)

Source = DataFrame | str

#: Tasks that write one month, about.
FILES_PER_MONTH = 16


def load(spark: SparkSession, source: Source) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if "/" in source or source.endswith(".parquet"):
        return spark.read.parquet(source)
    return spark.table(source)


def conform(df: DataFrame, schema: StructType, required: Iterable[str]) -> DataFrame:
    """Select the schema's columns in order, cast to its types.

    Columns in ``required`` must exist; other missing ones become typed nulls.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_driver(
    spark: SparkSession,
    source: Source,
    vintages: Iterable[dt.date | str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Distinct (EXT_ENTITYID, VINTAGE_DT) keys to score.

    ``vintages`` keeps only those dates (pruned at the scan when the table is
    partitioned by vintage). ``limit`` keeps the first keys in key order.
    """
    df = conform(load(spark, source), DRIVER_SCHEMA, [ENTITY, VINTAGE])
    if vintages is not None:
        df = df.where(F.col(VINTAGE).isin([F.lit(v).cast("date") for v in vintages]))
    df = df.distinct()
    if limit is not None:
        df = df.orderBy(ENTITY, VINTAGE).limit(int(limit))
    return df


def read_transactions(
    spark: SparkSession,
    source: Source,
    date_from: dt.date | str | None = None,
    date_to: dt.date | str | None = None,
    distinct: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Typed transactions: entity not null, null counterparty as ``NaN``.

    ``date_from`` / ``date_to`` bound POSTING_DATE (both included) at the
    scan; in a table partitioned by ``POSTING_MONTH`` (:func:`write_by_month`) they also prune
    partitions, and the column is kept, so that the snapshots prune the months between them
    (``Timeline.assign``). The country columns must exist: without them every risk flag would be 0.
    ``limit`` keeps the first rows in the order of all columns. Duplicate rows do not change any feature (vertices, edges,
    high-risk sets and entity sets are all distinct), so ``distinct`` is off
    by default: it would cost a full shuffle of the transaction table.
    """
    raw = load(spark, source)
    schema = TRANSACTION_SCHEMA
    if POSTING_MONTH in raw.columns:
        schema = StructType([*schema.fields, StructField(POSTING_MONTH, DateType())])
    df = conform(raw, schema, [ENTITY, ENTITY_COUNTRIES, COUNTERPARTY, COUNTERPARTY_COUNTRIES, POSTING])
    if date_from is not None:
        df = df.where(F.col(POSTING) >= F.lit(date_from).cast("date"))
        if POSTING_MONTH in raw.columns:
            df = df.where(F.col(POSTING_MONTH) >= F.trunc(F.lit(date_from).cast("date"), "month"))
    if date_to is not None:
        df = df.where(F.col(POSTING) <= F.lit(date_to).cast("date"))
        if POSTING_MONTH in raw.columns:
            df = df.where(F.col(POSTING_MONTH) <= F.lit(date_to).cast("date"))
    if distinct:
        df = df.distinct()
    if limit is not None:
        # every column, so that no tie is left to chance
        df = df.orderBy(TRXN_REF, ENTITY, COUNTERPARTY, POSTING, VINTAGE, ENTITY_COUNTRIES, COUNTERPARTY_COUNTRIES)
        df = df.limit(int(limit))
    return clean_transactions(df)


def write_by_month(trxn: DataFrame, target: str, mode: str = "error") -> None:
    """Store transactions partitioned by ``POSTING_MONTH``, the first day of the month of POSTING_DATE.

    Rows are dealt by the month and a hash of the row's ids, so a month is a bounded number of files and a
    large month several tasks."""
    month = F.trunc(F.col(POSTING), "month").alias(POSTING_MONTH)
    rows = trxn.select(*[c for c in trxn.columns if c != POSTING_MONTH], month)
    spread = F.pmod(F.xxhash64(ENTITY, COUNTERPARTY, POSTING), F.lit(FILES_PER_MONTH))
    w = rows.repartition(POSTING_MONTH, spread).write.partitionBy(POSTING_MONTH).mode(mode)
    if "/" in target:
        w.parquet(target)
    else:
        w.saveAsTable(target)
