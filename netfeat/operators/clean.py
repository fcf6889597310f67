"""Id cleaning: null fill, sentinel filter, account prefix strip."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import ACCOUNT_ID_COLUMNS, ACCOUNT_PREFIX, COUNTERPARTY, ENTITY, NULL_ID_TOKEN
from netfeat.functions import strip_text


def fill_null_ids(df: DataFrame, cols: Iterable[str] = (ENTITY, COUNTERPARTY), token: str = NULL_ID_TOKEN) -> DataFrame:
    """Null ids become ``token`` (later dropped as a sentinel)."""
    return df.na.fill({c: token for c in cols if c in df.columns})


def clean_transactions(df: DataFrame) -> DataFrame:
    """Rows without an entity are dropped, a missing counterparty becomes ``NaN``."""
    return fill_null_ids(df.where(F.col(ENTITY).isNotNull()))


def strip_account_prefix(
    df: DataFrame, cols: Iterable[str] = ACCOUNT_ID_COLUMNS, prefix: str = ACCOUNT_PREFIX
) -> DataFrame:
    """Delete every occurrence of ``prefix`` in those of ``cols`` that exist."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    return df.withColumns({c: strip_text(c, prefix) for c in present})
