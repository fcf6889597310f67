"""Wire (payment) rows: column selection, party rows, code exclusion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import EXCLUDED_SIC_CODES, TRXN_REF, WIRE_COLUMNS, WIRE_PARTY_COLUMNS


def select_wire(df: DataFrame, cols: Iterable[str] = WIRE_COLUMNS) -> DataFrame:
    """The wire columns that exist in ``df``, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def wire_parties(df: DataFrame, roles: Mapping[str, Mapping[str, tuple[str, str, str]]] = WIRE_PARTY_COLUMNS) -> DataFrame:
    """One row per party slot of a wire: (TRXN_REF_ID, side, party_type,
    acct_id, name, country). Slots whose columns are all null are dropped.

    A narrow ``explode`` of an array of structs: no shuffle.
    """
    slots = []
    for side, by_type in roles.items():
        for type_col, (acct, name, country) in by_type.items():
            col = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
            slots.append(
                F.struct(
                    F.lit(side).alias("side"),
                    F.lit(type_col).alias("party_column"),
                    col(type_col).alias("party_type"),
                    col(acct).alias("acct_id"),
                    col(name).alias("name"),
                    col(country).alias("country"),
                )
            )
    return (
        df.select(TRXN_REF, F.explode(F.array(*slots)).alias("p"))
        .select(TRXN_REF, "p.*")
        .where(F.coalesce("p.party_type", "p.acct_id", "p.name", "p.country").isNotNull())
    )


def exclude_codes(df: DataFrame, col: str, codes: Iterable[str] = EXCLUDED_SIC_CODES) -> DataFrame:
    """Drop rows whose code is excluded; rows with a null code are kept."""
    return df.where(~F.coalesce(F.col(col).isin(*list(codes)), F.lit(False)))
