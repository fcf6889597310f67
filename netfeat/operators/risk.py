"""Country and account risk flags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import (
    COUNTERPARTY_COUNTRIES,
    ENTITY_COUNTRIES,
    HIGH_RISK_COUNTRIES,
    POSTING,
    RISKY_ACCOUNT_PREFIXES,
    SANCTION_EVASION_COUNTRIES,
    VERY_HIGH_RISK_COUNTRIES,
)
from netfeat.functions import country_flag, prefix_flag

LEVELS = ("hrg", "vhrg", "all")
#: Upper bound of the dated list table, which comes to the driver.
MAX_LIST_ROWS = 20_000


def risk_countries(level: str = "hrg") -> tuple[str, ...]:
    """Country list of a risk level.

    ``vhrg``: the very-high-risk list. ``hrg`` (alias ``all``): high-risk and
    very-high-risk lists together, which is what the high-risk flag tests.
    """
    if level == "vhrg":
        return VERY_HIGH_RISK_COUNTRIES
    if level in ("hrg", "all"):
        return HIGH_RISK_COUNTRIES + VERY_HIGH_RISK_COUNTRIES
    raise ValueError(f"unknown risk level {level!r}, expected one of {LEVELS}")


def flag_columns(level: str) -> tuple[str, str]:
    """(entity flag, counterparty flag) column names of a level."""
    name = "vhrg" if level == "vhrg" else "hrg"
    return f"entity_{name}_flag", f"cp_{name}_flag"


def add_risk_flags(
    df: DataFrame,
    entity_countries: str = ENTITY_COUNTRIES,
    cp_countries: str = COUNTERPARTY_COUNTRIES,
    high: Iterable[str] = HIGH_RISK_COUNTRIES,
    very_high: Iterable[str] = VERY_HIGH_RISK_COUNTRIES,
) -> DataFrame:
    """Adds ``entity_hrg_flag``, ``cp_hrg_flag``, ``entity_vhrg_flag``, ``cp_vhrg_flag`` (0/1).

    ``high`` and ``very_high`` are the two country lists; the high-risk flag tests both together."""
    very_high = tuple(very_high)
    both = (*high, *very_high)
    return df.withColumns(
        {
            "entity_hrg_flag": country_flag(entity_countries, both),
            "cp_hrg_flag": country_flag(cp_countries, both),
            "entity_vhrg_flag": country_flag(entity_countries, very_high),
            "cp_vhrg_flag": country_flag(cp_countries, very_high),
        }
    )


def list_periods(lists: DataFrame) -> list[tuple[dt.date | None, tuple[str, ...], tuple[str, ...]]]:
    """(first day, high-risk list, very-high-risk list) of each period in which the lists do not change, ascending.

    ``lists`` (country, level, valid_from, valid_to): both days included; null ends are open; ``level`` is
    ``hrg`` or ``vhrg``. The first period begins at None. Rows without a country, and rows that end before they
    begin, count for nothing. The table comes to the driver; it holds at most ``MAX_LIST_ROWS`` rows (countries times generations)."""
    rows = lists.select("country", "level", F.col("valid_from").cast("date"), F.col("valid_to").cast("date")).distinct()
    rows = [tuple(r) for r in rows.limit(MAX_LIST_ROWS + 1).collect()]
    if len(rows) > MAX_LIST_ROWS:
        raise ValueError(f"more than {MAX_LIST_ROWS} rows of risk lists")
    unknown = {r[1] for r in rows} - {"hrg", "vhrg"}
    if unknown:
        raise ValueError(f"unknown risk levels {sorted(map(str, unknown))}, expected hrg or vhrg")
    rows = [r for r in rows if r[0] is not None]
    day = dt.timedelta(days=1)
    starts = {r[2] for r in rows if r[2]} | {r[3] + day for r in rows if r[3] and r[3] < dt.date.max}
    out = []
    for start in (None, *sorted(starts)):
        def valid(level: str) -> tuple[str, ...]:
            return tuple(sorted({
                country for country, own, lo, hi in rows
                if own == level and (lo is None or (start is not None and lo <= start)) and (hi is None or start is None or start <= hi)
                and (lo is None or hi is None or lo <= hi)
            }))

        period = (valid("hrg"), valid("vhrg"))
        if not out or out[-1][1:] != period:
            out.append((start, *period))
    return out


def add_dated_risk_flags(
    df: DataFrame,
    lists: DataFrame,
    entity_countries: str = ENTITY_COUNTRIES,
    cp_countries: str = COUNTERPARTY_COUNTRIES,
    date_col: str = POSTING,
) -> DataFrame:
    """The four flags of :func:`add_risk_flags`, each row by the lists that are valid on its own date.

    An as-of look-up without a join: the dated rows are cut into periods of constant lists (:func:`list_periods`), whose
    lists are literals of the expression; a row tests the lists of its period, the last one that begins by its
    date. Nothing is shuffled, exploded or broadcast. A row without a date has no flag (0)."""
    periods = list_periods(lists)
    day = F.col(date_col).cast("date")
    out = {}
    for side, column in (("entity", entity_countries), ("cp", cp_countries)):
        for level in ("hrg", "vhrg"):
            flag = F.lit(0)
            for start, high, very_high in periods:  # later periods overrule
                codes = (*high, *very_high) if level == "hrg" else very_high
                own = country_flag(column, codes) if codes else F.lit(0)
                flag = own if start is None else F.when(day >= F.lit(start), own).otherwise(flag)
            out[f"{side}_{level}_flag"] = F.when(day.isNull(), F.lit(0)).otherwise(flag)
    return df.withColumns(out)


def add_country_flag(
    df: DataFrame,
    col: str,
    codes: Iterable[str] = tuple(SANCTION_EVASION_COUNTRIES.values()),
    name: str = "sanction_evasion_flag",
) -> DataFrame:
    """0/1 flag: the country array ``col`` meets ``codes`` (default: sanction-evasion list)."""
    return df.withColumn(name, country_flag(col, codes))


def add_prefix_flag(
    df: DataFrame, col: str, prefixes: Iterable[str] = RISKY_ACCOUNT_PREFIXES, name: str = "risky_prefix_flag"
) -> DataFrame:
    """0/1 flag: the account id ``col`` starts with a risky prefix."""
    return df.withColumn(name, prefix_flag(col, prefixes))
