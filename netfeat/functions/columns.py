"""Scalar column expressions used by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from netfeat.constants import SENTINEL_IDS

#: Entries of a country array that are looked up one by one.
FEW_COUNTRIES = 4


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_id(c: Column | str, sentinels: Iterable[str] = SENTINEL_IDS) -> Column:
    """True when the id is a real entity: not null and not a sentinel."""
    c = _col(c)
    return c.isNotNull() & ~c.isin(*sentinels)


def country_flag(c: Column | str, codes: Iterable[str]) -> Column:
    """1 if the country array shares an entry with ``codes``, else 0.

    A null array, an empty array and an array of nulls all give 0. The entries of an array of up to ``FEW_COUNTRIES`` are looked up in the
    set of codes; ``arrays_overlap`` goes through all codes for every row.
    """
    c, codes = _col(c), list(codes)
    few = F.lit(False)
    for i in range(FEW_COUNTRIES):
        few = few | F.coalesce(F.get(c, F.lit(i)).isin(*codes), F.lit(False))
    many = F.coalesce(F.arrays_overlap(c, F.array(*[F.lit(x) for x in codes])), F.lit(False))
    return F.when(F.size(c) > FEW_COUNTRIES, many).otherwise(few).cast("int")


def prefix_flag(c: Column | str, prefixes: Iterable[str]) -> Column:
    """1 if the text starts with one of ``prefixes``, else 0 (null gives 0)."""
    c = _col(c)
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.coalesce(c.startswith(p), F.lit(False))
    return hit.cast("int")


def lookback_date(c: Column | str, months: int | Column) -> Column:
    """``c`` minus ``months`` calendar months, clipped to the month end."""
    m = months if isinstance(months, Column) else F.lit(int(months))
    return F.add_months(_col(c), -m)


def month_index(c: Column | str) -> Column:
    """Months since year 0: an equi-join key for date ranges."""
    c = _col(c)
    return F.year(c) * 12 + F.month(c) - 1


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, or 0.0 when den is not positive (also safe under ANSI mode)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def strip_text(c: Column | str, text: str) -> Column:
    """Remove every occurrence of ``text`` (a literal, not a pattern)."""
    return F.replace(_col(c), F.lit(text), F.lit(""))
