"""Vintages, look-back windows and the assignment of transactions to snapshots.

A snapshot is (vintage date v, look-back months w); its transactions are
those with ``add_months(v, -w) < POSTING_DATE <= v``. Instead of looping over
snapshots on the driver, the snapshot table is joined to the transactions
once and every later operator carries ``(VINTAGE_DT, window_m)`` as keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.constants import POSTING, VINTAGE, WINDOW
from netfeat.functions import lookback_date, month_index

# Upper bound of the rows that are broadcast: the months of all snapshots.
MAX_SNAPSHOT_MONTHS = 1_000_000


def vintages(driver: DataFrame, start: dt.date | str, months: int = 24) -> DataFrame:
    """Distinct vintages in ``[start, start + months]``, ascending."""
    lo = F.lit(start).cast("date")
    hi = F.add_months(lo, months)
    return (
        driver.select(VINTAGE)
        .where(F.col(VINTAGE).between(lo, hi))
        .distinct()
        .orderBy(VINTAGE)
    )


def date_range(start: dt.date | str, months: int = 31, lookback: int = 12) -> tuple[dt.date, dt.date, dt.date]:
    """(first transaction date, first vintage, last vintage) of a configured run.

    The last vintage is ``start + months``; transactions start ``lookback``
    months before the first vintage.
    """
    s = dt.date.fromisoformat(start) if isinstance(start, str) else start
    return s - relativedelta(months=lookback), s, s + relativedelta(months=months)


def in_date_range(trxn: DataFrame, start: dt.date | str, months: int = 31, lookback: int = 12) -> DataFrame:
    """Transactions posted in the configured range, both ends included (a scan filter)."""
    lo, _, hi = date_range(start, months, lookback)
    return trxn.where(F.col(POSTING).between(F.lit(lo), F.lit(hi)))


def snapshot_table(vintage_df: DataFrame, windows: Iterable[int]) -> DataFrame:
    """(VINTAGE_DT, window_m, lo, hi) for every distinct vintage and window."""
    ws = F.explode(F.array(*[F.lit(int(w)) for w in windows])).alias(WINDOW)
    return (
        vintage_df.select(VINTAGE)
        .distinct()
        .select(VINTAGE, ws)
        .select(
            VINTAGE,
            WINDOW,
            lookback_date(F.col(VINTAGE), F.col(WINDOW)).alias("lo"),
            F.col(VINTAGE).alias("hi"),
        )
    )


def slice_window(trxn: DataFrame, vintage: dt.date | str, months: int) -> DataFrame:
    """Transactions of one snapshot: ``v - months < POSTING_DATE <= v``."""
    v = F.lit(vintage).cast("date")
    p = F.col(POSTING)
    return trxn.where((p <= v) & (p > lookback_date(v, months)))


def assign_snapshots(trxn: DataFrame, snapshots: DataFrame, max_months: int = MAX_SNAPSHOT_MONTHS) -> DataFrame:
    """Every transaction once per snapshot that contains it, with the snapshot keys.

    A range join made an equi-join: each snapshot is expanded to the calendar
    months it touches (w + 1 rows) and joined on the month of POSTING_DATE,
    then the exact bounds are applied. The expanded snapshot table is
    broadcast; its size is checked first. The overall date bounds are applied
    as literals, so they reach the file scan as pushed filters.
    """
    stats = snapshots.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.sum(month_index("hi") - month_index("lo") + 1).alias("months"),
    ).first()
    if (stats["months"] or 0) > max_months:
        raise ValueError(f"{stats['months']} snapshot months exceed {max_months}; process fewer vintages per batch")
    p = F.col(POSTING)
    if stats["n"] == 0:
        return trxn.drop(VINTAGE, WINDOW).where(F.lit(False)).withColumns({VINTAGE: F.lit(None).cast("date"), WINDOW: F.lit(None).cast("int")})
    months = snapshots.select(
        VINTAGE, WINDOW, "lo", "hi", F.explode(F.sequence(month_index("lo"), month_index("hi"))).alias("_month")
    )
    # a transaction's own VINTAGE_DT (if any) is not used for slicing; the snapshot's replaces it
    t = (
        trxn.drop(VINTAGE, WINDOW)
        .where((p > F.lit(stats["lo"])) & (p <= F.lit(stats["hi"])))
        .withColumn("_month", month_index(p))
    )
    return (
        t.join(F.broadcast(months), "_month")
        .where((p > F.col("lo")) & (p <= F.col("hi")))
        .drop("_month", "lo", "hi")
    )
