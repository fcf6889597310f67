"""The ordered snapshots of a run, and facts that hold in some of them.

All (vintage, window) snapshots get consecutive numbers, window by window and in the order of
their vintages. The snapshots that contain a given day are, within a window, consecutive; over all
windows they are a set of numbers, kept as the bits of a long (``mask``) for each chunk of
``CHUNK`` numbers. So a payment is one row with a mask instead of one row a snapshot, and the
snapshots in which an edge or an id occurs are the union (bit-or) of its payments' masks: a
primitive aggregation that combines before the shuffle.

A mask has runs of ones. A count per vertex and snapshot (degree, risky neighbours) needs no row
per snapshot either: a run adds 1 where it begins and takes 1 away after its end; the changes of a
vertex are summed by their place, and one running sum gives the count of every snapshot.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netfeat.constants import POSTING, POSTING_MONTH, VINTAGE, WINDOW

#: Snapshots of one mask; the highest bits of a long stay free for the place after the last.
CHUNK = 62
SNAP = "snap"
CHUNK_COL, MASK = "_chunk", "_mask"
#: Upper bounds of what comes to the driver and is broadcast: snapshots, and (day, chunk) rows.
MAX_SNAPSHOTS = 20_000
MAX_DAYS = 1_000_000


def run_changes(spans: DataFrame, columns: list[str], snapshots: int | None = None) -> DataFrame:
    """(columns, at, delta): the places of ``spans`` (columns, _mask) at which runs of ones begin (1) or have ended (-1).

    A mask meets every place up to the one after the last of ``snapshots`` (of a chunk, if unknown or more) and those without a change are dropped, all in generated code: the same with functions
    of arrays is interpreted, and took 20 to 40 us a mask."""
    before, last = F.shiftleft(MASK, 1), CHUNK if snapshots is None else min(CHUNK, snapshots)
    begins = F.col(MASK).bitwiseAND(F.bitwise_not(before))
    places = spans.select(*columns, MASK, begins.alias("_begins"), F.col(MASK).bitwiseXOR(before).alias("_changes")).select(
        *columns, "_begins", "_changes", F.explode(F.array(*map(F.lit, range(last + 1)))).alias("at")
    )
    return places.where(F.getbit("_changes", F.col("at")) == 1).select(
        *columns, "at", (2 * F.getbit("_begins", F.col("at")) - 1).alias("delta")
    )


def counts_by_snapshot(spans: DataFrame, id_col: str, name: str, snapshots: int | None = None) -> DataFrame:
    """``spans`` (_chunk, id, _mask), a row for each thing counted -> (snap, id, name) where the count is not 0.

    Difference arrays: the changes of an id are summed by place (partial sums before the shuffle) and added up
    along the snapshots; each stretch of equal counts then gives its snapshots."""
    changes = (
        run_changes(spans, [id_col, CHUNK_COL], snapshots)
        .groupBy(id_col, (F.col(CHUNK_COL) * CHUNK + F.col("at")).alias("_at"))
        .agg(F.sum("delta").alias("_delta"))
    )
    along = Window.partitionBy(id_col).orderBy("_at")
    stretches = changes.select(
        id_col, "_at", F.sum("_delta").over(along).alias(name), F.lead("_at").over(along).alias("_next")
    ).where(F.col(name) > 0)  # the sum is 0 after the last change
    snaps = F.explode(F.sequence(F.col("_at"), F.col("_next") - 1)).alias(SNAP)
    return stretches.select(F.col(id_col).alias("id"), name, snaps).select(SNAP, "id", name)


@dataclass(frozen=True)
class Timeline:
    """Snapshots as (vintage, window, lo, hi), in the order of their numbers; on the driver, since their number
    is bounded by the days and windows of a run."""

    rows: tuple[tuple[dt.date, int, dt.date, dt.date], ...]

    @classmethod
    def of(cls, snapshots: DataFrame) -> Timeline:
        """From a snapshot table (VINTAGE_DT, window_m, lo, hi)."""
        rows = [tuple(r) for r in snapshots.select(VINTAGE, WINDOW, "lo", "hi").distinct().limit(MAX_SNAPSHOTS + 1).collect()]
        if len(rows) > MAX_SNAPSHOTS:
            raise ValueError(f"more than {MAX_SNAPSHOTS} snapshots; process fewer vintages per batch")
        return cls(tuple(sorted(rows, key=lambda r: (r[1], r[0]))))

    def __len__(self) -> int:
        return len(self.rows)

    def bounds(self) -> tuple[dt.date, dt.date]:
        """Payments after the first and up to the second date lie in some snapshot."""
        return min(r[2] for r in self.rows), max(r[3] for r in self.rows)

    def table(self, spark: SparkSession) -> DataFrame:
        """(snap, VINTAGE_DT, window_m, _chunk, _bit)."""
        number = np.arange(len(self.rows), dtype=np.int32)
        columns = {
            SNAP: pa.array(number), VINTAGE: pa.array([r[0] for r in self.rows], pa.date32()),
            WINDOW: pa.array([r[1] for r in self.rows], pa.int32()),
            CHUNK_COL: pa.array(number // CHUNK), "_bit": pa.array(number % CHUNK),
        }
        return spark.createDataFrame(pa.table(columns))

    def days(self, spark: SparkSession) -> DataFrame:
        """(_day, _chunk, _mask): the snapshots that contain each day, days of none left out."""
        lo, hi = (np.datetime64(d, "D") for d in self.bounds())
        day = np.arange(lo + 1, hi + 1)
        chunks = -(-len(self.rows) // CHUNK)
        if len(day) * chunks > MAX_DAYS:
            raise ValueError(f"{len(day)} days in {chunks} chunks of snapshots exceed {MAX_DAYS}; process fewer vintages per batch")
        masks = np.zeros((chunks, len(day)), np.int64)
        for k, (_, _, first, last) in enumerate(self.rows):
            a, b = np.searchsorted(day, (np.datetime64(first, "D"), np.datetime64(last, "D")), side="right")
            masks[k // CHUNK, a:b] |= np.int64(1) << np.int64(k % CHUNK)
        chunk, place = np.nonzero(masks)
        columns = {"_day": pa.array(day[place], pa.date32()), CHUNK_COL: pa.array(chunk.astype(np.int32)), MASK: pa.array(masks[chunk, place])}
        return spark.createDataFrame(pa.table(columns))

    def months(self) -> list[dt.date]:
        """First days of the calendar months that some snapshot touches, ascending."""
        found: set[np.datetime64] = set()
        for _, _, lo, hi in self.rows:
            first, last = np.datetime64(lo, "D") + 1, np.datetime64(hi, "D")
            found.update(np.arange(first.astype("M8[M]"), last.astype("M8[M]") + 1))
        return [m.astype("M8[D]").astype(object) for m in sorted(found)]

    def assign(self, trxn: DataFrame) -> DataFrame:
        """Every transaction of some snapshot once (once a chunk of snapshots), with its mask.

        An equi-join of POSTING_DATE with the days of the run, which are broadcast (bounded by ``MAX_DAYS``); the
        overall bounds are literals, so they reach the file scan; of a table partitioned by ``POSTING_MONTH`` only the months
        that some snapshot touches are read, also when they lie far apart. The transaction's own VINTAGE_DT (if any) is
        not used for slicing."""
        spark, p = trxn.sparkSession, F.col(POSTING)
        t = trxn.drop(VINTAGE, WINDOW)
        if not self.rows:
            return t.where(F.lit(False)).withColumns({CHUNK_COL: F.lit(0), MASK: F.lit(0).cast("long")})
        lo, hi = self.bounds()
        t = t.where((p > F.lit(lo)) & (p <= F.lit(hi)))
        if POSTING_MONTH in t.columns:
            t = t.where(F.col(POSTING_MONTH).isin(self.months()))
        return t.join(F.broadcast(self.days(spark)), p == F.col("_day")).drop("_day")

    def expand(self, spans: DataFrame) -> DataFrame:
        """``spans`` with _chunk and _mask -> a row for each snapshot in the mask, with ``snap``."""
        spark = spans.sparkSession
        if not self.rows:
            return spans.where(F.lit(False)).withColumn(SNAP, F.lit(0)).drop(CHUNK_COL, MASK)
        numbers = self.table(spark).select(SNAP, CHUNK_COL, "_bit")
        joined = spans.join(F.broadcast(numbers), CHUNK_COL).where(F.getbit(F.col(MASK), F.col("_bit")) == 1)
        return joined.drop(CHUNK_COL, MASK, "_bit")

    def named(self, df: DataFrame) -> DataFrame:
        """``df`` with (VINTAGE_DT, window_m) in place of ``snap``."""
        spark = df.sparkSession
        if not self.rows:
            return df.select(F.lit(None).cast("date").alias(VINTAGE), F.lit(None).cast("int").alias(WINDOW), *[c for c in df.columns if c != SNAP]).where(F.lit(False))
        names = self.table(spark).select(SNAP, VINTAGE, WINDOW)
        return df.join(F.broadcast(names), SNAP).select(VINTAGE, WINDOW, *[c for c in df.columns if c != SNAP])
