"""Connected components of an edge table by alternating large-star and small-star
(Kiveris et al., 2014), for 64-bit ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace

#: A key with more rows than this, and more than a 64th of all, is a hub; there are 64 at most.
HUB_ROWS = 1000
_HUBS = 64
_SALTS = 64


def hubs(counts: DataFrame, key: str, n: str, total: int | None = None) -> list[int]:
    """Keys with more than ``HUB_ROWS`` and more than a 64th of all ``total`` rows; ``counts`` has a row a key."""
    total = (counts.agg(F.sum(n)).first()[0] or 0) if total is None else total
    bound = max(HUB_ROWS, total // _HUBS)
    return [r[0] for r in counts.where(F.col(n) > bound).select(key).collect()] if total > bound else []


def hub_join(rows: DataFrame, key: str, table: DataFrame, found: list[int]) -> DataFrame:
    """``rows`` joined with ``table`` on ``key``. The rows of a hub are spread over ``_SALTS`` values
    by their other columns and its rows in ``table`` are copied to each."""
    if not found:
        return rows.join(table, key)
    hub = F.col(key).isin(found)
    others = [F.col(c) for c in rows.columns if c != key]
    rows = rows.withColumn("salt", F.when(hub, F.pmod(F.xxhash64(*others), F.lit(_SALTS))).otherwise(0).cast("int"))
    copies = F.when(hub, F.sequence(F.lit(0), F.lit(_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.join(table.withColumn("salt", F.explode(copies)), [key, "salt"]).drop("salt")


def components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """``edges`` (a, b) -> (id, component): the smallest id that each id reaches.

    Ids without an edge to another id are left out. Edges with a null end and loops are
    ignored. Each round is written to the shared folder; the loop ends, exactly, when
    neither star moved an edge. A star turns every edge into one edge, so the table never grows. All aggregations
    combine before the shuffle, so a hub is one row a task there; in the joins its rows are salted. The hubs that come to
    the driver are ``_HUBS`` ids at most, whatever the table's size."""
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    e = work.store(e.distinct(), f"{name}-0")
    step, n = 0, e.count()
    while n:
        sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        found = hubs(sym.groupBy("u").agg(F.count(F.lit(1)).alias("n")), "u", "n", 2 * n)
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = hub_join(sym, "u", low, found).where("v > u").select(
            F.col("v").alias("a"), F.col("m").alias("b"), (F.col("m") != F.col("u")).alias("moved")
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = hub_join(large, "a", least, found).select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"),
            (F.col("moved") | (F.col("b") != F.col("m"))).alias("moved"),
        )
        step += 1
        after = work.store(small, f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
        e = after.select("a", "b")
        if after.where("moved").isEmpty():
            break
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component"))
    ).distinct()
