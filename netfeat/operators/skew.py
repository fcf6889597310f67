"""Hot-key handling for one-to-many joins.

Graph lookups join a per-key attribute (one row per key) to a large table
keyed the same way: the edges of a vertex, the members of a community, the
vertices of a component. One key may hold a third of all rows (a hub
account, a giant component). A plain shuffle join sends all of them to one
task. Here hot keys are found from counts the operators compute anyway, and
their rows are salted: the large side spreads a hot key over ``n`` salt
values by a hash of another column, the attribute side is copied ``n``
times. Cold keys join as usual with salt 0.

The hot-key table is a small table in the checkpoint folder: every key above
the threshold is in it, however many there are, and none comes to the driver. It carries no
broadcast hint; from its real size Spark picks the join.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netfeat.session import checkpoint_dir

SALT = "_salt"
N_SALT = "_n_salt"


@dataclass(frozen=True)
class SkewConfig:
    """When is a key hot: ``threshold`` rows per key, which is also the number of
    rows each salt bucket receives at most (on average)."""

    threshold: int = 1_000_000


DEFAULT_SKEW = SkewConfig()


def hot_keys(
    counts: DataFrame,
    key_cols: Sequence[str],
    count_col: str,
    skew: SkewConfig = DEFAULT_SKEW,
    bound: int | None = None,
    paths: list[str] | None = None,
) -> DataFrame | None:
    """Keys whose count exceeds the threshold, with their salt count.

    Returns a table ``(*key_cols, _n_salt)`` of all of them, or None when no key is
    hot. ``counts`` has one row per key. ``bound`` is a known upper bound of
    every count (for example the row count of the counted table); when it is
    within the threshold no key can be hot and no job is run. The table's folder is
    added to ``paths``, whose owner deletes it.
    """
    keys = list(key_cols)
    threshold = max(1, int(skew.threshold))
    if bound is not None and bound <= threshold:
        return None
    hot = counts.where(F.col(count_col) > threshold).select(
        *keys, F.ceil(F.col(count_col) / threshold).cast("int").alias(N_SALT)
    )
    spark = counts.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/netfeat_hot_{uuid.uuid4().hex[:16]}"
    hot.write.parquet(path)
    if paths is not None:
        paths.append(path)
    stored = spark.read.schema(hot.schema).parquet(path)
    return None if stored.isEmpty() else stored


def salted_join(
    big: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    hot: DataFrame | None,
    spread: Column,
    how: str = "inner",
) -> DataFrame:
    """``big.join(table, on, how)`` with hot keys of ``on`` salted.

    ``table`` must hold one row per key; ``hot`` is the output of
    :func:`hot_keys` with columns named like ``on``; ``spread`` is a column of
    ``big`` whose hash spreads the rows of one hot key (for example the other
    end of an edge). The hash is deterministic, so a recomputed task puts the
    same rows in the same bucket.
    """
    on = list(on)
    if hot is None:
        return big.join(table, on, how)
    n = F.coalesce(F.col(N_SALT), F.lit(1)).cast("long")
    big_s = big.join(hot, on, "left").withColumn(SALT, F.pmod(F.xxhash64(spread), n)).drop(N_SALT)
    table_s = (
        table.join(hot, on, "left")
        .withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
        .drop(N_SALT)
    )
    return big_s.join(table_s, [*on, SALT], how).drop(SALT)
