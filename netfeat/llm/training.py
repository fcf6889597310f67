"""Labelled training rows: a bounded sample outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str | Column = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 on division by 3; false for a null id."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` labelled ids of each class, in the order of a hash of the id.

    Ids with a null or with contradicting labels and held-out ids are left out. The sampled ids are
    at most 2 * per_class rows, which bounds the broadcast; the labels are joined by id alone."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("high"))
        .where("label = high").drop("high")
    )
    order = F.xxhash64("doc_id")
    picked = known.where("label = 1").orderBy(order, "doc_id").limit(per_class).unionByName(
        known.where("label = 0").orderBy(order, "doc_id").limit(per_class)
    )
    return docs.select(F.col("doc_id"), F.col("text")).join(F.broadcast(picked), "doc_id").select("text", "label")
