"""Dense numbers for ids, in the order of the ids.

Long numbers instead of strings halve the rows of every later shuffle and make comparisons,
hashes and minimums plain arithmetic. The order is kept, so whatever is decided by the smallest id (ties
between labels, the name of a component) is decided alike.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.session import checkpoint_dir

#: ``monotonically_increasing_id`` keeps the partition in the bits from here on.
_PARTITION_BIT = 33


def dense_numbers(ids: DataFrame, id_col: str, number_col: str, paths: list[str]) -> DataFrame:
    """``ids`` (one distinct, non-null value a row) -> a table (id_col, number_col): 0, 1, 2, ... in ascending order of the ids.

    A range sort deals the ids to partitions in order; each is written with its place in its partition. One row a partition,
    its count, comes to the driver, and the sums of the counts before are the partitions' offsets. The table's
    folder in the shared checkpoint folder is added to ``paths``, whose owner deletes it."""
    spark = ids.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/netfeat_numbers_{uuid.uuid4().hex[:16]}"
    paths.append(path)
    rows = ids.select(id_col).orderBy(id_col).withColumn("_at", F.monotonically_increasing_id())
    rows.write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    part = F.shiftright("_at", _PARTITION_BIT).cast("int").alias("_part")
    counts = sorted((r[0], r[1]) for r in stored.groupBy(part).count().collect())
    before, offsets = 0, []
    for _, n in counts:
        offsets.append(before)
        before += n
    place = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    if len(offsets) <= 1:
        return stored.select(id_col, place.alias(number_col))
    table = pa.table({"_part": pa.array([p for p, _ in counts], pa.int32()), "_before": pa.array(offsets, pa.int64())})
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(spark.createDataFrame(table)), "_part")  # a row a partition
        .select(id_col, (F.col("_before") + place).alias(number_col))
    )
