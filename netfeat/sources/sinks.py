"""Writer of the feature table, partitioned by vintage, and its reader."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netfeat.constants import VINTAGE
from netfeat.session import path_exists
from netfeat.sources.schema import IncompatibleSchema, merged

MODES = ("append", "overwrite", "overwrite_partitions", "error", "ignore")
#: Beside the data of a path target: its schema as JSON text. Spark's readers skip names that begin with ``_``.
_SCHEMA = "_schema"


def write_features(
    df: DataFrame,
    target: str,
    mode: str = "overwrite_partitions",
    partition_col: str | None = VINTAGE,
    fmt: str = "parquet",
) -> None:
    """Write ``df`` to a path (contains '/') or a catalog table.

    ``append`` adds rows (a re-run duplicates a vintage); ``overwrite_partitions``
    replaces only the partitions present in ``df`` (dynamic partition
    overwrite), so re-running a vintage is idempotent. In both modes the schemas
    merge, before anything is written: new columns are added (null in
    older rows), columns that the frame lacks are null in its rows, and a column of two types gets the
    smallest type that holds both without loss (:func:`netfeat.sources.schema.common_type`); if there is none,
    :class:`~netfeat.sources.schema.IncompatibleSchema` is raised. A path target keeps its
    schema beside the data, so :func:`read_features` reads older, narrower files in the wider type. A catalog table takes
    narrower columns as they come; one that would have to become wider is refused, as Spark cannot
    change the type of such a column in place.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} not in {MODES}")
    spark = df.sparkSession
    is_table = "/" not in target
    if is_table and mode in ("append", "overwrite_partitions") and spark.catalog.tableExists(target):
        _insert(df, target, overwrite=mode == "overwrite_partitions")
        return
    if not is_table and mode in ("append", "overwrite_partitions"):
        held = _path_schema(spark, target, fmt)
        both = merged(held, df.schema) if held is not None else df.schema
        own = {c.lower() for c in df.columns}
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in both.fields if f.name.lower() in own])
        if held != both:  # before the data: a schema that is wider than the files reads them too
            spark.createDataFrame([(both.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{target}/{_SCHEMA}")
    w = df.write.format(fmt)
    if mode == "overwrite_partitions":
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    if partition_col is not None:
        w = w.partitionBy(partition_col)
    if is_table:
        w.saveAsTable(target)
        return
    w.save(target)


def _path_schema(spark: SparkSession, target: str, fmt: str) -> T.StructType | None:
    """The schema of a path target, or None if there is none yet."""
    if path_exists(spark, f"{target}/{_SCHEMA}/_SUCCESS"):
        return T.StructType.fromJson(json.loads(spark.read.text(f"{target}/{_SCHEMA}").first()[0]))
    if not path_exists(spark, target):
        return None
    try:  # written by other hands, or in another mode
        return spark.read.format(fmt).option("mergeSchema", "true").load(target).schema
    except Exception as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # a folder without data
            return None
        raise


def _insert(df: DataFrame, table: str, overwrite: bool) -> None:
    """Insert into an existing table, replacing only the partitions present if ``overwrite``.

    Columns that only the frame has are added to the table first. ``insertInto`` matches by
    position, so the frame is put in the table's order and types."""
    spark = df.sparkSession
    held = spark.table(table)
    for f, wide in zip(held.schema.fields, merged(held.schema, df.schema).fields):
        if f.dataType != wide.dataType and not _only_nulls(f.dataType, wide.dataType):
            raise IncompatibleSchema(
                f"column {f.name} of table {table} would have to become {wide.dataType.simpleString()} "
                f"(it is {f.dataType.simpleString()})"
            )
    new = [f for f in df.schema.fields if f.name not in held.columns]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        held = spark.table(table)
    own = set(df.columns)
    cols = [
        (F.col(f.name) if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in held.schema.fields
    ]
    df.select(*cols).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=overwrite)


def _only_nulls(a: T.DataType, b: T.DataType) -> bool:
    """Whether two types differ only in what may be null."""
    return a.simpleString() == b.simpleString()


def read_features(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """Read a feature table back, in the schema of all its partitions."""
    if "/" not in target:
        return spark.table(target)
    if path_exists(spark, f"{target}/{_SCHEMA}/_SUCCESS"):
        return spark.read.format(fmt).schema(_path_schema(spark, target, fmt)).load(target)
    return spark.read.format(fmt).option("mergeSchema", "true").load(target)
