"""Shared folder, intermediate tables, row keys and batches of texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else
    the context's checkpoint folder, else a folder in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (base or spark.conf.get("spark.sql.warehouse.dir") + "/_netfeat_work").rstrip("/")


class Workspace:
    """Intermediate tables of one operator call, as Parquet in the shared folder.

    A written table cuts the lineage and survives lost executors. ``drop`` removes
    tables that no later plan reads; the rest stays until ``close``, because the
    returned DataFrame still reads it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: set[str] = set()

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        self.names.add(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    def keep_only(self, *names: str) -> None:
        """Drop all tables but these."""
        for name in self.names.difference(names):
            self.drop(name)
        self.names.intersection_update(names)

    def close(self) -> None:
        self.drop()


def row_key(id_col: str, text_col: str) -> Column:
    """A key of the row's content that a second scan computes again; equal rows share it."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added to those that ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def slices(lengths: Iterable[int], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` in all; a longer text has its own."""
    lo, size, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n + 1
    if i >= lo:
        yield lo, i + 1


def text_slices(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[list[str], pa.RecordBatch]]:
    """A batch in slices of about a megabyte, each with its texts; a null text is empty there."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    for lo, hi in slices(lengths):
        part = batch.slice(lo, hi - lo)
        yield [t or "" for t in part.column(text_col).to_pylist()], part


def map_texts(
    df: DataFrame, fn: Callable[[list[str], pa.RecordBatch], dict[str, object]], schema: str, text_col: str = "text"
) -> DataFrame:
    """``fn(texts, batch)`` for bounded slices of every partition; a null text is empty.

    ``fn`` returns the output columns by name, in the order of ``schema``."""

    def run(batches):
        for batch in batches:
            for texts, part in text_slices(batch, text_col):
                out = fn(texts, part)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in out.values()], names=list(out)
                )

    return df.mapInArrow(run, schema)


_OF_WORKER: list = []


def one_for_worker(make: Callable) -> Callable:
    """``make`` with its last result kept, which is large, for later tasks of the Python worker; a worker holds one such
    result at a time. Workers outlive a stage, so what other stages, or other arguments, left would add to this one's memory."""
    kept = lru_cache(maxsize=1)(make)
    _OF_WORKER.append(kept)

    @wraps(make)
    def get(*args):
        for other in _OF_WORKER:
            if other is not kept and other.cache_info().currsize:
                other.cache_clear()
        return kept(*args)

    return get


class Memo:
    """A bounded memo of two generations: when the new one is full it becomes the old one.

    What is used again moves to the new generation, so frequent entries stay. It only saves
    work; what is not in it is computed again."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict = {}
        self.old: dict = {}

    def turn(self) -> None:
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}

    def again(self, key):
        """The old generation's entry, moved to the new one; or None."""
        value = self.old.get(key)
        if value is not None:
            self.new[key] = value
        return value


def gaps(found: list) -> list[int]:
    """Where a list holds None."""
    out, k = [], -1
    try:
        while True:
            k = found.index(None, k + 1)
            out.append(k)
    except ValueError:
        return out
