"""Session helpers: the shared checkpoint folder, reliable lineage cuts, concurrent jobs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names.

    Taken from the SparkContext or from ``spark.checkpoint.dir``. There is no
    fallback to a machine-local folder: on a cluster that would not survive the
    loss of an executor. Tests and local runs set the setting themselves.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        raise RuntimeError(
            "no checkpoint folder: set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)"
        )
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    A reliable checkpoint, never a local one: if an executor is lost, the
    blocks are read back from shared storage instead of being recomputed from
    the start of an iterative loop. Under adaptive execution the result has no known
    partitioning, so a later join shuffles it again; what must stay in place is written
    as a bucketed table instead (``Graph.by_endpoint``).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this job wrote, through the Hadoop file system of its scheme."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, through the Hadoop file system of its scheme."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()).exists(p)


def in_parallel(*thunks: Callable[[], Any]) -> list[Any]:
    """Run independent Spark jobs from separate threads and return their results.

    Spark schedules jobs submitted from different threads of one application
    at the same time ("scheduling within an application"), so independent
    iterative algorithms overlap instead of waiting on each other's small
    stages. The threads inherit the caller's job group, pool and description. When one
    fails, those that have not begun are cancelled and its exception propagates.
    """
    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        session = SparkSession.getActiveSession()
        inherit = inheritable_thread_target(session) if session else inheritable_thread_target
        futures = [pool.submit(inherit(t)) for t in thunks]
        try:
            return [f.result() for f in futures]
        except BaseException:
            for f in futures:
                f.cancel()
            raise
