"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netfeat.llm import backoff, bpe, quality, secrets, toxicity
from netfeat.llm.alignment import alignment
from netfeat.llm.caps import near_embeddings
from netfeat.llm.divergence import quality_rules
from netfeat.llm.ngram_join import ngram_join
from netfeat.llm.oracles import ORACLE_SQL
from netfeat.llm.packing import packed
from netfeat.llm.paragraphs import deduplicated
from netfeat.llm.sequences import token_sequences
from netfeat.llm.sources_audit import divergence

__all__ = ["ORACLE_SQL", "QUERIES", "ship", "vocabulary"]

ROOT = Path(__file__).resolve().parents[2]


def vocabulary(name: str) -> str:
    """The path of a public vocabulary, on the driver and on every worker."""
    return public_tokenizers.path(name)


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, unless they find it on their path already."""
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if spark.sparkContext.master.startswith("local["):
        on_path.append(os.getcwd())  # where local workers start
    if any(p and Path(p).resolve() == ROOT for p in on_path):
        return
    target = Path(SparkFiles.getRootDirectory(), "source", "netfeat-source.zip")
    if str(target) in getattr(spark.sparkContext, "_python_includes", ()) or target.exists():
        return
    target.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted((ROOT / "netfeat").rglob("*.py")):
            z.write(f, f.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(target))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copy_id")


def op4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.secret_spans(_table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(
        _table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op8_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(_table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sums depend on their order in the last places
    return backoff.scores(_table(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(
        _table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )


def op12_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_sequences(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_divergence": op2_divergence,
    "op3_ngram_join": op3_ngram_join,
    "op4_paragraphs": op4_paragraphs,
    "op5_secrets": op5_secrets,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_caps": op8_caps,
    "op9_packing": op9_packing,
    "op10_backoff": op10_backoff,
    "op11_alignment": op11_alignment,
    "op12_sequences": op12_sequences,
    "op13_source_audit": op13_source_audit,
}
