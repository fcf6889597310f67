"""Corpus pipeline: toxicity, n-gram Jaccard join, substring deduplication, secret scans, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept and
returns a DataFrame with the columns of ``docs``; the last one returns packed pieces. A null text is an empty one; it is
neither toxic (unless the model says so of an empty text) nor a copy, holds no passage and no secret, and is packed as its
end id. Null ids come last where ids decide. Rows that are equal in id and text are one document from the second stage on; of
tied documents the one of the smaller row key stays. Columns that an operator uses itself may be there under any
name. An empty table gives an empty result in every stage. ``run``
writes each stage's rows as Parquet in the shared folder and reads them as the next one's input.
SQL cannot express the stages (a trained model, MinHash, a tokeniser), so ``ORACLE_SQL`` is None and
``tests/llm`` holds the rows of ``run`` against a brute-force version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netfeat.llm import secrets, toxicity
from netfeat.llm.common import Workspace
from netfeat.llm.ngram_join import ngram_join, one_per_class
from netfeat.llm.packing import packed
from netfeat.llm.paragraphs import deduplicated
from netfeat.llm.queries import ship, vocabulary

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.7 or more; the labels train the model, and without labels of both
    classes nothing goes. Repeated rows are judged each."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that Jaccard links join, the one of the smallest id; equal rows count once. Texts without words
    are in no group and stay."""
    ship(spark)
    return one_per_class(docs, ngram_join(docs))


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that an earlier document holds; a document that loses all its
    text goes, one that had none stays. ``n_chars`` follows the text where a passage went."""
    ship(spark)
    return deduplicated(docs, keep=docs.columns).where((F.col("removed_words") == 0) | F.col("text").rlike(r"\S")).select(
        *[
            F.when(F.col("removed_words") > 0, F.length("text").cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With every secret replaced by a mark; overlapping ones become one. ``n_chars`` is that of the text, and stays where the text is null."""
    clean = secrets.redacted(docs, secrets.secret_spans(docs))
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document and their places in sequences of 2048 tokens; every row has a piece at least."""
    ship(spark)
    # a small memo: the workers still hold what earlier stages keep
    return packed(docs, vocabulary("word_bpe_49k.json"), memo=100_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", one_of_each_group),
    ("paragraphs", drop_passages),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``. Each stage's rows are a written table in the shared folder; the one
    before it is dropped."""
    work = Workspace(spark, "pipeline")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        rows = work.store(stage(spark, rows, sf_dir), name)
        if k:
            work.drop(STAGES[k - 1][0])
    return rows
