"""N-gram Jaccard self-join of documents by MinHash banding."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm import kernel
from netfeat.llm.common import Workspace, map_texts, row_key, unused
from netfeat.llm.minhash import candidate_groups, choose_bands, verified

NGRAM = 5
ROWS = 4
#: At a similarity of 0.8, 14 bands of 4 rows find a pair with a probability of 0.999.
BANDS = choose_bands(0.8, 0.999, ROWS)


def _sign(texts, batch):
    sets = kernel.shingle_sets(kernel.words([t.lower() for t in texts], kernel.PUNCTUATION), NGRAM)
    full = [s for s in sets if len(s)]
    keys = iter(kernel.band_keys(full, BANDS, ROWS) if full else ())
    return {
        "doc_id": batch.column("doc_id"),
        "row": batch.column("row"),
        "item": pa.array([h if len(s) else None for s, h in zip(sets, kernel.set_hashes(sets).tolist())], pa.int64()),
        "keys": pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
    }


def _sets(texts, batch):
    sets = kernel.shingle_sets(kernel.words([t.lower() for t in texts], kernel.PUNCTUATION), NGRAM)
    return {
        "grp": batch.column("grp"),
        "item": batch.column("item"),
        "keys": batch.column("keys"),
        "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
        "weight": batch.column("weight"),
    }


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: (doc_id, class_id, n_links, copy_id, row, keeper).

    Two documents are linked when the Jaccard similarity of their sets of 5-word shingles
    (lower case, words of letters and digits) is 0.8 or more. ``n_links`` counts the other
    rows linked to the row directly, ``class_id`` is the smallest id that links reach and
    ``copy_id`` the smallest id with the same shingle set. ``keeper`` is true for one row of
    each class, or for all rows of a class that are equal to it; ``row`` is the row's key.

    Documents with the same set are one item from the first shuffle on, so copies are
    never paired; only items that share a band are read again for their full sets.
    A text of 1 to 4 words has one shingle, all its words. A null, empty or wordless text
    links with nothing: its class and copy ids are its own. Rows with a null id take part;
    their class id is the smallest id of the class that is not null, if any. Rows
    that repeat an id are rows of their own. An empty table gives an empty result. Other columns
    are ignored."""
    work = Workspace(docs.sparkSession, "ngram_join")
    docs = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    signed = work.store(
        map_texts(docs, _sign, "doc_id long, row long, item long, keys array<long>"), "signed"
    )
    # the kept row of a class: the smallest id, nulls last, then the smallest key
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    items = signed.where("item is not null").groupBy("item").agg(
        F.min(order).alias("kept"), F.count(F.lit(1)).alias("weight"), F.first("keys").alias("keys")
    )
    items = work.store(items, "items")
    groups = candidate_groups(items.select("item", "keys"), work, "candidates")
    wanted = items.join(groups, "item").select("kept.row", "grp", "item", "keys", "weight")
    sets = work.store(
        map_texts(
            docs.select("row", "text").join(wanted, "row"), _sets,
            "grp long, item long, keys array<long>, shingles binary, weight long",
        ),
        "sets",
    )
    links = verified(sets, work, "verify")
    members = items.select("item", "kept", "weight").join(links, "item", "left")
    members = work.store(members.withColumn("class", F.coalesce("class", "item")), "members")
    work.keep_only("signed", "members")
    classes = members.groupBy("class").agg(F.min("kept").alias("first"))
    named = members.join(classes, "class").select(
        "item", F.col("kept.id").alias("copy_id"), F.col("first.id").alias("class_id"),
        F.col("first.row").alias("kept_row"),
        (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    return signed.select("doc_id", "row", "item").join(named, "item", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        "row",
        (F.col("item").isNull() | (F.col("row") == F.col("kept_row"))).alias("keeper"),
    )


def one_per_class(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``ngram_join`` keeps, equal rows once."""
    (key,) = unused(docs, "_row")
    kept = joined.where("keeper").select(F.col("row").alias(key)).distinct()
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    return keyed.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
