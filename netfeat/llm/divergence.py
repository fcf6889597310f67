"""Quality rules: base counts, and the Jensen-Shannon distance of a document's histograms
of character classes and common words to references of its language."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace, map_texts
from netfeat.llm.stats import CLASSES, COMMON_WORDS, VOCABULARY, TextStats

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Below these sizes a histogram is too rough to judge by.
MIN_CHARS_TO_JUDGE = 200
MIN_WORDS_TO_JUDGE = 60
#: Largest distances that pass.
MAX_CLASS_DISTANCE = 0.2
MAX_WORD_DISTANCE = 0.4


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of ``p`` to the distribution ``q``."""

    def entropy(x):
        return -np.where(x > 0, x * np.log2(np.maximum(x, 1e-300)), 0).sum(axis=-1)

    return np.sqrt(np.clip(entropy((p + q) / 2) - (entropy(p) + entropy(q)) / 2, 0, 1))


def _shares(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1, keepdims=True)
    return counts / np.maximum(total, 1)


def _word_histogram(common: np.ndarray, plain_words: np.ndarray) -> np.ndarray:
    """Counts of the common words, and of all others as one more class."""
    return np.column_stack((common, plain_words - common.sum(axis=1)))


def _count(texts, batch):
    s = TextStats(texts)
    common = s.common_words(texts)
    return {
        "doc_id": batch.column("doc_id"),
        "lang": batch.column("lang"),
        "n_words": s.n_words,
        "word_chars": s.word_chars,
        "n_symbols": s.n_symbols,
        "n_dup_lines": s.n_dup_lines,
        "n_repeat_words": s.n_repeat_words,
        "classes": pa.array(list(s.characters), pa.list_(pa.int64())),
        "common": pa.array(list(_word_histogram(common, s.n_plain_words)), pa.list_(pa.int64())),
    }


_COUNTS = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, classes array<long>, common array<long>"
)


def references(counted: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """For each known language the shares of character classes and common words over all documents
    that pass the base rules, each document with equal weight. At most one row a known language
    comes to the driver."""

    def mean(column: str, size: int):
        total = F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)
        return [F.avg(F.when(total > 0, F.col(column)[i] / total)).alias(f"{column}{i}") for i in range(size)]

    known = list(COMMON_WORDS)
    rows = (
        counted.where(~F.col("base_failed") & F.col("lang").isin(known))
        .groupBy("lang").agg(*mean("classes", CLASSES), *mean("common", len(VOCABULARY) + 1)).collect()
    )
    out = {}
    for r in rows:
        classes = [r[f"classes{i}"] or 0.0 for i in range(CLASSES)]
        common = [r[f"common{i}"] or 0.0 for i in range(len(VOCABULARY) + 1)]
        out[r["lang"]] = (classes, common)
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row a document: base counts, ``base_failed``, both distances and ``kept``.

    Words are runs of characters other than the six ASCII blanks. ``base_failed``: fewer than 20 words,
    or over 30 percent of the words in repeated windows of eight. The references are the
    mean histograms of the language over the whole table; a document of a null or
    unknown language takes the nearest reference. ``kept`` is false if ``base_failed``, else false
    if a histogram of enough characters or words is farther from the reference than its limit.

    A null or empty text has zero counts and fails. With no reference at all (no document
    passes the base rules) the distances are null and do not reject. Rows that repeat an id are
    judged each; an empty table gives an empty result; other columns are ignored."""
    work = Workspace(docs.sparkSession, "quality_rules")
    counted = map_texts(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
        ),
        _count, _COUNTS,
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counted = work.store(counted.withColumn("base_failed", failed), "counted")
    refs = references(counted)

    def judge(batches):
        names = list(refs)
        for batch in batches:
            classes = np.array(batch.column("classes").flatten()).reshape(-1, CLASSES)
            common = np.array(batch.column("common").flatten()).reshape(-1, len(VOCABULARY) + 1)
            lang = batch.column("lang").to_pylist()
            near_class = near_word = np.full(len(lang), np.nan)
            if names:
                by_class = np.stack([distance(_shares(classes), np.array(refs[k][0])) for k in names])
                by_word = np.stack([distance(_shares(common), np.array(refs[k][1])) for k in names])
                nearest = np.argmin(by_class + by_word, axis=0)
                at = np.array([names.index(x) if x in refs else -1 for x in lang], np.int64)
                at = np.where(at >= 0, at, nearest)
                near_class, near_word = (m[at, np.arange(len(at))] for m in (by_class, by_word))
            far = (near_class > MAX_CLASS_DISTANCE) & (classes.sum(axis=1) >= MIN_CHARS_TO_JUDGE)
            far |= (near_word > MAX_WORD_DISTANCE) & (common.sum(axis=1) >= MIN_WORDS_TO_JUDGE)
            base = np.array(batch.column("base_failed").to_pylist(), bool)
            out = {k: batch.column(k) for k in _KEPT_COUNTS}
            out["kept"] = pa.array(~base & ~far)
            out["class_distance"], out["word_distance"] = pa.array(near_class, from_pandas=True), pa.array(near_word, from_pandas=True)
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return counted.mapInArrow(
        judge,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, class_distance double, word_distance double",
    )


_KEPT_COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
