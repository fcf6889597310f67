"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm import boosting
from netfeat.llm.common import map_texts
from netfeat.llm.stats import BLANK, DIGIT, FOREIGN, LOWER, NEWLINE, OTHER_ASCII, STOP, SYMBOL, UPPER, TextStats
from netfeat.llm.training import held_out, sample

#: Bound of the training sample: documents of each class.
TRAIN_DOCS = 8000


def features(texts: list[str]) -> np.ndarray:
    """Statistics of each whole text; one row a text."""
    s = TextStats(texts)
    common = s.common_words(texts).sum(axis=1)
    words, lines = np.maximum(s.n_words, 1), np.maximum(s.n_lines, 1)
    chars = np.maximum(s.characters.sum(axis=1), 1)
    share = {k: s.characters[:, k] / chars for k in (LOWER, UPPER, DIGIT, BLANK, NEWLINE, STOP, SYMBOL, OTHER_ASCII, FOREIGN)}
    squares = np.bincount(s.words.text, weights=s.word_points.astype(float) ** 2, minlength=len(texts)) / words
    mean = s.word_chars / words
    return np.column_stack(
        (
            np.log1p(s.n_words),
            mean,
            np.sqrt(np.maximum(squares - mean**2, 0)),
            *share.values(),
            share[UPPER] / np.maximum(share[UPPER] + share[LOWER], 1e-9),
            s.n_symbols / words,
            s.characters[:, STOP] / words,
            s.n_dup_lines / lines,
            s.n_short_lines / lines,
            np.log1p(s.n_words / lines),
            s.n_repeat_words / words,
            s.n_different / words,
            s.n_different / np.sqrt(words),
            common / np.maximum(s.n_plain_words, 1),
            s.n_plain_words / words,
        )
    )


def train(docs: DataFrame, labels: DataFrame) -> boosting.Trees:
    """Trees on the statistics of a bounded sample of labelled documents outside the held-out fold.

    The sample has up to ``TRAIN_DOCS`` documents of each class; the base score is set to the classes'
    shares in the sample. Only statistics, not texts, come to the driver. Without labels every score is 0.5."""
    rows = map_texts(
        sample(docs, labels, "quality", TRAIN_DOCS),
        lambda texts, batch: {"x": pa.array(list(features(texts)), pa.list_(pa.float64())), "label": batch.column("label")},
        "x array<double>, label int",
    ).limit(4 * TRAIN_DOCS).toPandas()
    if not len(rows):
        return boosting.fit(np.zeros((0, 1)), np.zeros(0))
    x, y = np.stack(rows["x"].to_numpy()), rows["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the same trees whatever the order of the rows
    return boosting.fit(x[order], y[order])


def quality(docs: DataFrame, trees: boosting.Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; ``predicted`` is 1 from a score of 0.5 on.

    A null text counts as empty and gets the score of zero statistics. Rows that repeat an id are scored
    each; a null id is not held out. An empty table gives an empty result; other columns are ignored."""

    def score(texts, batch):
        p = trees.probability(features(texts))
        return {"doc_id": batch.column("doc_id"), "score": p, "predicted": (p >= 0.5).astype(np.int32)}

    scored = map_texts(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), score,
        "doc_id long, score double, predicted int",
    )
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
