"""Toxicity by compression distance: two zstandard dictionaries, one of ordinary and one
of toxic text, compress the windows of a document; what the toxic one saves is the signal."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm import kernel
from netfeat.llm.common import Memo, Workspace, map_texts, one_for_worker, text_slices
from netfeat.llm.training import held_out, sample

#: Bound of the training sample: documents of each class. Their texts are whole.
TRAIN_DOCS = 1500
#: A score from here on is toxic.
TOXIC_FROM = 0.7
_DICTIONARY_BYTES = 1 << 14
_MAX_TOXIC_WINDOWS = 4096
_CODE_BYTES = 6
_MEMO = 80_000
_LEVEL = 9


@lru_cache(maxsize=1 << 16)
def _code(trigram: str) -> bytes:
    return hashlib.blake2b(trigram.encode("utf-8", "surrogatepass"), digest_size=_CODE_BYTES).digest()


def window_bytes(word: str) -> bytes:
    """A window, which is a word with its borders, as the codes of its character trigrams.

    A short word is too little for a compressor; a code for each trigram makes a word that
    the dictionary holds one long match, and lets a word that shares only parts cost its parts."""
    x = f"^{word}$"
    return b"".join([_code(x[i : i + 3]) for i in range(len(x) - 2)])


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return _compressor(self.ordinary), _compressor(self.ordinary + self.toxic)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        _LEVEL, dict_size=len(content), source_size=256, write_checksum=0, write_content_size=0, write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    if len(content) < 8:  # nothing to train on: plain compression
        return zstandard.ZstdCompressor(compression_params=params)
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=params)


def _document_words(text: str) -> list[str]:
    w = kernel.words([text.lower()], kernel.PUNCTUATION)
    raw = w.buffer.tobytes()
    return [raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(w.start.tolist(), w.end.tolist())]


def _grams(text: str) -> bytes:
    """Of the distinct word 4-grams of the whole text those whose hash is divisible by 4."""
    grams = kernel.grams(kernel.words([text.lower()], kernel.PUNCTUATION).hash, 4)
    return np.unique(grams[grams % np.uint64(4) == 0]).tobytes()


def _different(documents) -> list[int]:
    """Keys of the (key, label, grams) of which at most a quarter of the 4-grams occurred in earlier ones of the label."""
    seen, out = (set(), set()), []
    for key, label, grams in documents:
        grams = set(np.frombuffer(grams, np.uint64).tolist())
        if len(grams & seen[label]) * 4 <= len(grams):
            seen[label].update(grams)
            out.append(key)
    return out


def _features(saved: np.ndarray, w: kernel.Words) -> np.ndarray:
    """For each text the largest and second largest share saved of its different words."""
    out = np.zeros((len(w.first) - 1, 2))
    some = np.flatnonzero(np.diff(w.first))
    if len(some):
        starts = w.first[:-1][some]
        top = np.maximum.reduceat(saved, starts)
        out[some, 0] = top
        at_top = saved == np.repeat(top, np.diff(w.first)[some])
        best = np.full(len(some), np.uint64(0))
        # of several words with the top saving, the one of the largest hash counts as first
        np.maximum(best, np.maximum.reduceat(np.where(at_top, w.hash, np.uint64(0)), starts), out=best)
        rest = np.where(w.hash == np.repeat(best, np.diff(w.first)[some]), -np.inf, saved)
        second = np.maximum.reduceat(rest, starts)
        out[some, 1] = np.where(np.isfinite(second), second, 0)
    return np.maximum(out, 0)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.ordinary, self.toxic = model.compressors()
        self.frame = len(self.toxic.compress(b""))  # what any frame takes
        self.memo = Memo(_MEMO)

    def features(self, texts: list[str]) -> np.ndarray:
        w = kernel.words([t.lower() for t in texts], kernel.PUNCTUATION)
        h, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        self.memo.turn()
        raw, known, again = w.buffer, self.memo.new, self.memo.again
        saved = np.empty(len(h))
        for k, (x, i) in enumerate(zip(h.tolist(), first.tolist())):
            v = known.get(x)
            if v is None and (v := again(x)) is None:
                code = window_bytes(raw[w.start[i] : w.end[i]].tobytes().decode("utf-8", "surrogatepass"))
                plain, toxic = len(self.ordinary.compress(code)), len(self.toxic.compress(code))
                v = known[x] = 1 - max(toxic - self.frame, 1) / max(plain - self.frame, 1)
            saved[k] = v
        return _features(saved[back], w)

    def scores(self, texts: list[str], weights: tuple[float, ...] | None = None) -> np.ndarray:
        a, b, c = weights or self.model.weights
        z = a + self.features(texts) @ np.array([b, c])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@one_for_worker
def _of_dictionaries(ordinary: bytes, toxic: bytes) -> Scorer:
    return Scorer(Model(ordinary, toxic, (0.0, 0.0, 0.0)))


def _scorer(model: Model) -> Scorer:
    """One for each Python worker, so that its windows' savings serve later tasks too. Savings do not depend on the
    weights: the calibration and the scoring share them."""
    return _of_dictionaries(model.ordinary, model.toxic)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Dictionaries and calibration from a bounded sample of labelled rows outside the held-out fold, their texts whole.

    The ordinary dictionary is trained on ordinary documents. The toxic one adds the windows that are
    characteristic of toxic documents: in 3 and in 1.5 percent of them, and by odds of 20 to 1; the 4,096 of the largest odds
    (``_MAX_TOXIC_WINDOWS``) if there are more. From samples too few to train on, the ordinary dictionary is their first bytes.
    Near copies among the sampled documents count once. Without labels of a class every score is 0.

    Documents are counted for each word, and the features of the calibration computed, on the executors."""
    work = Workspace(docs.sparkSession, "toxicity")
    try:
        return _fit(sample(docs, labels, "toxic", TRAIN_DOCS), work)
    finally:
        work.close()


def _fit(rows: DataFrame, work: Workspace) -> Model:
    """The model of (text, label) rows; the same for the same rows in any order."""
    rows = work.store(rows.withColumn("key", F.xxhash64("text", "label")), "sample")
    signed = work.store(
        map_texts(
            rows,
            lambda texts, batch: {
                "key": batch.column("key"), "label": batch.column("label"), "grams": [_grams(t) for t in texts],
                "words": [list(dict.fromkeys(_document_words(t))) for t in texts],
            },
            "key long, label int, grams binary, words array<string>",
        ).dropDuplicates(["key"]),
        "signed",
    )
    kept = _different(signed.select("key", "label", "grams").orderBy("key").toLocalIterator())
    chosen = F.broadcast(work.spark.createDataFrame([(k,) for k in kept], "key long"))
    n = {r["label"]: r["count"] for r in signed.join(chosen, "key").groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model(b"", b"", (-40.0, 0.0, 0.0))
    least = max(3, -(-n[1] * 3 // 200))
    found = signed.join(chosen, "key").select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary")
    )
    odds = (F.col("toxic") + 0.5) * (n[0] + 1) / ((F.col("ordinary") + 0.5) * (n[1] + 1))
    typical = found.where((F.col("toxic") >= least) & (odds > 20)).orderBy(odds.desc(), F.col("word").desc())
    typical = [window_bytes(r.word) for r in typical.select("word").limit(_MAX_TOXIC_WINDOWS).collect()]
    ordinary = rows.where("label = 0").dropDuplicates(["key"]).join(chosen, "key").orderBy("key").select("text")
    samples = [b"".join(map(window_bytes, _document_words(r.text or ""))) for r in ordinary.toLocalIterator()]
    try:
        content = zstandard.train_dictionary(_DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        content = b"".join(samples)[:_DICTIONARY_BYTES]
    del samples
    model = Model(content, b"".join(reversed(typical)), (0.0, 0.0, 0.0))

    def features(texts, batch):
        x = _scorer(model).features(texts)
        return {"key": batch.column("key"), "label": batch.column("label"), "first": x[:, 0], "second": x[:, 1]}

    x = map_texts(rows, features, "key long, label int, first double, second double").limit(4 * TRAIN_DOCS).collect()
    x = np.array(sorted(tuple(r) for r in x), float)
    return Model(content, model.toxic, _logistic(x[:, 2:], x[:, 1]))


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row; ``predicted`` is 1 from ``TOXIC_FROM`` on.

    Windows are all words of the whole text (lower case). A null, empty or wordless text
    has the savings 0 and the score of those. Rows with equal ids are scored each;
    a null id is not held out. An empty table gives an empty result; other columns are ignored."""

    def score(texts, batch):
        s = _scorer(model).scores(texts, model.weights)
        return {"doc_id": batch.column("doc_id"), "score": s, "predicted": (s >= TOXIC_FROM).astype(np.int32)}

    scored = map_texts(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), score,
        "doc_id long, score double, predicted int",
    )
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, in one pass; nulls and rows without text are not toxic
    unless the model says so of an empty text."""

    def run(batches):
        for batch in batches:
            for texts, part in text_slices(batch, text_col):
                yield part.filter(pa.array(_scorer(model).scores(texts, model.weights) < TOXIC_FROM))

    return docs.mapInArrow(run, docs.schema)
