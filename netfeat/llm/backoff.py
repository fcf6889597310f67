"""Stupid-backoff language-model scores, with n-gram counts over the whole corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm import kernel
from netfeat.llm.common import map_texts, slices, text_slices

ORDER = 2
ALPHA = 0.4
#: Bytes of text in a block, and entries of count tables in a hash part.
BLOCK_BYTES = 8 << 20
PART_ENTRIES = 2_000_000
_LOT = 10_000


def _texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in lower case and without punctuation, and each text's first word."""
    hashes, first = [], [np.zeros(1, np.int64)]
    at = 0
    for lo, hi in slices(map(len, texts)):
        w = kernel.words([t.lower() for t in texts[lo:hi]], kernel.PUNCTUATION)
        hashes.append(w.hash)
        first.append(w.first[1:] + at)
        at += len(w.hash)
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.concatenate(first)


def exploded(texts: list[str], order: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For n = 1 .. order the n-grams' hashes and the position of their last word; each text's first word."""
    words, first = _texts(texts)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    out = []
    for n in range(1, order + 1):
        g = kernel.grams(words, n)
        whole = text[: len(g)] == text[n - 1 :][: len(g)]
        out.append((g[whole], np.flatnonzero(whole) + n - 1))
    return out, first


def _parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the hash, so that sorted hashes stand in order of their parts."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(sorted_hashes: np.ndarray) -> bytes:
    """Differences, byte plane by byte plane: the upper planes are zeros, which the shuffle compresses away."""
    step = np.diff(sorted_hashes, prepend=np.uint64(0))
    return step.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _tables(grams: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a block and their counts; a row counts as often as it has copies."""
    weight = np.repeat(copies, np.diff(first))
    distinct, back = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
    # exact below 2 ** 53
    count = np.bincount(back, weights=np.concatenate([weight[last] for _, last in grams]), minlength=len(distinct))
    return distinct, count.astype(np.int64)


def _requests(pdf: pd.DataFrame, order: int, parts: int) -> Iterator[dict]:
    """The block's distinct n-grams with their counts, by hash part: the block's exploded n-grams, combined."""
    grams, first = exploded(pdf["text"].tolist(), order)
    distinct, count = _tables(grams, first, pdf["copies"].to_numpy())
    part = _parts(distinct, parts)
    cut = np.flatnonzero(np.diff(part)) + 1
    for h, c in zip(np.split(distinct, cut), np.split(count, cut)):
        if len(h):
            yield {
                "block": int(pdf["block"].iat[0]),
                "part": int(_parts(h[:1], parts)[0]),
                "hashes": _pack(h),
                "counts": c.astype("<u8").tobytes(),
            }


def _elsewhere(more: np.ndarray) -> dict[str, bytes]:
    """Counts in other blocks: a bit for each n-gram, and the counts of those that have one."""
    return {"found": np.packbits(more > 0).tobytes(), "more": more[more > 0].astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()}


def _add_elsewhere(total: np.ndarray, found: bytes, more: bytes) -> None:
    at = np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8), count=len(total)))
    total[at] += np.ascontiguousarray(np.frombuffer(more, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _combined(docs: DataFrame) -> DataFrame:
    """(doc_id, text, copies) with the equal rows of a slice as one; rows without a text are left out."""

    def run(batches):
        for batch in batches:
            for texts, part in text_slices(batch.filter(pc.greater(pc.fill_null(pc.binary_length(batch.column("text")), 0), 0)), "text"):
                rows = Counter(zip(part.column("doc_id").to_pylist(), texts))
                ids, kept = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(kept, pa.string()), pa.array(list(rows.values()), pa.int64())],
                    names=["doc_id", "text", "copies"],
                )

    return docs.mapInArrow(run, "doc_id string, text string, copies long")


def _score(
    grams: list[tuple[np.ndarray, np.ndarray]], first: np.ndarray, distinct: np.ndarray, total: np.ndarray,
    n_corpus: int, alpha: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Log S and whether it backed off, for each word."""
    n = int(first[-1])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rest = n_corpus - np.diff(first)[text]
    others = []  # counts in other rows of the n-gram that ends at each word; -1 where there is none
    for g, last in grams:
        at = np.searchsorted(distinct, g)
        _, back, own = np.unique(text[last] * len(distinct) + at, return_inverse=True, return_counts=True)
        count = np.full(n, -1)
        count[last] = total[at] - own[back]
        others.append(count)
    out, penalty = np.full(n, np.nan), np.zeros(n)
    for k in range(len(others) - 1, -1, -1):
        found = np.isnan(out) & (others[k] > 0)
        context = others[k - 1][np.flatnonzero(found) - 1] if k else rest[found]
        out[found] = penalty[found] + np.log(others[k][found]) - np.log(context)
        if k:
            penalty[np.isnan(out) & (others[k] >= 0)] += np.log(alpha)
    unknown = np.isnan(out)
    out[unknown] = penalty[unknown] - np.log(rest[unknown] + 1)
    return out, unknown | (penalty < 0)


def scores(
    docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_backoff, score) for each row: the sum of log S over the words of the text.

    S(w | context) is the count of the n-gram over the count of its context in all *other* rows; where they
    never hold the n-gram, alpha times S of the context without its first word. Without a context it is the
    count of w over the other rows' words, and 1 / (those words + 1) for a w that they do not hold. At the
    begin of a text the contexts are shorter. So the score of a row never rests on its own counts;
    ``n_backoff`` counts the words whose longest n-gram no other row holds.

    The count tables are partitioned by a hash of the n-gram. Blocks of documents send them their
    distinct n-grams with the block's counts, so a frequent n-gram is one entry a block; a
    hash part adds them up and returns to each block the counts of the others; the blocks explode their n-grams once more,
    subtract the row's own counts and sum per row. Counts are over all rows; nothing is cut off. Rows of the same id
    and text are one row with a number of copies, and rows without a text are in no block, so equal rows fill none.

    N-grams are named by 64-bit hashes. A null, empty or wordless text has the score 0 and no words. Rows that repeat
    an id, also equal rows, are rows of their own (each other's *other* rows). An empty table gives an
    empty result; other columns are ignored."""
    docs = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    size = map_texts(
        docs, lambda texts, batch: {"bytes": [sum(map(len, texts))], "rows": [len(texts)], "words": [len(_texts(texts)[0])]},
        "bytes long, rows long, words long",
    ).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "rows", "words")]).first()
    n_corpus = size["words"]
    blocks = max(1, -(-size["bytes"] // BLOCK_BYTES), -(-size["rows"] // 50_000))
    parts = max(1, -(-size["bytes"] // 4 // PART_ENTRIES))
    # equal rows are one with a number of copies, before the shuffle and again behind it, on the same partitioning
    dealt = (
        _combined(docs).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
        .repartition("block").groupBy("block", "doc_id", "text").agg(F.sum("copies").alias("copies"))
    )

    def request(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = ["block", "part", "hashes", "counts"]
        return pd.DataFrame(list(_requests(pdf, order, parts)), columns=columns)

    asked = dealt.groupBy("block").applyInPandas(request, "block int, part int, hashes binary, counts binary")

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = [_unpack(h) for h in pdf["hashes"]]
        _, back = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.concatenate([np.frombuffer(c, "<i8") for c in pdf["counts"]])
        more = np.bincount(back, weights=counts).astype(np.int64)[back] - counts  # exact below 2 ** 53
        cut = np.cumsum([len(h) for h in hashes])[:-1]
        out = pd.DataFrame([_elsewhere(m) for m in np.split(more, cut)])
        return out.assign(block=pdf["block"].to_numpy(), part=pdf["part"].to_numpy())[["block", "part", "found", "more"]]

    totals = asked.groupBy("part").applyInPandas(answer, "block int, part int, found binary, more binary")

    def score(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams, first = exploded(rows["text"].tolist(), order)
        distinct, total = _tables(grams, first, rows["copies"].to_numpy())
        ends = np.searchsorted(_parts(distinct, parts), np.arange(parts + 1))
        for part, found, more in zip(answers["part"], answers["found"], answers["more"]):
            _add_elsewhere(total[ends[part] : ends[part + 1]], found, more)
        logs, backed = _score(grams, first, distinct, total, n_corpus, alpha)
        text = np.repeat(np.arange(len(rows)), np.diff(first))
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"],
                "n_words": np.diff(first),
                "n_backoff": np.bincount(text, weights=backed, minlength=len(rows)).astype(np.int64),
                "score": np.bincount(text, weights=logs, minlength=len(rows)),
                "copies": rows["copies"],
            }
        )

    scored = dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(
        score, "doc_id string, n_words long, n_backoff long, score double, copies long"
    )
    # each copy is a row again; in two steps, so that no array grows with the copies
    scored = scored.withColumn("_lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_LOT}"))))
    scored = scored.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(_LOT), F.expr(f"copies - _lot * {_LOT}")))))
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "n_words", "n_backoff", "score"]
    empty = docs.where(F.coalesce(F.length("text"), F.lit(0)) == 0).select(
        "doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_backoff"), F.lit(0.0).alias("score")
    )
    return scored.select(*columns).unionByName(empty.select(*columns))
