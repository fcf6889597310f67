"""Source divergence audit: how the word use of each source departs from its language and from the other sources.

Words are counted by sorting pointers: the starts of all words of a shard of Arrow text buffers are sorted by the words
they point at, and a run of equal words gives its document frequency and its count in each source."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace, slices

MIN_DOCUMENTS = 30
TOP_TERMS = 50
#: Added to every count.
PRIOR = 5
SCALE_DIGITS = 9
#: Text of a sorted shard; a longer text is a shard of its own.
SHARD_BYTES = 8 << 20
#: Words of one language that one task compares, and sources of a block.
TERMS_PER_UNIT = 20_000
BLOCK = 128

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array: views of its Arrow buffers. A null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, kind)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of the words: runs of ASCII letters and all that is not ASCII, within a text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _LETTER[data]
    begin = inside[1:] & ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begin[cut] |= inside[cut + 1]  # a word at a text's start, whatever ends the text before
    start = np.flatnonzero(begin[: len(data)])
    stop = inside[:-1] & ~inside[1:]
    stop[cut] |= inside[cut]
    end = np.flatnonzero(stop)
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def sort_pointers(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the words' order and where each run of equal words begins in it.

    Multikey quicksort on slices of eight bytes: all pointers are sorted by the slice at their depth; a run of equal slices
    whose words go on is sorted by the next slice, and so on, so no byte is looked at twice and runs
    that are done take no part. A word's last slice is filled with zeros, which no word holds."""
    n = len(start)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    order = np.arange(n)
    new = np.zeros(n, bool)  # a run of equal words begins here
    new[:1] = True
    todo, depth = np.arange(n), 0  # places whose words are equal so far within their runs
    while len(todo):
        at = order[todo]
        left = end[at] - start[at] - depth
        key = np.ascontiguousarray(eight[start[at] + depth]).view(">u8").ravel().astype(np.uint64)
        short = (left > 0) & (left < 8)
        shift = ((8 - left[short]) * 8).astype(np.uint64)
        key[short] = key[short] >> shift << shift
        key[left == 0] = 0
        run = np.cumsum(new[todo])  # the places of a run are consecutive in ``todo``
        by = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, run))
        at, key, run = at[by], key[by], run[by]
        order[todo] = at
        new[todo[1:]] |= (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        full = end[at] - start[at] >= depth + 8  # a word that ends within the slice equals all of its run
        size = np.diff(np.append(np.flatnonzero(new), n))
        alone = np.repeat(size == 1, size)[todo]
        todo = todo[full & ~alone]
        depth += 8
    return order, np.flatnonzero(new)


def _group_codes(langs: pa.Array, sources: pa.Array) -> tuple[np.ndarray, list[tuple[str, str]]]:
    """The (lang, source) group of each text, null as ''."""
    keys = list(zip(pc.fill_null(langs, "").to_pylist(), pc.fill_null(sources, "").to_pylist()))
    found: dict[tuple[str, str], int] = {}
    return np.array([found.setdefault(k, len(found)) for k in keys], np.int64), list(found)


def shard_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, count, documents) of a batch of texts, and a row with an empty term for each group."""
    group, names = _group_codes(batch.column("lang"), batch.column("source"))
    data, offsets = text_buffer(batch.column("text"))
    start, end, text = word_pointers(data, offsets)
    data = _LOWER[data]
    order, first = sort_pointers(data, start, end)
    run = np.zeros(len(order), np.int64)
    run[first[1:]] = 1
    run = np.cumsum(run)
    # within a run the pointers keep the order of the texts: one row for each (word, text), then for each (word, group)
    text = text[order]
    each = np.flatnonzero(np.concatenate(([True], (run[1:] != run[:-1]) | (text[1:] != text[:-1])))) if len(run) else run
    count = np.diff(np.append(each, len(run)))
    pair, place = np.unique(run[each] * max(len(names), 1) + group[text[each]], return_inverse=True)
    word, of = np.divmod(pair, max(len(names), 1))
    lead = order[first[word]]
    size = (end - start)[lead]
    where = np.repeat(start[lead] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum()) if len(lead) else lead
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(lead), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data[where])))
    of = np.concatenate((of, np.arange(len(names))))
    none = np.zeros(len(names), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([n[0] for n in names], pa.string()).take(pa.array(of)),
            pa.array([n[1] for n in names], pa.string()).take(pa.array(of)),
            pa.concat_arrays([terms, pa.array([""] * len(names), pa.string())]),
            pa.array(np.concatenate((np.bincount(place, count, len(pair)).astype(np.int64), none))),
            pa.array(np.concatenate((np.bincount(place, minlength=len(pair)).astype(np.int64), none))),
        ],
        names=["lang", "source", "term", "count", "documents"],
    )


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for lo, hi in slices(lengths, SHARD_BYTES):
            yield shard_counts(batch.slice(lo, hi - lo))


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, count, documents) over all texts, and a row with an empty term for each (lang, source)."""
    rows = docs.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = rows.mapInArrow(_count, "lang string, source string, term string, count long, documents long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))


def smoothed(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * kept)), exactly: the quotient three digits at a time, so that
    no product leaves 64 bits while the denominator is below 9 * 10^15."""
    top, bottom = count + PRIOR, total + PRIOR * kept
    step = 10**3
    out, rest = F.call_function("div", top, bottom), top % bottom
    for _ in range(SCALE_DIGITS // 3):
        rest = rest * step
        out, rest = out * step + F.call_function("div", rest, bottom), rest % bottom
    return out + 1


def _compare(key: tuple, rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the unit's words for the pairs of a source of block i and one of block j, and the number of words
    in the sum.

    ``rows`` (term, number, p): the words that a source holds; ``groups`` (number, block, base): all sources of the two blocks and
    the p of a word that a source does not hold. Words that no source of the blocks holds are not in the sum."""
    lang, _, i, j = key
    groups = groups.drop_duplicates("number").sort_values("number")
    number, block, base = (groups[c].to_numpy() for c in ("number", "block", "base"))
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    words, column = np.unique(rows["term"].to_numpy().astype(str), return_inverse=True)
    row, p = np.searchsorted(number, rows["number"].to_numpy()), rows["p"].to_numpy()
    by = np.argsort(column, kind="stable")
    row, column, p = row[by], column[by], p[by]
    total = np.zeros((len(left), len(right)), np.int64)
    width = max(1, (1 << 21) // max(len(number), 1))
    for lo in range(0, len(words), width):  # a bounded slice of the words at a time
        a, b = np.searchsorted(column, (lo, lo + width))
        dense = np.repeat(base[:, None], min(width, len(words) - lo), axis=1)
        dense[row[a:b], column[a:b] - lo] = p[a:b]
        for k, r in enumerate(right.tolist()):
            total[:, k] += np.abs(dense[left] - dense[r]).sum(axis=1)
    low, high = np.repeat(number[left], len(right)), np.tile(number[right], len(left))
    gap = np.abs(base[left][:, None] - base[right][None, :]).ravel()
    out = pd.DataFrame({"lang": lang, "low": low, "high": high, "value": total.ravel(), "gap": gap, "terms": len(words)})
    return out[out["low"] < out["high"]] if i == j else out


def divergence(
    docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS,
    lang: str = "lang", source: str = "source", text: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): which words and which other sources set a source apart.

    A language keeps the words (runs of ASCII letters and characters outside ASCII, A-Z in lower case) of at least ``min_documents`` of its rows.
    A group, each (lang, source) and each lang, has for a kept word p = 1 + floor(10^9 (count + 5) / (N + 5 V)), V the
    number of kept words and N the group's count of them. Part ``pair``: each other source of the language, by the sum
    of |p - q| over all kept words. Part ``term``: the kept words that a source holds with p above the language's, by the difference,
    ``top`` of them. Ranks follow the value, largest first, then the item by its bytes. All arithmetic is exact.

    A null text, lang or source is ''. A row is a document; repeated rows count again. A language that keeps no
    word has pairs of value 0 and no terms; a source alone in its language has no pairs. An empty table gives an empty
    result; other columns are ignored.

    Words are counted once, in the tasks; only (group, word) rows move. Pairs of sources are compared dense in blocks of sources and units of
    words, and only their partial sums move."""
    work = Workspace(docs.sparkSession, "audit")
    counts = work.store(term_counts(docs, lang, source, text), "counts")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("count").alias("whole"), F.sum("documents").alias("documents"))
    kept = work.store(kept.where(F.col("documents") >= min_documents).drop("documents"), "kept")
    held = work.store(counts.join(kept, ["lang", "term"]), "held")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_kept"), F.sum("whole").alias("n_lang"))
    totals = held.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("long")
    groups = (
        counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("n", "n_kept", "n_lang")))
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("block", F.floor(F.col("number") / BLOCK).cast("int"))
        .withColumn("blocks", F.floor((F.count(F.lit(1)).over(Window.partitionBy("lang")) - 1) / BLOCK).cast("int") + 1)
    )
    base = F.when(F.col("n_kept") > 0, smoothed(F.lit(0).cast("long"), F.col("n"), F.col("n_kept"))).otherwise(zero)
    groups = work.store(groups.withColumn("base", base), "groups")
    rows = held.join(groups, ["lang", "source"]).withColumn("p", smoothed(F.col("count"), F.col("n"), F.col("n_kept")))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    terms = rows.withColumn("value", F.col("p") - smoothed(F.col("whole"), F.col("n_lang"), F.col("n_kept"))).where("value > 0")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= top)

    units = F.greatest(F.ceil(F.col("n_kept") / TERMS_PER_UNIT), F.lit(1)).cast("int")
    halves = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("half")
    sides = [F.least("block", "half").alias("i"), F.greatest("block", "half").alias("j")]
    cells = rows.select("*", F.pmod(F.xxhash64("term"), units).cast("int").alias("unit"), halves)
    cells = cells.select("lang", "unit", *sides, "term", "number", "p")
    keys = ["lang", "unit", "i", "j"]
    stages = groups.select("*", halves).select(
        "lang", F.explode(F.sequence(F.lit(0), units - 1)).alias("unit"), *sides, "number", "block", "base"
    )
    stages = stages.toDF(*stages.columns)  # columns of its own, apart from those of the same table in ``cells``
    sums = cells.groupBy(*keys).cogroup(stages.groupBy(*keys)).applyInPandas(
        _compare, "lang string, low int, high int, value long, gap long, terms long"
    )
    sums = sums.groupBy("lang", "low", "high").agg(*(F.sum(c).alias(c) for c in ("value", "terms")), F.max("gap").alias("gap"))
    names = groups.select("lang", "number", "source", "n_kept")
    low = names.select("lang", F.col("number").alias("low"), F.col("source").alias("one"), "n_kept")
    high = names.select("lang", F.col("number").alias("high"), F.col("source").alias("two"))
    both = F.array(*(F.struct(F.col(a).alias("source"), F.col(b).alias("item")) for a, b in (("one", "two"), ("two", "one"))))
    pairs = sums.join(low, ["lang", "low"]).join(high, ["lang", "high"]).select(
        "lang", F.explode(both).alias("s"), (F.col("value") + F.col("gap") * (F.col("n_kept") - F.col("terms"))).alias("value")
    )
    pairs = pairs.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    return pairs.withColumn("rank", rank).unionByName(terms)
