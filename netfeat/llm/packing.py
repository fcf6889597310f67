"""Best-fit packing of tokenised documents into sequences, improved by swaps."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace, map_texts
from netfeat.llm.tokens import MEMO, tokenizer

SEQUENCE = 2048
END = 0
#: Pieces that are packed together. A shard wastes less than one sequence, whatever the table's size.
SHARD = 20_000


def pieces(docs: DataFrame, path: str, capacity: int = SEQUENCE, memo: int = MEMO) -> DataFrame:
    """(doc_id, row, piece, start, length, ids_crc32): each document's ids and the end id, cut at ``capacity``."""

    def cut(texts, batch):
        out = {k: [] for k in ("doc_id", "row", "piece", "start", "length", "ids_crc32")}
        end, step = np.array([END], "<u4").tobytes(), 4 * capacity
        for doc_id, row, ids in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), tokenizer(path, memo).encode(texts)):
            ids += end
            for k, lo in enumerate(range(0, len(ids), step)):
                part = ids[lo : lo + step]
                for name, v in zip(out, (doc_id, row, k, lo // 4, len(part) // 4, zlib.crc32(part))):
                    out[name].append(v)
        return {k: pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()}

    return map_texts(docs, cut, "doc_id long, row long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Open bins, findable by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.rooms: list[int] = []  # sorted, those that some open bin has

    def _file(self, b: int, room: int) -> None:
        if not self.by_room[room]:
            self.rooms.insert(bisect_left(self.rooms, room), room)
        self.by_room[room].add(b)
        self.room[b] = room

    def _unfile(self, b: int) -> None:
        room = self.room[b]
        self.by_room[room].discard(b)
        if not self.by_room[room]:
            del self.rooms[bisect_left(self.rooms, room)]

    def put(self, item: int, size: int) -> None:
        """Into the bin that it leaves with the least room, or into a new one."""
        k = bisect_left(self.rooms, size)
        if k < len(self.rooms):
            b = min(self.by_room[self.rooms[k]])
            self._unfile(b)
            self.items[b].append(item)
            self._file(b, self.room[b] - size)
        else:
            self.items.append([item])
            self.room.append(0)
            self._file(len(self.items) - 1, self.capacity - size)


class Rooms:
    """The underfull bins by what they could give back: nothing, one document or two, of each total size.

    For each size a list of (room, bin) in order, so that the fullest bin with enough room is one bisection away,
    and the largest room of each size as an array, so that all sizes are tested at once."""

    def __init__(self, capacity: int):
        self.lists: list[list[list[tuple[int, int]]]] = [[[] for _ in range(capacity + 1)] for _ in range(3)]
        self.largest = np.full((3, capacity + 1), -1)

    @staticmethod
    def _backs(sizes: list[int]) -> tuple[set[int], set[int], set[int]]:
        once = set(sizes)
        two = {a + b for a, b in combinations(once, 2)}
        two.update(2 * s for s, n in Counter(sizes).items() if n > 1)
        return {0}, once, two

    def add(self, b: int, room: int, sizes: list[int]) -> None:
        for k, totals in enumerate(self._backs(sizes)):
            for total in totals:
                insort(self.lists[k][total], (room, b))
                self.largest[k, total] = max(self.largest[k, total], room)

    def remove(self, b: int, room: int, sizes: list[int]) -> None:
        for k, totals in enumerate(self._backs(sizes)):
            for total in totals:
                entries = self.lists[k][total]
                del entries[bisect_left(entries, (room, b))]
                self.largest[k, total] = entries[-1][0] if entries else -1

    def step(self, fill: int, capacity: int, out: int, kinds: tuple[int, ...], over: int) -> tuple[int, int, int, int] | None:
        """(gain, bin, kind, total given back) of the largest gain above ``over`` by which a bin takes ``out``,
        so that squared fill rises: the bin is then fuller than the source was."""
        best = None
        for k in kinds:
            gain = out - np.arange(min(out, len(self.largest[k])))
            possible = np.flatnonzero((self.largest[k, : len(gain)] >= gain) & (gain > over))
            for total in possible.tolist():  # gains fall
                entries = self.lists[k][total]
                room, b = entries[bisect_left(entries, (out - total, -1))]
                if capacity - room + out - total > fill:
                    over, best = out - total, (out - total, b, k, total)
                    break
        return best


def _taken(items: list[int], size: list[int], kind: int, total: int) -> list[int]:
    """``kind`` of the items that have the total size."""
    if kind == 0:
        return []
    first: dict[int, int] = {}
    for i in items:
        if kind == 1 and size[i] == total:
            return [i]
        if kind == 2 and total - size[i] in first:
            return [first[total - size[i]], i]
        first.setdefault(size[i], i)
    raise ValueError("no such items")


def improve(bins: list[list[int]], size: list[int], capacity: int) -> list[list[int]]:
    """Local search that raises the sum of squared fills until no step does or no bin can be saved.

    Every underfull bin in turn, the emptiest first, is the source: it moves a document to another underfull bin,
    or exchanges one for one, one for two or two for one, so that the other bin gains what the source loses and ends
    fuller than the source was. That raises the squared fill, a whole number with a bound, so the search ends: with a pass
    over all underfull bins in which none finds such a step, or when the bins are as few as their total size allows.
    A bin that is emptied is dropped."""
    bins = [list(b) for b in bins]
    fill = [sum(size[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    left = sum(map(bool, bins))
    rooms = Rooms(capacity)

    def sizes(b: int) -> list[int]:
        return [size[i] for i in bins[b]]

    for b in range(len(bins)):
        if 0 < fill[b] < capacity:
            rooms.add(b, capacity - fill[b], sizes(b))
    changed = True
    while changed and left > least:
        changed = False
        for source in sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: (fill[b], b)):
            if left <= least:
                break
            if not 0 < fill[source] < capacity:  # filled by an earlier source
                continue
            rooms.remove(source, capacity - fill[source], sizes(source))
            while bins[source]:
                best = None
                over = 0
                _, once, two = Rooms._backs(sizes(source))
                for n, totals, kinds in ((1, once, (0, 1, 2)), (2, two, (1,))):
                    for out in sorted(totals, reverse=True):
                        if out <= over:
                            break
                        found = rooms.step(fill[source], capacity, out, kinds, over)
                        if found:
                            over, best = found[0], (n, out, *found[1:])
                if best is None:
                    break
                changed = True
                n, out, target, kind, back = best
                rooms.remove(target, capacity - fill[target], sizes(target))
                given, taken = _taken(bins[source], size, n, out), _taken(bins[target], size, kind, back)
                bins[source] = [i for i in bins[source] if i not in given] + taken
                bins[target] = [i for i in bins[target] if i not in taken] + given
                fill[source] -= out - back
                fill[target] += out - back
                if fill[target] < capacity:
                    rooms.add(target, capacity - fill[target], sizes(target))
            if bins[source]:
                rooms.add(source, capacity - fill[source], sizes(source))
            else:
                left -= 1
    return [b for b in bins if b]


def pack(sizes: list[int], capacity: int = SEQUENCE) -> list[list[int]]:
    """Bins of item positions: best fit in order of decreasing size, then the local search."""
    bins = Bins(capacity)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bins.put(i, sizes[i])
    return improve(bins.items, sizes, capacity)


def packed(
    docs: DataFrame, path: str, capacity: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each document.

    A document is its ids and the end id; only one of more than ``capacity`` ids is cut. Pieces are dealt
    by a hash of the row's number and the piece into shards of about ``SHARD``, each packed on its own, so a task
    holds one shard's lengths, also when many rows are equal; the number is written with the pieces. ``memo`` bounds the pieces of text that a worker keeps. A null or empty text is the end id alone. Rows that repeat an id
    are documents of their own; a null id is kept. An empty table gives an empty result; other
    columns are ignored."""
    work = Workspace(docs.sparkSession, "packing")
    docs = docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_col).alias("text"),
    )
    cut = work.store(pieces(docs, path, capacity, memo), "pieces")
    shards = max(1, -(-cut.count() // SHARD))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "row", "piece", "ids_crc32", "length"], ignore_index=True)
        size = pdf["length"].tolist()
        sequence, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        shard = int(pdf["shard"].iat[0])
        for k, items in enumerate(pack(size, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = k * shards + shard, at
                at += size[i]
        return pdf.drop(columns=["shard", "row"]).assign(sequence_id=sequence, offset=offset)

    dealt = cut.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(
        fill, "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    ).withColumn("doc_id", F.col("doc_id").cast("long"))
