"""Byte-level BPE with a rank queue of hierarchical bitmaps."""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Memo, gaps, map_texts

_MEMO = 600_000
_LONGEST = 48
_SHIFT = 8  # a bitmap's node has 2 ** 8 bits
_MASK = (1 << _SHIFT) - 1

#: Two neighbouring blanks, or a blank other than space and line feed.
_UNEVEN = regex.compile(r"[\s\x1c-\x1f\x85]{2}|[^\S \n]|[\x1c-\x1f\x85]")


class Encoding:
    """``ranks``: token bytes to rank; ``pattern`` cuts a text into pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.tokens = {r: t for t, r in ranks.items()}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)])
        self.pairs = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        self.memo = Memo(_MEMO)

    def merge(self, pre_tokens: list[bytes]) -> list[bytes]:
        """The packed ranks of each pre-token: always the lowest pair first, the leftmost of equals.

        All pre-tokens stand in one buffer, and their parts are a linked list that does not cross from one to the
        next. One queue serves them all: a bucket of positions for each rank that some pair has, and two levels
        of bitmaps over the ranks, so the lowest rank is the first set bit of the upper bitmap, then of its node. A
        position whose part has gone or whose pair has another length by now is stale and skipped. Each merge
        adds at most two entries, so the work grows with the bytes, also of one very long pre-token."""
        ranks, buffer = self.ranks, b"".join(pre_tokens)
        n = len(buffer)
        starts = np.cumsum([0, *map(len, pre_tokens)])
        raw = np.frombuffer(buffer, np.uint8).astype(np.int64)
        part = self.bytes[raw].tolist()  # rank of the part that begins here
        first = np.zeros(n + 1, bool)
        first[starts] = True
        end = list(range(1, n + 1))  # of the part that begins here; 0 once it has gone
        before = np.where(first, -1, np.arange(n + 1) - 1).tolist()
        fixed = first.tolist()
        buckets: dict[int, list[int]] = {}
        lower: dict[int, int] = {}
        upper = 0
        if n > 1:
            pair = np.where(first[1:n], -1, self.pairs[raw[:-1] * 256 + raw[1:]])
            order = np.argsort(pair, kind="stable")
            seen, at = np.unique(pair[order], return_index=True)
            for r, some in zip(seen.tolist(), np.split(order, at[1:])):
                if r >= 0:
                    buckets[r] = some.tolist()
                    lower[r >> _SHIFT] = lower.get(r >> _SHIFT, 0) | 1 << (r & _MASK)
                    upper |= 1 << (r >> _SHIFT)
        while upper:
            node = (upper & -upper).bit_length() - 1
            bits = lower[node]
            low = bits & -bits
            lower[node] = bits ^ low
            if bits == low:
                upper ^= 1 << node
            rank = (node << _SHIFT) + low.bit_length() - 1
            positions = buckets.pop(rank)
            positions.sort()
            size = len(self.tokens[rank])
            fresh = []
            for k, i in enumerate(positions):
                middle, last = end[i], i + size
                if not middle or middle >= last or end[middle] != last:
                    continue
                part[i], end[i], end[middle] = rank, last, 0
                if not fixed[last]:
                    before[last] = i
                    r = ranks.get(buffer[i : end[last]])
                    if r is not None:
                        fresh.append((r, i))
                j = before[i]
                if j >= 0:
                    r = ranks.get(buffer[j:last])
                    if r is not None:
                        fresh.append((r, j))
                if fresh and fresh[-1][0] <= rank or len(fresh) > 1 and fresh[-2][0] <= rank:
                    fresh.extend((rank, p) for p in positions[k + 1 :])  # a lower pair comes first
                    break
            for r, i in fresh:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    node = r >> _SHIFT
                    lower[node] = lower.get(node, 0) | 1 << (r & _MASK)
                    upper |= 1 << node
        alive = np.flatnonzero(end)
        ids = np.array(part, "<u4")[alive].tobytes()
        cut = (4 * np.searchsorted(alive, starts)).tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:])]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ranks of pieces of text; a piece's pre-tokens are looked up, and new ones merged together."""
        cut = {}
        for p in pieces:
            if p[-1] in ".," and p[0] == " " and p[1:-1].isalpha():
                cut[p] = (p[:-1], p[-1])
            else:
                cut[p] = self.pattern.findall(p)
        tokens = set().union(*cut.values())
        known, again = self.memo.new, self.memo.again
        found = {t: i for t in tokens if (i := known.get(t) or again(t)) is not None}
        new = list(tokens.difference(found))
        found.update(zip(new, self.merge([t.encode("utf-8", "replace") for t in new])))
        learnt = {p: b"".join([found[t] for t in parts]) for p, parts in cut.items()}
        known.update((t, i) for t, i in found.items() if len(t) <= _LONGEST)
        known.update((p, i) for p, i in learnt.items() if len(p) <= _LONGEST)
        return learnt

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Where all blanks of a text are single spaces or line feeds, a space begins a pre-token and a line feed is one,
        so the pieces between them are cut by the pattern on their own, and pieces seen before are known."""
        self.memo.turn()
        split = []
        for text in texts:
            if not text:
                split.append([])
            elif text[0].isspace() or text[-1].isspace() or _UNEVEN.search(text):
                split.append(self.pattern.findall(text))
            else:
                pieces = text.replace("\n", " \n").split(" ")
                split.append([pieces[0], *[p if p[0] == "\n" else " " + p for p in pieces[1:]]])
        pieces = list(chain.from_iterable(split))
        found = list(map(self.memo.new.get, pieces))
        missing = gaps(found)
        if missing:
            new = {pieces[k] for k in missing}
            learnt = {p: ids for p in new if (ids := self.memo.again(p)) is not None}
            learnt.update(self._learn(new.difference(learnt)))
            for k in missing:
                found[k] = learnt[pieces[k]]
        cut = [0, *accumulate(map(len, split))]
        return [b"".join(found[a:b]) for a, b in zip(cut, cut[1:])]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> Encoding:
    """One for each Python worker and vocabulary."""
    with open(path, "rb") as f:
        return Encoding({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}, pattern)


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids: packed little-endian unsigned 32-bit integers, decoded: their bytes) for each row.

    A null or empty text has no ids. Rows that repeat an id are encoded each, a null id is kept, an
    empty table gives an empty result, other columns are ignored."""

    def run(texts, batch):
        e = encoding(path, pattern)
        ids = e.encode(texts)
        return {
            "doc_id": batch.column("doc_id"),
            "ids": pa.array(ids, pa.binary()),
            "decoded": pa.array([e.decode(i) for i in ids], pa.binary()),
        }

    selected = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(selected, run, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encoded``, hashed in the same stage."""
    return encoded(docs, path, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
