"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and how often over the corpus.

Both tokenizers cover the same bytes. Offsets where a token of each ends cut the bytes into groups; two tokens are linked
when their bytes overlap. Between two neighbouring ends (of either) lies one token of each, so the links of a text are the distinct ends of
its tokens."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace, slices, text_slices

#: Text of a block, whose distinct pairs are counted together.
BLOCK_BYTES = 8 << 20
#: Pairs of a part, over all blocks of a lane, and blocks of a lane, about.
PART_BYTES = 32 << 20
LANE_BLOCKS = 4096
_SPACE = "\N{LOWER ONE EIGHTH BLOCK}"


def _byte_characters() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else the next from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    out.update({chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)})
    return out


class Vocabularies:
    """Two tokenizers, their tokens' bytes, and the map from ids of A to the id of B with the same bytes."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = _byte_characters()
        with open(path_a, encoding="utf-8") as f:
            special = {t["id"] for t in json.load(f).get("added_tokens", [])}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = token.encode() if i in special else bytes(of[c] for c in token)
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(_SPACE, " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        first: dict[bytes, int] = {}
        for i, raw in enumerate(self.bytes_b):
            first.setdefault(raw, i)
        self.same = np.array([first.get(raw, -1) if raw else -1 for raw in self.bytes_a], np.int64)
        self.size_a = np.array([len(raw) for raw in self.bytes_a], np.int64)
        self.size_b = np.array([len(raw) for raw in self.bytes_b], np.int64)
        # the decimal ids with each mark that can follow them, as six bytes filled with zeros; a row for each (mark, id)
        self.n = max(len(self.bytes_a), len(self.bytes_b))
        width = len(str(self.n)) + 1
        self.printed = np.zeros((3 * self.n, width), np.uint8)
        for k, mark in enumerate(",|;"):
            text = "".join(f"{i}{mark}".ljust(width, "\0") for i in range(self.n))
            self.printed[k * self.n : (k + 1) * self.n] = np.frombuffer(text.encode(), np.uint8).reshape(self.n, width)
        self.length = (self.printed != 0).sum(axis=1)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both for each text; empty where a text is empty or the tokens' bytes are not the text's."""
        none = np.zeros(0, np.int64)
        ids_a, ids_b = [none] * len(texts), [none] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        for lo, hi in slices([len(texts[k]) for k in some], 1 << 18):
            part = some[lo:hi]
            found_a = self.a.encode_batch_fast([" " + texts[k] for k in part], add_special_tokens=False)
            found_b = self.b.encode([texts[k] for k in part], num_threads=1)
            for k, a, b in zip(part, found_a, found_b):
                want = b" " + texts[k].encode("utf-8", "replace")
                a = a.ids
                if b"".join(map(self.bytes_a.__getitem__, a)) == want == b"".join(map(self.bytes_b.__getitem__, b)):
                    ids_a[k], ids_b[k] = np.array(a, np.int64), np.array(b, np.int64)
        return ids_a, ids_b


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """One pair for each Python worker."""
    return Vocabularies(path_a, path_b)


class Aligned:
    """The alignment of some texts, laid end to end; every text ends with an end of both."""

    def __init__(self, v: Vocabularies, ids_a: list[np.ndarray], ids_b: list[np.ndarray]):
        self.v, n = v, len(ids_a)
        self.n_a, self.n_b = (np.array([len(i) for i in ids], np.int64) for ids in (ids_a, ids_b))
        none = np.zeros(0, np.int64)
        a, b = (np.concatenate(ids) if ids else none for ids in (ids_a, ids_b))
        end_a, end_b = np.cumsum(v.size_a[a]), np.cumsum(v.size_b[b])
        total = int(end_a[-1]) if len(a) else 0
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[end_a] = True
        is_b[end_b] = True
        ends = np.flatnonzero(is_a | is_b)
        both = is_a[ends] & is_b[ends]
        # the token over the bytes before each end: the number of ends of its kind before it
        at_a, at_b = np.cumsum(is_a[ends]) - is_a[ends], np.cumsum(is_b[ends]) - is_b[ends]
        text_a = np.repeat(np.arange(n), self.n_a)
        self.text = text_a[at_a]
        self.link_a, self.link_b = a[at_a], b[at_b]
        self.n_links = np.bincount(self.text, minlength=n)
        self.n_groups = np.bincount(self.text[both], minlength=n)
        self.identity = v.same[self.link_a] == self.link_b
        self._print(a, b, end_a, end_b, is_a & is_b, text_a)

    def _print(self, a, b, end_a, end_b, common, text_a) -> None:
        """The groups as text: tokens of A with commas and a bar, tokens of B with commas and a semicolon."""
        v = self.v
        last_a, last_b = common[end_a], common[end_b]
        before = np.cumsum(last_a) - last_a  # groups before a token's own
        of_b = np.cumsum(last_b) - last_b
        size_a, size_b = (np.bincount(x, minlength=int(last_a.sum())) for x in (before, of_b))
        first_b = np.cumsum(size_b) - size_b  # tokens of B before a group
        up_to_a = np.cumsum(size_a)  # tokens of A up to a group's last
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + first_b[before]] = a + v.n * last_a
        code[np.arange(len(b)) + up_to_a[of_b]] = b + v.n * 2 * last_b
        printed = v.printed[code].ravel()
        self.printed = printed[printed != 0]
        size = np.concatenate(([0], np.cumsum(v.length[code])))
        cut = np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))
        self.cut = size[cut]

    def groups(self, k: int) -> bytes:
        """``a1,a2|b1;a3|b2`` of the k-th text."""
        return self.printed[self.cut[k] : max(self.cut[k], self.cut[k + 1] - 1)].tobytes()

    def digest(self, k: int) -> str:
        text = self.groups(k)
        return hashlib.sha256(text).hexdigest() if text else ""


_BLOCKS = (
    "block long, identity binary, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs binary, documents binary, entries binary, which binary, times binary"
)
_MOST_TIMES = 255


def _pair_type(n_a: int, n_b: int) -> str:
    return "<u4" if n_a * n_b <= 1 << 32 else "<u8"


def _blocks(path_a: str, path_b: str, block_bytes: int):
    """Rows of blocks of texts, and, as the last row of a task, its vector of identity counts.

    A pair of A with its B of the same bytes is counted by A's id alone, in a vector of the vocabulary's length; all other
    pairs of a block are listed once (``pairs``: a * |B| + b) with the number of documents that hold them. For the scores, a block keeps
    each document's distinct links in the order of the documents: how many ``entries`` each has, ``which`` link an entry is (A's id, or |A|
    and the place in ``pairs``) and how many ``times`` it occurs; beyond 255 it has several entries."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, part, number = vocabularies(path_a, path_b), TaskContext.get().partitionId(), 0
        n_a, n_b = len(v.bytes_a), len(v.bytes_b)
        identity = np.zeros(n_a, np.int64)
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal number, held, size
            key, times = (np.concatenate([h[k] for h in held]) for k in (7, 8))
            pairs, place = np.unique(key[key >= n_a], return_inverse=True)
            documents = np.bincount(place, minlength=len(pairs)).astype("<u4")
            which = key.astype("<u4")
            which[key >= n_a] = n_a + place
            copies = -(-times // _MOST_TIMES)
            which, first = np.repeat(which, copies), np.cumsum(copies) - copies
            part_times = np.full(len(which), _MOST_TIMES, np.uint8)
            part_times[first] = times - (copies - 1) * _MOST_TIMES
            counts = np.concatenate([np.bincount(h[6], minlength=len(h[0])) for h in held])
            entries = np.add.reduceat(np.append(copies, 0), np.cumsum(counts) - counts) * (counts > 0)
            lists = [pa.array([sum((h[k] for h in held), [])], pa.list_(pa.string() if k == 5 else pa.int64())) for k in range(6)]
            parts = ((pairs - n_a).astype(_pair_type(n_a, n_b)), documents, entries.astype("<u4"), which, part_times)
            binary = [pa.array([x.tobytes()], pa.binary()) for x in parts]
            row = [pa.array([(part << 32) + number], pa.int64()), pa.array([None], pa.binary()), *lists, *binary]
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(row, names=names)

        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        for whole in batches:
            for texts, piece in text_slices(whole, "text"):
                x = Aligned(v, *v.encode(texts))
                # a document's distinct links: identities by A's id, then the other pairs
                key = np.where(x.identity, x.link_a, n_a + x.link_a * n_b + x.link_b)
                distinct, times = np.unique(x.text * (n_a + n_a * n_b) + key, return_counts=True)
                of, key = np.divmod(distinct, n_a + n_a * n_b)
                identity += np.bincount(key[key < n_a], minlength=n_a)
                stats = (s.tolist() for s in (x.n_a, x.n_b, x.n_groups, x.n_links))
                held.append((piece.column("doc_id").to_pylist(), *stats, [x.digest(k) for k in range(len(texts))], of, key, times))
                size += sum(map(len, texts))
                if size >= block_bytes:
                    yield block()
        if held:
            yield block()
        if identity.any():
            row = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.binary()] * 5)]
            row[1] = pa.array([identity.astype("<i8").tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(row, names=names)

    return run


def _vector(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the task's vectors, as (id, documents)."""
    total = None
    for batch in batches:
        for raw in batch.column("identity"):
            counts = np.frombuffer(raw.as_buffer(), "<i8")
            total = counts.copy() if total is None else total + counts
    if total is not None:
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["a", "documents"])


def _deal(parts: int, lanes: int, kind: str):
    """Each block's pairs by hash parts; ``lane`` spreads the blocks of a part over several units."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"part": [], "lane": [], "block": [], "pairs": [], "documents": []}
            for block, pairs, documents in zip(batch.column("block").to_pylist(), batch.column("pairs"), batch.column("documents")):
                pairs, documents = np.frombuffer(pairs.as_buffer(), kind), np.frombuffer(documents.as_buffer(), "<u4")
                of = _part(pairs, parts)
                by = np.argsort(of, kind="stable")
                cut = np.searchsorted(of[by], np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cut)).tolist():
                    mine = by[cut[p] : cut[p + 1]]
                    lane = (block ^ (block >> 32)) % lanes
                    for name, x in zip(out, (p, lane, block, pairs[mine].tobytes(), documents[mine].tobytes())):
                        out[name].append(x)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out.values(), types)], names=list(out))

    return run


def _part(pairs: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _lane_totals(kind: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The pairs of a unit's blocks, each once with its documents."""
        keys = np.concatenate([np.frombuffer(b, kind) for b in pdf["pairs"]])
        counts = np.concatenate([np.frombuffer(b, f"<u{w}") for b, w in zip(pdf["documents"], pdf["width"])])
        found, place = np.unique(keys, return_inverse=True)
        counts = np.bincount(place, counts, len(found)).astype("<u8")
        row = {"part": pdf["part"].iat[0], "pairs": found.tobytes(), "documents": counts.tobytes(), "width": 8}
        return pd.DataFrame([row])

    return run


def _best(n_b: int, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The highest count of each id of A in a part."""
        for batch in batches:
            for pairs, documents in zip(batch.column("pairs"), batch.column("documents")):
                a, counts = np.frombuffer(pairs.as_buffer(), kind) // n_b, np.frombuffer(documents.as_buffer(), "<i8")
                first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, np.int64)
                top = np.maximum.reduceat(counts, first) if len(a) else counts
                yield pa.RecordBatch.from_arrays([pa.array(a[first].astype(np.int64)), pa.array(top)], names=["a", "documents"])

    return run


def _answer(kind: str):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """For each block's pairs of the part, in their order: the corpus-wide counts."""
        if not len(left):
            return pd.DataFrame({"block": [], "part": [], "counts": []})
        pairs, documents = np.frombuffer(right["pairs"].iat[0], kind), np.frombuffer(right["documents"].iat[0], "<i8")
        if documents.max() < 1 << 32:
            documents = documents.astype("<u4")
        counts = [documents[np.searchsorted(pairs, np.frombuffer(b, kind))].tobytes() for b in left["pairs"]]
        return pd.DataFrame({"block": left["block"], "part": left["part"], "counts": counts})

    return run


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _score(identity: np.ndarray, best: np.ndarray, n_b: int, parts: int, kind: str):
    """Documents of the blocks, whose pairs' counts arrive as ``answers`` (part, counts)."""
    n_a = len(identity)
    lists = ("doc_id", "n_a", "n_b", "n_groups", "n_links")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(k, 1) for batch in batches for k in range(batch.num_rows)):
            value = {c: row.column(c)[0] for c in row.schema.names}
            types = {"pairs": kind, "entries": "<u4", "which": "<u4", "times": np.uint8}
            pairs, entries, which, times = (np.frombuffer(value[c].as_buffer(), t) for c, t in types.items())
            counts = np.zeros(n_a + len(pairs), np.int64)
            counts[:n_a] = identity
            mine = _part(pairs, parts)
            for answer in value["answers"].as_py() or ():
                at, raw = n_a + np.flatnonzero(mine == answer["part"]), answer["counts"]
                counts[at] = np.frombuffer(raw, "<u4" if len(raw) == 4 * len(at) else "<i8")
            top = np.concatenate((best, best[pairs // n_b]))
            link = counts[which]
            # running sums, as a document may have no entry
            last = np.cumsum(entries.astype(np.int64))
            sums = []
            for x in (np.where(link == top[which], times, 0).astype(np.int64), link * times):
                run_sum = np.concatenate(([0], np.cumsum(x)))
                sums.append(pa.array(run_sum[last] - run_sum[last - entries]))
            columns = [value[c].values for c in lists] + sums + [value["groups_sha256"].values]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _OUT.split(", ")])

    return run


def _by_id(rows: list, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    out[[r.a for r in rows]] = [r.documents for r in rows]
    return out


def alignment(
    docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES,
    lane_blocks: int = LANE_BLOCKS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row a document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A (a byte-level BPE) encodes a space and the text, B (a sentence-piece BPE) the text, which adds the space. The count of a pair of ids
    is the number of documents that hold it linked; ``n_best`` counts a document's links whose count is the highest of
    their A id (ties included), ``count_sum`` adds up all its links' counts. ``groups_sha256`` digests the groups as
    ``a1,a2|b1;a3|b2,b3``.

    A text that is null or empty, or whose tokens' bytes are not a space and the text in both (a character that B
    normalises), has no tokens: zeros and ''. Rows are documents of their own, also when they repeat. An empty table gives
    an empty result; other columns are ignored.

    Pairs of the same bytes are counted in vectors of the vocabulary's length, whose sum (at most |A| rows) is the
    only thing that the driver sees beside the highest count of each A id. The other pairs go as lists of a block's distinct pairs to
    hash parts, and the counts come back to the blocks. A part is cut into lanes of blocks whose pairs are added up first,
    so that a pair that every block holds lands in no single task."""
    spark, work = docs.sparkSession, Workspace(docs.sparkSession, "alignment")
    v = vocabularies(path_a, path_b)
    n_a, n_b = len(v.bytes_a), len(v.bytes_b)
    kind = _pair_type(n_a, n_b)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = work.store(rows.mapInArrow(_blocks(path_a, path_b, block_bytes), _BLOCKS), "blocks")
    vectors = blocks.where("identity is not null").select("identity")
    identity = vectors.mapInArrow(_vector, "a long, documents long").groupBy("a").agg(F.sum("documents").alias("documents"))
    identity = _by_id(identity.collect(), n_a)
    blocks = blocks.where("block is not null").drop("identity")
    size, n_blocks = blocks.agg(F.coalesce(F.sum(F.length("pairs")), F.lit(0)), F.count(F.lit(1))).first()
    lanes = max(1, -(-n_blocks // lane_blocks))
    parts = max(-(-2 * size // (part_bytes * lanes)), -(-spark.sparkContext.defaultParallelism // lanes), 1)
    dealt = blocks.select("block", "pairs", "documents").mapInArrow(
        _deal(parts, lanes, kind), "part int, lane int, block long, pairs binary, documents binary"
    )
    found = "part int, pairs binary, documents binary, width int"
    totals = dealt.select("part", "lane", "pairs", "documents", F.lit(4).alias("width"))
    totals = totals.groupBy("part", "lane").applyInPandas(_lane_totals(kind), found)
    totals = work.store(totals.groupBy("part").applyInPandas(_lane_totals(kind), found), "totals")
    highest = totals.select("pairs", "documents").mapInArrow(_best(n_b, kind), "a long, documents long")
    best = np.maximum(identity, _by_id(highest.groupBy("a").agg(F.max("documents").alias("documents")).collect(), n_a))
    copies = totals.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    answers = dealt.select("part", "lane", "block", "pairs").groupBy("part", "lane").cogroup(
        copies.select("part", "lane", "pairs", "documents").groupBy("part", "lane")
    ).applyInPandas(_answer(kind), "block long, part int, counts binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("part", "counts")).alias("answers"))
    lists = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    joined = blocks.select("block", *lists, "pairs", "entries", "which", "times").join(answers, "block", "left").drop("block")
    return joined.mapInArrow(_score(identity, best, n_b, parts, kind), _OUT)
