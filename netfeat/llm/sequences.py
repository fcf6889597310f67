"""Token ids in Arrow files of equal-length sequences with masks, for random access without copies.

A data set is a folder of shards. A shard is a pair of Arrow IPC files: the sequences, in record batches of two
fixed-size-list columns (``ids``: uint16 if the vocabulary fits, else uint32; ``mask``: boolean, true for an id and false for
the padding after the last one), and the index of the documents (``doc_id``, ``start``: ids before it in the shard, ``n_tokens``). Documents lie end to end in the order of
their ids, across sequences and batches, and never across shards. All values of a column are one buffer a batch, so a
memory-mapped sequence is an array on the mapped file."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace, text_slices
from netfeat.llm.tokens import MEMO, tokenizer

LENGTH = 2048
#: Sequences of a record batch: 1 or 2 MB of ids and 64 KB of masks.
BATCH = 256
#: A shard ends with the document that brings it to so many ids.
SHARD_TOKENS = 1 << 24
#: Text of a task that writes, about; its ids may fill more than one shard.
TASK_BYTES = 64 << 20
_INDEX_ROWS = 1 << 16

_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_MANIFEST = "part int, shard int, sequences_file string, index_file string, n_documents long, n_sequences long, n_tokens long"


def _schema(length: int, kind: str) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(np.dtype(kind)), length)), ("mask", pa.list_(pa.bool_(), length))])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), unquote(urlparse(path).path)
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class ShardWriter:
    """Writes one shard. Holds one record batch and one piece of the index, however large the shard is."""

    def __init__(self, folder: str, name: str, length: int, batch: int, kind: str = "<u4"):
        if length % 8:
            raise ValueError(f"length {length}: the masks of sequences are whole bytes, so it must be a multiple of 8")
        self.length, self.schema = length, _schema(length, kind)
        self.fs, base = _open(folder)
        self.fs.create_dir(base, recursive=True)
        self.names = [f"{name}.sequences.arrow", f"{name}.documents.arrow"]
        self.paths = [f"{base}/{n}" for n in self.names]
        self.sinks = [self.fs.open_output_stream(p) for p in self.paths]
        self.writers = [pa.ipc.new_file(s, schema) for s, schema in zip(self.sinks, (self.schema, _INDEX))]
        self.ids = np.zeros(batch * length, kind)
        self.fill = self.n_tokens = self.n_documents = self.n_sequences = 0
        self.index: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index.append((doc_id, self.n_tokens, len(ids)))
        self.n_tokens += len(ids)
        self.n_documents += 1
        if len(self.index) == _INDEX_ROWS:
            self._write_index()
        while len(ids):
            part = ids[: len(self.ids) - self.fill]
            self.ids[self.fill : self.fill + len(part)] = part
            self.fill += len(part)
            ids = ids[len(part) :]
            if self.fill == len(self.ids):
                self._write_batch()

    def _write_index(self) -> None:
        columns = zip(*self.index) if self.index else ([], [], [])
        self.writers[1].write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_INDEX))
        self.index = []

    def _write_batch(self) -> None:
        n = -(-self.fill // self.length)
        ids, mask = self.ids[: n * self.length].copy(), np.ones(n * self.length, bool)
        ids[self.fill :] = 0
        mask[self.fill :] = False
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.length) for v in (ids, mask)]
        self.writers[0].write_batch(pa.record_batch(columns, schema=self.schema))
        self.n_sequences += n
        self.fill = 0

    def close(self) -> None:
        if self.fill:
            self._write_batch()
        if self.index:
            self._write_index()
        for f in (*self.writers, *self.sinks):
            f.close()

    def discard(self) -> None:
        """After a failure: no half-written shard stays."""
        for sink, path in zip(self.sinks, self.paths):
            sink.close()
            self.fs.delete_file(path)


def unpacked(mask: np.ndarray) -> np.ndarray:
    """The mask of a sequence, 0 or 1 a place."""
    return np.unpackbits(mask, bitorder="little")


def id_type(vocabulary: str, end: int) -> str:
    """The smallest of uint16 and uint32 that holds all ids of a vocabulary."""
    import tokenizers

    highest = max([end, *tokenizers.Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True).values()])
    return "<u2" if highest < 1 << 16 else "<u4"


class Shard:
    """Reads one shard. On a local file system the arrays are views of the memory-mapped file."""

    def __init__(self, sequences_path: str, index_path: str):
        self.files = []
        for path in (sequences_path, index_path):
            fs, place = _open(path)
            local = isinstance(fs, pafs.LocalFileSystem)
            self.files.append(pa.memory_map(place) if local else fs.open_input_file(place))
        self.sequences, self.index = (pa.ipc.open_file(f) for f in self.files)
        self.length = self.sequences.schema.field("ids").type.list_size
        self.batch = self.sequences.get_batch(0).num_rows if self.sequences.num_record_batches else 1
        self._held: tuple[int, pa.RecordBatch] | None = None

    def _columns(self, k: int) -> pa.RecordBatch:
        if self._held is None or self._held[0] != k:
            self._held = (k, self.sequences.get_batch(k))
        return self._held[1]

    def _values(self, k: int) -> np.ndarray:
        return self._columns(k).column("ids").values.to_numpy(zero_copy_only=True)

    def __len__(self) -> int:
        n = self.sequences.num_record_batches
        return (n - 1) * self.batch + self._columns(n - 1).num_rows if n else 0

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of the k-th sequence, whatever was read before it; the mask as Arrow keeps booleans, eight to
        a byte (``unpacked`` gives one a place)."""
        batch, row = divmod(k, self.batch)
        lo, size = row * self.length, self.length // 8
        bits = np.frombuffer(self._columns(batch).column("mask").values.buffers()[1], np.uint8)
        return self._values(batch)[lo : lo + self.length], bits[row * size : (row + 1) * size]

    def tokens(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, as one view for each record batch that they touch."""
        size = self.batch * self.length
        while n > 0:
            batch, lo = divmod(start, size)
            part = self._values(batch)[lo : min(lo + n, size)]
            yield part
            start += len(part)
            n -= len(part)

    def documents(self) -> Iterator[pa.RecordBatch]:
        """The index: (doc_id, start, n_tokens), in order."""
        for k in range(self.index.num_record_batches):
            yield self.index.get_batch(k)

    def close(self) -> None:
        self._held = None
        for f in self.files:
            f.close()


def _writer(folder: str, encode: Callable[[], Callable[[list[str]], list[bytes]]], end: int, length: int, batch: int, limit: int, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt, last = TaskContext.get().partitionId(), uuid.uuid4().hex, np.array([end], "<u4")
        ids_of, shard, rows = encode(), None, []

        def finish() -> None:
            shard.close()
            rows.append((part, len(rows), *shard.names, shard.n_documents, shard.n_sequences, shard.n_tokens))

        try:
            for whole in batches:
                for texts, piece in text_slices(whole, "text"):
                    for doc_id, raw in zip(piece.column("doc_id").to_pylist(), ids_of(texts)):
                        if shard is None:
                            shard = ShardWriter(folder, f"part-{part:05d}-{len(rows):03d}-{attempt}", length, batch, kind)
                        shard.add(doc_id, np.concatenate([np.frombuffer(raw, "<u4"), last]))
                        if shard.n_tokens >= limit:
                            finish()
                            shard = None
            if shard is not None:
                finish()
        except BaseException:
            if shard is not None:
                shard.discard()
            raise
        names = [c.split()[0] for c in _MANIFEST.split(", ")]
        types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return run


def write_sequences(
    docs: DataFrame, vocabulary: str, work: Workspace, end: int = 1, length: int = LENGTH, batch: int = BATCH,
    shard_tokens: int = SHARD_TOKENS, task_bytes: int = TASK_BYTES, memo: int = MEMO,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the ids of all texts as shards into ``work``; the stored manifest, a row a shard:
    (part, shard, the two files, n_documents, n_sequences, n_tokens).

    The texts move once, by ranges of the id, so that the shards in the order of (part, shard) hold the documents in the order of
    their ids (null last). A row number breaks ties, so many rows of one id are dealt to several tasks. Tasks
    write files of their own names; only those in the manifest, which Spark commits, belong to the data set, so
    a task may run twice."""
    number = F.monotonically_increasing_id()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), number.alias("number"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(-(-size // task_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    order = F.col("doc_id").isNull(), F.col("doc_id"), F.col("number")
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    folder = f"{work.path}/shards"
    write = _writer(folder, lambda: tokenizer(vocabulary, memo).encode, end, length, batch, shard_tokens, id_type(vocabulary, end))
    return work.store(rows.mapInArrow(write, _MANIFEST), "manifest")


def _reader(folder: str):
    """(doc_id, start in the data set, n_tokens, ids_crc32) of each document of each shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            shard = Shard(f"{folder}/{row['sequences_file']}", f"{folder}/{row['index_file']}")
            for index in shard.documents():
                crc = []
                for start, n in zip(index.column("start").to_pylist(), index.column("n_tokens").to_pylist()):
                    c = 0
                    for part in shard.tokens(start, n):
                        c = zlib.crc32(part.astype("<u4"), c)
                    crc.append(c)
                start = pa.array(index.column("start").to_numpy() + row["before"])
                columns = [index.column("doc_id"), start, index.column("n_tokens"), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
            shard.close()

    return run


def read_documents(manifest: DataFrame, work: Workspace) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    ``start`` counts the ids of all documents before it: those of the shards before its own, a running sum over the manifest's
    rows (one for some 16 million ids), and the index's within the shard."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.withColumn("before", before)
    tasks = manifest.agg(F.count(F.lit(1))).first()[0]
    return shards.repartition(max(tasks, 1)).mapInArrow(
        _reader(f"{work.path}/shards"), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_sequences(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write ``docs`` as Arrow sequences and read them back: (doc_id, start, n_tokens, ids_crc32) a document.

    Every document ends with the end id, so a null, empty or wordless text has one id. Documents are in the order
    of their ids, null ids last; rows of one id, repeated rows too, are documents of their own in the order
    of the table's rows. An empty table gives no shards and an empty result; other columns are ignored.
    The files lie in the shared folder until its owner deletes them."""
    work = Workspace(docs.sparkSession, "sequences")
    return read_documents(write_sequences(docs, vocabulary, work, **options), work)
