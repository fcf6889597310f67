"""Near-duplicate embeddings by spherical-cap filters with structured random product codes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace
from netfeat.llm.components import components

COSINE = 0.93
#: Independent codes, and the words of each half of a code: CODES * WORDS ** 2 filter directions in all.
CODES = 8
WORDS = 512
#: Mean number of filters that a random direction exceeds; sets the caps' height.
FILTERS = 56
BLOCK = 256
PACK = 4000
_SMALL = 16


class Code:
    """Directions for vectors of one dimension, the same on every worker.

    A code rotates the space at random and halves it; each half has ``WORDS`` random unit vectors, and each pair of
    them is a filter direction. Several codes even out how many filters a vector exceeds."""

    def __init__(self, dim: int):
        rng = np.random.default_rng([20, dim])
        # vectors of few dimensions are turned into a larger space, where the caps are as wide as elsewhere
        self.dim, self.half = dim, max(16, -(-dim // 2))
        self.rotations = [np.linalg.qr(rng.standard_normal((2 * self.half, 2 * self.half)))[0][:, :dim] for _ in range(CODES)]
        books = rng.standard_normal((CODES, 2, WORDS, self.half))
        self.books = books / np.linalg.norm(books, axis=3, keepdims=True)
        sample = rng.standard_normal((400, dim))
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
        halves = [(a[i], np.sort(b[i])) for r in range(min(2, CODES)) for a, b in [self._halves(sample, r)] for i in range(len(sample))]
        lo, hi = 0.0, 2.0
        for _ in range(30):
            self.height = (lo + hi) / 2
            mean = np.mean([(WORDS - np.searchsorted(b, self.height - a)).sum() for a, b in halves]) * CODES
            lo, hi = (self.height, hi) if mean > FILTERS else (lo, self.height)

    def _halves(self, units: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
        rotated = units @ self.rotations[r].T
        return rotated[:, : self.half] @ self.books[r, 0].T, rotated[:, self.half :] @ self.books[r, 1].T

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """For each unit vector all filters whose direction it exceeds by the height, sorted.

        The list decoding joins the two halves' sums: a word of the first half goes only with the words of the
        second that reach the height with it, which stand together in the sorted order."""
        found: list[list[np.ndarray]] = [[] for _ in units]
        for r in range(CODES):
            first, second = self._halves(units, r)
            for k, (a, b) in enumerate(zip(first, second)):
                some = np.flatnonzero(a >= self.height - b.max())
                order = np.argsort(-b)[: int((b >= self.height - a.max()).sum())]
                reach = np.searchsorted(-b[order], a[some] - self.height, side="right")
                found[k].extend((r * WORDS + x) * WORDS + order[:n] for x, n in zip(some.tolist(), reach.tolist()) if n)
        return [np.sort(np.concatenate(f)) if f else np.zeros(0, np.int64) for f in found]


@lru_cache(maxsize=16)
def code(dim: int) -> Code:
    return Code(dim)


def _units(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _filters(batches):
    for batch in batches:
        rows = batch.column("embedding").to_pylist()
        filters: list = [None] * len(rows)
        for dim in {len(v) for v in rows}:
            at = [k for k, v in enumerate(rows) if len(v) == dim]
            for k, f in zip(at, code(dim).decode(_units([rows[k] for k in at]))):
                filters[k] = f
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), batch.column("label"), pa.array([len(v) for v in rows], pa.int32()),
             pa.array(filters, pa.list_(pa.int32()))],
            names=["item", "label", "dim", "filters"],
        )


def _joint(filters: list[np.ndarray], below: int) -> np.ndarray:
    """Pairs that share a filter before ``below``, which count them in its bucket."""
    m = len(filters)
    earlier = [f[f < below] for f in filters]
    row = np.repeat(np.arange(m), [len(f) for f in earlier])
    used, column, count = np.unique(np.concatenate(earlier), return_inverse=True, return_counts=True)
    often = count[column] > 1
    row, (used, column) = row[often], np.unique(column[often], return_inverse=True)
    out = np.zeros((m, m), bool)
    for lo in range(0, len(used), 4096):
        here = (column >= lo) & (column < lo + 4096)
        matrix = np.zeros((m, min(4096, len(used) - lo)), np.float32)
        matrix[row[here], column[here] - lo] = 1
        out |= (matrix @ matrix.T) > 0
    return out


def _verify(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of a unit's buckets. Small buckets are first screened together, so that only those that hold a
    link are looked at one by one."""
    dims = pdf["embedding"].map(len)
    if dims.nunique() > 1:
        return pd.concat([_verify(part, cosine) for _, part in pdf.groupby(dims)])
    pdf = pdf.drop_duplicates(["bucket", "item"]).sort_values("bucket", ignore_index=True)
    position, items = pd.factorize(pdf["item"])
    unit = _units(pdf["embedding"].iloc[np.unique(position, return_index=True)[1]])
    bucket = pdf["bucket"].to_numpy()
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    size = np.diff(np.append(first, len(bucket)))
    number = np.repeat(np.arange(len(first)), size)
    promising = size > _SMALL
    for d in range(1, min(_SMALL, len(bucket))):
        k = np.flatnonzero((bucket[d:] == bucket[:-d]) & ~promising[number[:-d]])
        for lo in range(0, len(k), 4096):
            part = k[lo : lo + 4096]
            dot = np.einsum("ij,ij->i", unit[position[part]], unit[position[part + d]])
            promising[number[part[dot >= cosine - 1e-9]]] = True
    out = []
    for b in np.flatnonzero(promising & (size > 1)).tolist():
        rows = slice(int(first[b]), int(first[b] + size[b]))
        g, own = pdf.iloc[rows], unit[position[rows]]
        linked = own @ own.T >= cosine
        np.fill_diagonal(linked, False)
        if g["i"].iat[0] != g["j"].iat[0]:
            block = g["block"].to_numpy()
            linked &= block[:, None] != block[None, :]
        some = np.flatnonzero(linked.any(axis=1))
        if not len(some):
            continue
        g, linked = g.iloc[some], linked[np.ix_(some, some)]
        linked &= ~_joint([np.asarray(f) for f in g["filters"]], int(g["filter"].iat[0]))
        label = np.arange(len(g))
        while True:
            low = np.minimum(label, np.where(linked, label[None, :], len(g)).min(axis=1))
            low = low[low]
            if (low == label).all():
                break
            label = low
        item, some = g["item"].to_numpy(), linked.any(axis=1)
        out.append(
            pd.DataFrame({"item": item[some], "parent": item[label[some]], "links": (linked @ g["weight"].to_numpy())[some]})
        )
    return pd.concat(out) if out else pd.DataFrame({"item": [], "parent": [], "links": []}, dtype="int64")


def _usable(embedding: str) -> Column:
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_embeddings(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row a vector: (vec_id, n_links, component_id, kept).

    Vectors of equal labels and dimensions are compared when they exceed a common filter direction, and
    linked when their cosine in double precision is ``cosine`` or more. Equal vectors of a label are one item
    throughout; ``n_links`` counts them as linked. A large bucket is cut into blocks, and
    each pair of blocks is a unit of work; a pair counts in the first of its common filters only.

    A vector that is null, empty, zero or has a null or non-finite component, and one of a null label, links
    with nothing. Component ids are the smallest id that links reach, null ids aside. Rows that repeat an id
    are vectors of their own. An empty table gives an empty result; other columns are ignored."""
    work = Workspace(vectors.sparkSession, "caps")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))
    good = F.col("label").isNotNull() & _usable("embedding")
    rows = rows.withColumn("item", F.when(good, F.xxhash64(F.col("label").cast("string"), "embedding")))
    items = rows.where("item is not null").groupBy("item").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"),
        F.first(F.col("label").cast("string")).alias("label"), F.first("embedding").alias("embedding"),
    )
    items = work.store(items, "items")
    decoded = items.select("item", "label", "embedding").mapInArrow(
        _filters, "item long, label string, dim int, filters array<int>"
    )
    decoded = work.store(decoded, "filters")
    entries = decoded.select("item", "label", "dim", F.explode("filters").alias("filter"))
    entries = entries.select("item", "filter", F.xxhash64("label", "dim", "filter").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = work.store(sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    large = F.col("blocks") > 1
    placed = entries.join(sizes.drop("size"), "bucket").withColumn(
        "block", F.when(large, F.pmod(F.xxhash64("item"), F.col("blocks"))).otherwise(0).cast("int")
    )
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "item", "bucket", "filter", "block", large.alias("large"),
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(large, F.col("bucket")).otherwise(F.pmod(F.xxhash64("bucket"), F.lit(max(1, -(-total // PACK))))).alias("unit"),
    )
    units = units.join(items.select("item", "embedding", "weight").join(decoded.select("item", "filters"), "item"), "item")
    found = units.groupBy("large", "unit", "i", "j").applyInPandas(
        lambda pdf: _verify(pdf, cosine), "item long, parent long, links long"
    )
    found = work.store(found, "links")
    classes = components(found.select(F.col("item").alias("a"), F.col("parent").alias("b")), work)
    named = items.select("item", "first_id", "weight").join(classes.withColumnRenamed("id", "item"), "item", "left")
    named = named.withColumn("class", F.coalesce("component", "item")).drop("component")
    smallest = named.groupBy("class").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "class").join(found.groupBy("item").agg(F.sum("links").alias("links")), "item", "left")
    return rows.select("vec_id", "item").join(named, "item", "left").select(
        "vec_id",
        F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
