"""MinHash banding shared by the n-gram join and the paragraph deduplication.

An *item* is a distinct shingle set, named by a 64-bit hash of the set; copies are one item.
Candidates come from a shuffle on band hashes; groups of candidates are then verified on the
full shingle sets."""

from __future__ import annotations

from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netfeat.llm.common import Workspace
from netfeat.llm.components import components, hub_join, hubs

#: A group beyond so many items, or so many bytes of sets, is cut into blocks.
BLOCK = 8192
BLOCK_BYTES = 16 << 20
#: Items that are compared at once inside a task.
TILE = 256


def choose_bands(threshold: float, recall: float, rows: int) -> int:
    """The fewest bands of ``rows`` rows that find a pair at ``threshold`` with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows))))


def candidate_groups(items: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``items`` (item, keys: array of band hashes) -> (item, grp) for items that share a bucket.

    A bucket links its members to its smallest item (as many links as members, never all
    pairs); groups are the components of these links, so that every pair of items with a
    common bucket lies in one group. A frequent bucket is one combined row a task in the
    aggregation, and salted in the join."""
    keys = items.select("item", F.explode("keys").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("item").alias("lo"), F.max("item").alias("hi"), F.count(F.lit(1)).alias("n"))
    buckets = work.store(buckets.where("lo < hi").drop("hi"), f"{name}-buckets")
    links = hub_join(keys, "key", buckets.select("key", "lo"), hubs(buckets, "key", "n")).where("item > lo")
    found = components(links.select(F.col("item").alias("a"), F.col("lo").alias("b")), work, name)
    return found.select(F.col("id").alias("item"), F.col("component").alias("grp"))


class _Roots:
    """Union-find over positions; the smallest position names a class."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def union(self, a: int, b: int) -> None:
        p = self.parent
        while p[a] != a:
            p[a] = p[p[a]]
            a = p[a]
        while p[b] != b:
            p[b] = p[p[b]]
            b = p[b]
        p[max(a, b)] = min(a, b)

    def flat(self) -> np.ndarray:
        while True:
            after = self.parent[self.parent]
            if (after == self.parent).all():
                return after
            self.parent = after


class _Tile(NamedTuple):
    """Some sets of a group as the positions of their shared shingles."""

    at: np.ndarray  # positions in the group
    sizes: np.ndarray
    row: np.ndarray
    column: np.ndarray  # sorted


def _tiles(sets: list[np.ndarray], order: np.ndarray) -> list[_Tile]:
    """Tiles of ``order``. A shingle of one set only cannot be common and is left out."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    first = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    for lo in range(0, len(order), TILE):
        at = order[lo : lo + TILE]
        where = np.concatenate([np.arange(first[k], first[k + 1]) for k in at.tolist()])
        row = np.repeat(np.arange(len(at)), sizes[at])
        keep = shared[where]
        row, col = row[keep], column[where[keep]]
        by = np.argsort(col, kind="stable")
        out.append(_Tile(at, sizes[at], row[by], col[by]))
    return out


def _common(a: _Tile, b: _Tile) -> np.ndarray:
    """How many shingles each set of ``a`` shares with each of ``b``."""
    out = np.zeros((len(a.at), len(b.at)), np.float64)
    columns = np.intersect1d(a.column, b.column)
    for lo in range(0, len(columns), 4096):  # a bounded slice of the incidence matrices at a time
        part = columns[lo : lo + 4096]
        dense = []
        for t in (a, b):
            i, j = np.searchsorted(t.column, (part[0], part[-1] + 1))
            place = np.searchsorted(part, t.column[i:j])
            held = part[place] == t.column[i:j]
            matrix = np.zeros((len(t.at), len(part)), np.float32)
            matrix[t.row[i:j][held], place[held]] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out.astype(np.int64)


def _link(sets: list[np.ndarray], weight: np.ndarray, ratio: Fraction, side: np.ndarray | None = None):
    """(links, root) of each set: the summed weight of the sets with a Jaccard similarity of at least ``ratio``,
    exactly, and the smallest position that such links reach. With ``side``, only pairs across the two sides count.

    Sets are compared a tile at a time in order of size, tiles of too different sizes never; what is kept
    is a count and a root a set, whatever the number of pairs."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    if side is None:
        tiles = _tiles(sets, order)
        pairs = [(i, j) for j in range(len(tiles)) for i in range(j + 1)]
    else:
        left, right = _tiles(sets, order[~side[order]]), _tiles(sets, order[side[order]])
        tiles = left + right
        pairs = [(i, len(left) + j) for i in range(len(left)) for j in range(len(right))]
    links, roots = np.zeros(len(sets), np.int64), _Roots(len(sets))
    for i, j in pairs:
        a, b = tiles[i], tiles[j]
        least = max(a.sizes[0], b.sizes[0])
        if ratio * int(least) > int(min(a.sizes[-1], b.sizes[-1])):
            continue  # the smaller of any two sets is too small
        common = _common(a, b)
        union = a.sizes[:, None] + b.sizes[None, :] - common
        linked = common * ratio.denominator >= ratio.numerator * union
        if i == j:
            np.fill_diagonal(linked, False)
        if not linked.any():
            continue
        links[a.at] += linked @ weight[b.at]
        if i != j:
            links[b.at] += linked.T @ weight[a.at]
        before_a, before_b = a.at.copy(), b.at.copy()
        x, y = before_a, before_b
        while True:  # the smallest position within the tile's links
            after_x = np.minimum(x, np.where(linked, y[None, :], len(sets)).min(axis=1))
            after_y = np.minimum(y, np.where(linked, after_x[:, None], len(sets)).min(axis=0))
            if (after_x == x).all() and (after_y == y).all():
                break
            x, y = after_x, after_y
        for old, new in ((before_a, x), (before_b, y)):
            for p, q in zip(old[old != new].tolist(), new[old != new].tolist()):
                roots.union(p, q)
    return links, roots.flat()


def _verify_group(pdf: pd.DataFrame, ratio: Fraction) -> pd.DataFrame:
    pdf = pdf.drop_duplicates("item")
    out = []
    for _, g in pdf.groupby("grp", sort=False):
        if len(g) < 2:
            continue
        item, weight, block = g["item"].to_numpy(), g["weight"].to_numpy(), g["block"].to_numpy()
        i, j = g["i"].iat[0], g["j"].iat[0]
        if i != j and (block == block[0]).all():
            continue
        # pairs within a block are another unit's
        links, root = _link([np.frombuffer(s, np.uint64) for s in g["shingles"]], weight, ratio, block == j if i != j else None)
        some = links > 0
        out.append(pd.DataFrame({"item": item[some], "parent": item[root[some]], "links": links[some]}))
    out = pd.concat(out) if out else pd.DataFrame({"item": [], "parent": [], "links": []}, dtype="int64")
    return out.assign(large=bool(pdf["large"].iat[0]))


def verified(sets: DataFrame, work: Workspace, name: str, ratio: Fraction = Fraction(4, 5)) -> DataFrame:
    """``sets`` (grp, item, shingles: sorted uint64 as binary, weight) ->
    (item, class, links): for every linked item an item that names what links reach and the
    summed weight of the items linked to it directly.

    A link is a pair in one group with a Jaccard similarity of at least ``ratio`` on the full sets,
    whether or not the two share a band. A group is one unit of work and gives one row an item,
    with its link count and its root. Only a group of more than ``BLOCK`` items or ``BLOCK_BYTES`` of sets is cut into
    blocks; then each pair of blocks is a unit, so that no task holds the whole group, and an item
    gives a row for each block that holds something linked to it. Small groups share units by their bytes."""
    sizes = sets.groupBy("grp").agg(F.count(F.lit(1)).alias("size"), F.sum(F.length("shingles")).alias("bytes"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("bytes") / BLOCK_BYTES)).cast("int")
    sizes = work.store(sizes.withColumn("blocks", F.greatest(blocks, F.lit(1))), f"{name}-sizes")
    shares = F.greatest(F.col("size") / BLOCK, F.col("bytes") / BLOCK_BYTES)
    total = sizes.where("blocks = 1").agg(F.coalesce(F.sum(shares), F.lit(0.0))).first()[0]
    units = max(int(np.ceil(total)), sets.sparkSession.sparkContext.defaultParallelism)
    spread = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("item"), F.col("blocks"))).otherwise(0).cast("int")
    placed = sets.join(sizes.select("grp", "blocks"), "grp").withColumn("block", spread)
    units = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", "item", "shingles", "weight", "block",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        F.when(F.col("blocks") > 1, F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(units))).alias("unit"),
        (F.col("blocks") > 1).alias("large"),
    )
    found = units.groupBy("large", "unit", "i", "j").applyInPandas(
        lambda pdf: _verify_group(pdf, ratio), "item long, parent long, links long, large boolean"
    )
    found = work.store(found, f"{name}-links")
    # a small group's classes are complete; those of a large one meet across its blocks
    blocks = found.where("large")
    classes = components(blocks.select(F.col("item").alias("a"), F.col("parent").alias("b")), work, f"{name}-classes")
    merged = blocks.groupBy("item").agg(F.sum("links").alias("links")).join(
        classes.select(F.col("id").alias("item"), F.col("component").alias("class")), "item"
    )
    return found.where("not large").select("item", F.col("parent").alias("class"), "links").unionByName(
        merged.select("item", "class", "links")
    )
