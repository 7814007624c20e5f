"""Compressed vector codes: integer Lloyd rounds over partition-local cover trees.

Components become integers, a vector is cut into equal consecutive parts, and each part position has
a codebook that starts as the parts of the first kept vectors. Every block of rows gets one cover
tree for each part position, built once and stored: a node is a point, covers its descendants within
a radius, and the points of a subtree lie side by side, so running sums give the sum of any subtree.
A round walks the trees from the roots, level by level. If by the triangle inequality no other entry
can be nearest to any point of a subtree, the whole subtree is assigned at once and its sum is added;
only the children of ambiguous nodes are looked at, and a node's own point is always compared
exactly. No point is compared twice in a round. Tasks add up their blocks and hand on one row for
each entry; the driver sees the codebooks alone, whose size is a parameter.

Defined cases: vectors that are null or hold null or non-finite components are left out; an empty
vector has distance 0 to everything; vectors shorter than the longest one, and lengths that the parts
do not divide, are filled up with zeros; integers beyond what distances in 64 bits allow are held at that
bound (about 2**28 for 16 components); with fewer kept rows than entries the codebooks have as many entries as
there are rows; rows with equal vec_id are ordered by their components, null vec_ids come last; null
labels are one label; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Stored

BLOCK_ROWS = 4096
LEAF = 12  # a node with at most so many points below it is not split further


# ---- cover trees -------------------------------------------------------------------------------------


@dataclass
class Tree:
    """A cover tree in depth-first order: node i's subtree is the ``size[i]`` nodes from i on."""

    points: np.ndarray
    order: np.ndarray  # row of the block that each node is
    parent: np.ndarray
    size: np.ndarray
    radius: np.ndarray


def lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b).astype(np.float64) ** 2).sum(axis=1))


def build(points: np.ndarray) -> Tree:
    """Halve the radius again and again; points outside their node's ball become nodes of their own.

    All nodes of a level choose their next centre together, so the steps of a level are as many as the
    most children a node gets.
    """
    n = len(points)
    home, parent, radius = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    centre = np.zeros(n, bool)
    centre[0] = True
    far = lengths(points, points[:1])
    radius[0] = scale = far.max()
    while True:
        crowded = np.bincount(home, minlength=n)[home] > LEAF
        if not (crowded & (far > 0)).any():
            break
        scale /= 2
        loose = np.flatnonzero(crowded & (far > scale))
        while len(loose):
            was = home[loose]
            groups, first, member = np.unique(was, return_index=True, return_inverse=True)
            new = loose[first]
            parent[new], centre[new] = groups, True
            distance = lengths(points[loose], points[new[member]])
            near = distance <= scale
            home[loose[near]] = new[member[near]]
            far[loose[near]] = distance[near]
            np.maximum.at(radius, home[loose[near]], distance[near])
            loose = loose[~near]
    leaves = np.flatnonzero(~centre)
    parent[leaves] = home[leaves]
    return in_depth_first_order(points, parent, radius)


def in_depth_first_order(points: np.ndarray, parent: np.ndarray, radius: np.ndarray) -> Tree:
    n = len(points)
    depth, level = np.zeros(n, np.int64), np.flatnonzero(parent < 0)
    levels = [level]
    by_parent = np.argsort(parent, kind="stable")
    begin = np.searchsorted(parent[by_parent], np.arange(n + 1))
    while len(level):
        counts = begin[level + 1] - begin[level]
        at = np.repeat(begin[level] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        level = by_parent[at]
        depth[level] = len(levels)
        levels.append(level)
    size = np.ones(n, np.int64)
    for level in reversed(levels[1:]):
        np.add.at(size, parent[level], size[level])
    place = np.zeros(n, np.int64)
    for level in levels[1:]:
        if len(level):
            own = parent[level]  # children of one parent stand together
            ends = np.cumsum(size[level])
            first = np.concatenate([[True], own[1:] != own[:-1]])
            before = np.maximum.accumulate(np.where(first, ends - size[level], 0))
            place[level] = place[own] + 1 + ends - size[level] - before
    order = np.argsort(place)
    where = np.where(parent[order] < 0, -1, place[parent[order]])
    return Tree(points[order], order, where, size[order], radius[order])


class Codebook:
    """Entries of one part position; distances are exact integers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.norms = (entries**2).sum(axis=1)

    def squares(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of points (rows) to entries (columns)."""
        width = max(points.shape[1], 1)
        top = max(int(np.abs(points).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        if width * (2 * top) ** 2 < 1 << 53:  # floating-point products are exact then
            cross = (points.astype(np.float64) @ self.entries.T.astype(np.float64)).astype(np.int64)
            return (points**2).sum(axis=1)[:, None] - 2 * cross + self.norms
        out = np.zeros((len(points), len(self.entries)), np.int64)
        for k in range(points.shape[1]):
            out += (points[:, k : k + 1] - self.entries[:, k]) ** 2
        return out


def assign(tree: Tree, book: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first node, nodes, entry) of stretches of one entry, in order, that cover the whole tree."""
    n = len(tree.points)
    entry, whole = np.full(n, -1, np.int64), np.zeros(n, bool)
    by_parent = np.argsort(tree.parent, kind="stable")
    begin = np.searchsorted(tree.parent[by_parent], np.arange(n + 1))
    level = np.zeros(1, np.int64)
    while len(level):
        squares = book.squares(tree.points[level])
        best = squares.argmin(axis=1)  # the lower index at ties
        entry[level] = best
        rows = np.arange(len(level))
        nearest = np.sqrt(squares[rows, best].astype(np.float64))
        squares[rows, best] = np.iinfo(np.int64).max
        second = np.sqrt(squares.min(axis=1).astype(np.float64))
        # d(p, c) is within the radius of the centre's distance; the margin covers rounding.
        sure = second - nearest > 2 * tree.radius[level] * (1 + 1e-9) + 1e-6 * (1 + nearest)
        whole[level] = sure | (tree.radius[level] == 0)
        open_ = level[~whole[level]]
        counts = begin[open_ + 1] - begin[open_]
        at = np.repeat(begin[open_] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        level = by_parent[at]
    first = np.flatnonzero(entry >= 0)
    return first, np.where(whole[first], tree.size[first], 1), entry[first]


# ---- blocks as stored rows -----------------------------------------------------------------------------

# The trees of a block stand in one row, part after part, so that its codes come from one place.
TREE = {"points": "<i4", "order": "<i4", "parent": "<i4", "size": "<i4", "radius": "<f8"}
BLOCKS = "vec_ids array<bigint>, labels array<string>, " + ", ".join(f"`{c}` binary" for c in TREE)


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label as text, and the integer components of the vectors that take part."""
    kept = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = lambda x: F.greatest(F.lit(-(2.0**40)), F.least(F.lit(2.0**40), x * float(scale)))
    kept = kept.where(F.col("v").isNotNull() & F.coalesce(whole, F.lit(False)))
    return kept.select("vec_id", "label", F.transform("v", lambda x: F.floor(held(x)).cast("bigint")).alias("v"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Integer lists as the rows of a matrix, filled up with zeros."""
    offsets = lists.offsets.to_numpy()
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def make_blocks(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """One row for each block of rows, with a tree for each part position."""
    limit = bound(width)

    def block(piece: pa.RecordBatch) -> pa.RecordBatch:
        values = np.clip(matrix(piece.column("v"), width * parts), -limit, limit)
        built = [build(np.ascontiguousarray(values[:, p * width : (p + 1) * width])) for p in range(parts)]
        columns = [pa.array([piece.column(c).to_pylist()], t) for c, t in (("vec_id", pa.list_(pa.int64())), ("label", pa.list_(pa.string())))]
        for name, kind in TREE.items():
            columns.append(pa.array([b"".join(getattr(t, name).astype(kind).tobytes() for t in built)], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, ["vec_ids", "labels", *TREE])

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                yield block(batch.slice(begin, BLOCK_ROWS))

    return rows.mapInArrow(run, BLOCKS)


def stored_trees(batches, parts: int) -> Iterator[tuple[pa.RecordBatch, list[Tree]]]:
    """The blocks of stored batches, one at a time: the row and its trees by part."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            read = {c: np.frombuffer(row.column(c)[0].as_py(), dtype=kind).reshape(parts, -1) for c, kind in TREE.items()}
            many = read["order"].shape[1]
            points = read["points"].astype(np.int64).reshape(parts, many, -1)
            others = [read[c].astype(np.int64) for c in ("order", "parent", "size")]
            yield row, [Tree(points[p], *(o[p] for o in others), read["radius"][p]) for p in range(parts)]


def bound(width: int) -> int:
    """Largest integer whose squared distances over ``width`` components stay within 64 bits."""
    return min(isqrt((1 << 60) // max(width, 1)), (1 << 31) - 1)


# ---- rounds --------------------------------------------------------------------------------------------


def sums(blocks: DataFrame, books: list[np.ndarray]) -> dict:
    """(part, entry) -> (component sums, points) over all blocks."""
    entries, width = books[0].shape

    def run(batches):
        found = [Codebook(b) for b in books]
        totals, counts = np.zeros((len(books), entries, width), np.int64), np.zeros((len(books), entries), np.int64)
        for _, built in stored_trees(batches, len(books)):
            for part, tree in enumerate(built):
                first, many, entry = assign(tree, found[part])
                running = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(tree.points, axis=0)])
                np.add.at(totals[part], entry, running[first + many] - running[first])
                np.add.at(counts[part], entry, many)
        part, entry = np.nonzero(counts)
        flat = pa.array(totals[part, entry].reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), flat)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), lists, pa.array(counts[part, entry])], ["part", "entry", "total", "n"])

    rows = blocks.mapInArrow(run, "part bigint, entry bigint, total array<bigint>, n bigint")
    added = F.array(*[F.sum(F.get("total", F.lit(k))) for k in range(width)]).cast("array<bigint>")
    rows = rows.groupBy("part", "entry").agg(added.alias("total"), F.sum("n").alias("n"))
    return {(r.part, r.entry): (r.total, r.n) for r in rows.collect()}  # one row for each entry


def refine(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One round: every used entry moves to the floor of its points' mean."""
    out = [b.copy() for b in books]
    for (part, entry), (total, n) in sums(blocks, books).items():
        out[part][entry] = [x // n for x in total]  # towards minus infinity
    return out


def codes(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of every row."""

    def run(batches):
        found = [Codebook(b) for b in books]
        for row, built in stored_trees(batches, len(books)):
            chosen, error = [], np.zeros(len(built[0].order), np.int64)
            for part, tree in enumerate(built):
                _, many, entry = assign(tree, found[part])
                at, own = np.repeat(entry, many), np.zeros(len(tree.order), np.int64)
                own[tree.order] = at
                error[tree.order] += ((tree.points - found[part].entries[at]) ** 2).sum(axis=1)
                chosen.append(own.tolist())
            text = ["".join(f"{x:02x}" for x in r) for r in zip(*chosen, strict=True)]
            columns = [row.column(c).flatten() for c in ("vec_ids", "labels")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(text), pa.array(error)], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, "vec_id bigint, label string, code string, error bigint")


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of all rows that take part (vec_id, label, code, error) and the codebooks by part."""
    rows = Stored(integers(vectors, scale), "vectors")
    longest = rows.df.agg(F.max(F.size("v"))).first()[0]
    width = -(-(longest or 0) // parts)
    firsts = rows.df.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    start = np.zeros((len(firsts), width * parts), np.int64)
    for k, r in enumerate(firsts):
        start[k, : len(r.v)] = np.clip(r.v, -bound(width), bound(width))
    books = [start[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    if not firsts:
        none = rows.df.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return none, books
    blocks = Stored(make_blocks(rows.df, width, parts), "cover-trees").df
    rows.drop()
    for _ in range(rounds):
        books = refine(blocks, books)
    return codes(blocks, books), books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def report(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for every row that takes part."""
    coded, books = compress(vectors, **settings)
    coded = Stored(coded, "codes").df
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    rows = coded.join(totals, F.col("label").eqNullSafe(F.col("_label")), "inner")
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
