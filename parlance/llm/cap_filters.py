"""Near duplicates among embeddings by spherical-cap filters from random product codes.

The sphere is covered by many random directions; a vector belongs to every direction with which it
has at least a certain inner product (a cap). Directions are built from two codes of random unit
vectors, one for each half of the (randomly rotated) coordinates: every pair of code words is a
direction, and all exceeding pairs of a vector are listed from its two sorted lists of products
without trying all. Vectors that share a direction are compared exactly in double precision.

A code has as many directions as let a cap hold ``OCCUPANCY`` vectors of the largest label; its height is
measured so that a vector lies in ``FILTERS`` caps, and the whole is repeated with independent
rotations until a pair at the threshold shares a cap with probability ``RECALL``: the number of
repetitions follows from the share of planted pairs that one repetition finds, at the given number of
vectors, dimension and threshold. Directions with many vectors are compared tile by tile (``TILE``
vectors a side), every pair of tiles being a group of its own; none is cut.

A pair is counted in the first cap that holds both, so nothing has to be made distinct. A group of
tiles gives one row for each linked vector, with the links counted there and the smallest vector
it is connected to inside the group; pairs are never written.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and rows with a
null label or null vec_id, link with nothing and are their own component; vectors of different
lengths are never compared; equal vectors are compared once and count as linked to each other;
repeated rows count as several vectors; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Stored
from parlance.llm.components import components

FILTERS = 10
OCCUPANCY = 256
TILE = 512
COLUMNS = 4096
RECALL = 0.998
TRIALS, TRIAL_CODES = 256, 8


def usable(vector: Column) -> Column:
    """True for vectors with finite components only and a length above zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class ProductCode:
    """Two codes over the halves of rotated vectors, and the height of the caps."""

    def __init__(self, dimension: int, words: int, height: float, seed: int, repetition: int):
        rng = np.random.default_rng([seed, dimension, repetition])
        self.rotation, _ = np.linalg.qr(rng.standard_normal((dimension, dimension)))
        self.half = (dimension + 1) // 2
        self.codes = []
        for size in (self.half, dimension - self.half):
            code = rng.standard_normal((words, max(size, 1)))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True))
        self.height, self.words = height, words

    def _products(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inner products with the left words, with the right words in falling order, and that order."""
        turned = vectors @ self.rotation
        left = turned[:, : self.half] @ self.codes[0].T
        right = turned[:, self.half :] @ self.codes[1].T if vectors.shape[1] > 1 else np.zeros((len(vectors), self.words))
        order = np.argsort(-right, axis=1)
        return left, np.take_along_axis(right, order, axis=1), order

    def held(self, vectors: np.ndarray) -> np.ndarray:
        """Number of caps that hold each vector."""
        left, falling, _ = self._products(vectors)
        return np.array([np.searchsorted(-f, row - self.height, side="right").sum() for row, f in zip(left, falling, strict=True)])

    def exceeding(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and directions of all caps that hold each (unit) vector."""
        left, falling, order = self._products(vectors)
        rows, directions = [], []
        for k in range(len(vectors)):
            first = np.flatnonzero(left[k] >= self.height - falling[k, 0])
            counts = np.searchsorted(-falling[k], left[k, first] - self.height, side="right")
            at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            directions.append(np.repeat(first, counts) * self.words + order[k][at])
            rows.append(np.full(len(at), k))
        return np.concatenate(rows), np.concatenate(directions)


@dataclass(frozen=True)
class Plan:
    """What all tasks must agree on for vectors of one length."""

    dimension: int
    words: int
    height: float
    repetitions: int
    seed: int

    def codes(self) -> list[ProductCode]:
        return [ProductCode(self.dimension, self.words, self.height, self.seed, k) for k in range(self.repetitions)]


def planted(dimension: int, cosine: float, count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and, for each, one at the given cosine to it."""
    x, z = (rng.standard_normal((count, dimension)) for _ in range(2))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    y = cosine * x + math.sqrt(max(1 - cosine * cosine, 0.0)) * z
    return x, y / np.linalg.norm(y, axis=1, keepdims=True)


def shared(code: ProductCode, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """True for the pairs of rows that lie in a common cap."""
    space = code.words**2
    one, two = (rows * space + caps for rows, caps in (code.exceeding(x), code.exceeding(y)))
    found = np.zeros(len(x), bool)
    found[np.intersect1d(one, two, assume_unique=True) // space] = True
    return found


def plan(dimension: int, population: int, threshold: float, seed: int) -> Plan:
    """Code size from the number of vectors; height and repetitions measured on planted pairs.

    Rotations are random, so a pair's chance of a common cap depends on its cosine alone and the planted
    pairs speak for any data. Two standard errors are taken off the measured share.
    """
    share = min(0.25, OCCUPANCY / max(population, 1))
    words = max(2, math.ceil(math.sqrt(FILTERS / share)))
    rng = np.random.default_rng([seed, dimension, words])
    x, y = planted(dimension, threshold, TRIALS, rng)
    low, high = -2.0, 2.0
    code = ProductCode(dimension, words, low, seed, 0)
    for _ in range(30):
        code.height = (low + high) / 2
        low, high = (code.height, high) if code.held(x).mean() >= FILTERS else (low, code.height)
    hits = np.concatenate([shared(ProductCode(dimension, words, low, seed, k), x, y) for k in range(TRIAL_CODES)])
    rate = hits.mean() - 2 * math.sqrt(max(hits.mean() * (1 - hits.mean()), 1e-4) / len(hits))
    rate = min(max(rate, 1e-3), 0.999)
    return Plan(dimension, words, low, math.ceil(math.log(1 - RECALL) / math.log(1 - rate)), seed)


def _matrix(column: pa.Array) -> np.ndarray:
    """Double-precision rows of one length from a list column."""
    return np.array(column.to_pylist(), dtype=np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def filters(vectors: DataFrame, plans: dict[int, Plan]) -> DataFrame:
    """(id, label, size, caps) for each vector of (id, label, embedding): its caps of all repetitions, ascending."""

    def run(batches):
        codes: dict[int, list[ProductCode]] = {}
        for batch in batches:
            ids, labels, lists = (batch.column(k) for k in range(3))
            lengths = np.array([len(x) for x in lists])
            for size in np.unique(lengths).tolist():
                pick = np.flatnonzero(lengths == size)
                x = unit(_matrix(lists.take(pa.array(pick))))
                if size not in codes:
                    codes[size] = plans[size].codes()
                space = plans[size].words ** 2
                rows, caps = zip(*[(r, d + k * space) for k, c in enumerate(codes[size]) for r, d in [c.exceeding(x)]], strict=True)
                rows, caps = np.concatenate(rows), np.concatenate(caps)
                order = np.lexsort((caps, rows))
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(pick)))])
                held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(caps[order], pa.int64()))
                at = pa.array(pick)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), labels.take(at), pa.array(np.full(len(pick), size, np.int32)), held], ["id", "label", "size", "caps"]
                )

    return vectors.select("id", "label", "embedding").mapInArrow(run, "id bigint, label bigint, size int, caps array<bigint>")


def seen_before(caps: list[np.ndarray], own: int) -> np.ndarray:
    """True for the pairs of rows that share a cap below ``own``."""
    earlier = [c[: np.searchsorted(c, own)] for c in caps]
    names, columns, counts = np.unique(np.concatenate(earlier), return_inverse=True, return_counts=True)
    of = np.repeat(np.arange(len(caps)), [len(c) for c in earlier])
    common = counts[columns] > 1
    if not common.any():
        return np.zeros((len(caps), len(caps)), bool)
    of, place = of[common], (np.cumsum(counts > 1) - 1)[columns[common]]
    met = np.zeros((len(caps), len(caps)), bool)
    for begin in range(0, int(place.max()) + 1, COLUMNS):
        part = (place >= begin) & (place < begin + COLUMNS)
        member = np.zeros((len(caps), COLUMNS), np.float32)
        member[of[part], place[part] - begin] = 1
        met |= member @ member.T > 0
    return met


def joined(near: np.ndarray) -> np.ndarray:
    """The first row of each row's connected component."""
    first = np.arange(len(near))
    while True:
        lower = np.minimum(first, np.where(near, first[None, :], len(near)).min(axis=1))
        lower = lower[lower]
        if (lower == first).all():
            return first
        first = lower


def verified(groups: DataFrame, threshold: float) -> DataFrame:
    """Links with cosine of at least the threshold inside each group: (id, n, least) for each linked vector.

    ``groups`` has (group, cap, side, id, copies, caps, embedding), sorted by group within partitions: rows
    of side 0 and 1 are compared across, rows of side 2 among each other. ``n`` counts the rows behind
    the links whose first common cap is this one, ``least`` is the smallest id connected in the
    group. A group has two tiles at most.
    """

    def compare(cap, side, ids, copies, caps, x):
        order = np.argsort(ids, kind="stable")
        side, ids, copies, x = side[order], ids[order], copies[order], unit(x[order])
        near = (x @ x.T >= threshold) & ((side[:, None] == 2) | (side[:, None] != side[None, :]))
        np.fill_diagonal(near, False)
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            return None
        near = near[np.ix_(linked, linked)]
        fresh = near & ~seen_before([caps[k] for k in order[linked]], cap)
        ids, copies = ids[linked], copies[linked]
        return ids, fresh.astype(np.float64) @ copies, ids[joined(near)]

    def run(batches):
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*waiting, batch]).combine_chunks()
            group = table.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist()]
            yield from links(table, cuts)
            waiting = table.slice(cuts[-1]).to_batches()
        if waiting:
            table = pa.Table.from_batches(waiting).combine_chunks()
            yield from links(table, [0, table.num_rows])

    def links(table, cuts):
        if len(cuts) < 2:
            return
        cap, side, ids, copies = (table.column(k).to_numpy()[: cuts[-1]] for k in range(1, 5))
        caps, at = lists(table.column(5), cuts[-1], np.int64)
        values, offsets = lists(table.column(6), cuts[-1], np.float64)
        found = []
        for b, e in zip(cuts, cuts[1:], strict=False):
            if e - b > 1:
                x = values[offsets[b] : offsets[e]].reshape(e - b, -1)
                held = [caps[at[k] : at[k + 1]] for k in range(b, e)]
                one = compare(cap[b], side[b:e], ids[b:e], copies[b:e].astype(np.float64), held, x)
                if one:
                    found.append(one)
        if found:
            ids, n, least = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64)), pa.array(least)], ["id", "n", "least"])

    def lists(column, rows, kind):
        flat = column.combine_chunks().slice(0, rows)
        return flat.values.to_numpy(zero_copy_only=False).astype(kind, copy=False), flat.offsets.to_numpy()

    given = groups.select("group", "cap", "side", "id", "copies", "caps", "embedding")
    return given.mapInArrow(run, "id bigint, n bigint, least bigint")


def near_links(vectors: DataFrame, threshold: float, seed: int) -> DataFrame:
    """(id, n, least) as ``verified`` gives them, of (id, label, copies, embedding) with equal labels."""
    # One row for each length of vectors reaches the driver.
    largest = vectors.groupBy("label", F.size("embedding").alias("size")).count().groupBy("size").agg(F.max("count")).collect()
    plans = {size: plan(size, n, threshold, seed) for size, n in largest}
    held = Stored(filters(vectors, plans), "cap-filters").df
    key = ["label", "size", "cap"]
    listed = held.select("id", "label", "size", F.explode("caps").alias("cap"))
    sizes = listed.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    sizes = sizes.select(*key, F.ceil(F.col("rows") / TILE).cast("int").alias("tiles"))
    rows = listed.join(sizes, key)
    own = F.pmod(F.xxhash64("id", "cap"), F.col("tiles")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    group = F.xxhash64(*key, F.least("own", "other"), F.greatest("own", "other"))
    rows = rows.select(group.alias("group"), "cap", side.alias("side"), "id")
    full = rows.join(vectors.join(held.select("id", "caps"), "id").select("id", "copies", "caps", "embedding"), "id")
    return verified(full.repartition("group").sortWithinPartitions("group"), threshold)


def near_duplicates(embeddings: DataFrame, threshold: float, seed: int) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of (vec_id, label, embedding)."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "embedding")
    takes_part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    rows = Stored(rows.withColumn("part", F.coalesce(takes_part, F.lit(False))), "cap-vectors").df
    active = rows.where("part").drop("part")
    same = ["label", "embedding"]
    groups = Stored(active.groupBy(*same).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "cap-groups").df
    links = Stored(near_links(groups, threshold, seed), "cap-links").df
    linked = links.groupBy("id").agg(F.sum("n").alias("linked"))
    spanning = links.where("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b"))
    found = groups.join(linked, "id", "left").join(components(spanning), "id", "left")
    found = found.select(
        *same, (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    joined = active.join(found, same).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("part")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return joined.unionByName(alone).withColumn("kept", kept)
