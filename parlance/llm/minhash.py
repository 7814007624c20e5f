"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

The weight of a shingle in a document is its count times an inverse document frequency between 1 (in
every document) and 1 + ``LEAN`` (in a share of ``RARE`` of the documents or less), in steps of 1/32.
The lean is slight: with full logarithms, the edits of a text with many copies would outweigh what the
copies share, and the more copies there are, the less alike they would look. Frequencies
are exact and cover all documents: hashed counters, summed over all tasks, rule out every shingle
below that share, and only the others are counted one by one. So at most (mean shingles of a document)
/ ``RARE`` frequencies exist, whatever the size of the corpus, and go to all tasks.

Improved consistent weighted sampling draws, for each of ``BANDS * ROWS`` hash functions, the shingle
and weight step with the least value c / (y e^r); r, c and the offset come from a fixed table indexed
by the hashed shingle, ties are told apart by the hash. Bands of equal samples make groups.

In a group all members are compared with its first one; linked documents become components. Groups
that still hold several components are compared again with another leader, and what is left then is
compared pair by pair, only between components. Before both, exact bounds leave out what cannot be a
link: with threshold t, two documents of weights v and w that share s need s >= t / (1 + t) * (v + w).
A document shares at most the weight of those shingles that occur in another open document too;
members whose shared weight is too small for any other are set aside. That weight is kept in
``SEGMENTS`` segments of the hash range, and two documents share at most the sum of the smaller one
of each segment: copies with different edits lack weight in different segments, so pairs of them are
told apart by a few numbers (first by sums of segments, then by each), and no text is moved for them. The pairs that are left are compared by
exact weighted Jaccard similarity over the whole texts.
Equal texts are one document here and never compared.

Defined cases: null and empty texts, and texts without words, have no shingles: equal ones form one
class; a null doc_id is named by a hash of its text; different texts under one doc_id are
different documents; repeated rows share a class, and one row of a
class is kept; very long texts are handled whole; an empty table gives no rows; other columns are
kept by ``deduplicate`` and otherwise ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Stored, small_batches, text_or_empty, text_slices
from parlance.llm.components import components, extended
from parlance.llm.shingles import Shingler, mixed

RARE = 1 / 1000
COUNTERS, CHUNK = 1 << 20, 1 << 10
BANDS, ROWS = 16, 4
STEP = 32  # weights are multiples of this part
LEAN = 1 / 8
TOP = round(STEP * (1 + LEAN))
SEGMENT_BITS = 6
SEGMENTS = 1 << SEGMENT_BITS
COARSE = 16  # segments of the first bound: with more, the compiled condition gets too long for the JVM
MEMBERS = 2000  # members that one task compares with a copy of their leader

_TABLE_BITS = 16
_shared: dict[str, object] = {}


def _shingler() -> Shingler:
    return _shared.setdefault("shingler", Shingler())


def counters(texts: DataFrame) -> DataFrame:
    """(chunk, counts): documents by hashed shingle, summed over all tasks chunk by chunk."""

    def count(batches):
        total = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for _, some in text_slices(batch.column(0)):
                for h in _shingler().hashes(some):
                    np.add.at(total, np.unique(h) >> np.uint64(44), np.uint32(1))
        parts = total.reshape(-1, CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        blobs = [parts[k].tobytes() for k in used]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(blobs, pa.binary())], ["chunk", "counts"])

    def add(batches):
        chunk, total = None, None
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != chunk:
                    if chunk is not None:
                        yield row(chunk, total)
                    chunk, total = k, np.zeros(CHUNK, dtype=np.uint64)
                total += np.frombuffer(blob, dtype=np.uint32)
        if chunk is not None:
            yield row(chunk, total)

    def row(chunk, total):
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["chunk", "counts"])

    schema = "chunk int, counts binary"
    parts = texts.mapInArrow(count, schema)
    return parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, schema)


class Weights:
    """Idf of shingles in parts of ``STEP``: a table of the frequent ones, and one value for all others."""

    def __init__(self, hashes: np.ndarray, idf: np.ndarray):
        self.hashes, self.idf = hashes, idf

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), TOP, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.idf[at[known]]
        return out

    def document(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles, sorted, with their weights in parts of ``STEP``."""
        distinct, counts = np.unique(hashes, return_counts=True)
        return distinct, counts * self.of(distinct)


def inverse_frequencies(docs: DataFrame) -> Weights:
    texts = docs.select(text_or_empty().alias("text"))
    total = docs.count()
    floor = max(RARE * total, 2)
    heavy = np.zeros(COUNTERS, dtype=bool)

    def above(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = np.flatnonzero(np.frombuffer(blob, dtype=np.uint64) >= floor) + chunk * CHUNK
                yield pa.RecordBatch.from_arrays([pa.array(at)], ["counter"])

    # At most COUNTERS numbers reach the driver.
    heavy[counters(texts).mapInArrow(above, "counter bigint").toPandas()["counter"].to_numpy(dtype=np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def candidates(batches):
        for batch in batches:
            own = [np.zeros(0, np.uint64)]
            for _, some in text_slices(batch.column(0)):
                for h in map(np.unique, _shingler().hashes(some)):
                    own.append(h[shared.value[h >> np.uint64(44)]])
            h, n = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["hash", "n"])

    found = texts.mapInArrow(candidates, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("df")).where(F.col("df") >= floor).toPandas()
    hashes, df = found["hash"].to_numpy(dtype=np.int64).view(np.uint64), found["df"].to_numpy(dtype=np.float64)
    idf = 1 + LEAN * np.log(total / df) / np.log(total / min(floor, total - 0.5)) if len(df) else df
    order = np.argsort(hashes)
    return Weights(hashes[order], np.clip(np.rint(idf * STEP), STEP, TOP).astype(np.int64)[order])


class Sampler:
    """Consistent weighted samples; a sample is a 64-bit key that equal draws share."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = 1 << _TABLE_BITS
        self.r, self.c = rng.gamma(2, 1, size), rng.gamma(2, 1, size)
        self.beta = rng.random(size)
        self.odd = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.rows: dict[int, int] = {}
        self.table = np.zeros((0, size), dtype=np.uint32)

    def _draws(self, weight: int) -> np.ndarray:
        """The value of every table entry for one weight; positive floats sort like their bits."""
        step = np.floor(np.log(weight / STEP) / self.r + self.beta)
        log_y = self.r * (step - self.beta)
        return (self.c * np.exp(-log_y - self.r)).astype(np.float32).view(np.uint32)

    def _bases(self, weights: np.ndarray) -> np.ndarray:
        if len(self.rows) > 256:
            self.rows.clear()
            self.table = self.table[:0]
        distinct, inverse = np.unique(weights, return_inverse=True)
        new = [w for w in distinct.tolist() if w not in self.rows]
        if new:
            self.rows |= {w: len(self.rows) + k for k, w in enumerate(new)}
            self.table = np.concatenate([self.table, [self._draws(w) for w in new]])
        return np.array([self.rows[w] for w in distinct.tolist()], dtype=np.uint64)[inverse] << np.uint64(_TABLE_BITS)

    def bands(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """For documents with at least one shingle: one hash for each band."""
        h = np.concatenate([d[0] for d in docs])
        base = self._bases(np.concatenate([d[1] for d in docs]))
        starts = np.cumsum([0, *[len(d[0]) for d in docs[:-1]]])
        flat = self.table.ravel()
        out = np.zeros((len(docs), BANDS), dtype=np.uint64)
        for k, odd in enumerate(self.odd):
            m = h * odd
            draws = flat[(m >> np.uint64(64 - _TABLE_BITS)) + base].astype(np.uint64)
            keys = np.minimum.reduceat((draws << np.uint64(32)) | (m & np.uint64(0xFFFFFFFF)), starts)
            band = k // ROWS
            out[:, band] = mixed(out[:, band] * np.uint64(0x100000001B3) + keys + np.uint64(band + 1))
        return out


def signatures(docs: DataFrame, weights) -> DataFrame:
    """doc_id, content (a hash of the text) and bands (null for texts without words)."""

    def run(batches):
        sampler = Sampler()
        for batch in batches:
            bands: list[bytes | None] = []
            for _, some in text_slices(batch.column(2)):
                made = [weights.value.document(h) for h in _shingler().hashes(some)]
                full = [k for k, d in enumerate(made) if len(d[0])]
                part: list = [None] * len(made)
                if full:
                    for k, row in zip(full, sampler.bands([made[k] for k in full]).view(np.int64), strict=True):
                        part[k] = row.tolist()
                bands += part
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "content", "bands"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), content().alias("content"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, content string, bands array<bigint>")


def content():
    return F.md5(F.encode(text_or_empty(), "UTF-8"))


def linked(pairs: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity reaches the threshold.

    The members b of a leader a are compared in parts of about ``MEMBERS``, each with its own copy of
    the leader's text, which comes first in its part.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts"))
    split = pairs.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    leaders = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = split.select("a", "part", F.lit(1).alias("turn"), F.col("b").alias("id")).unionByName(
        leaders.select("a", "part", F.lit(0).alias("turn"), F.col("a").alias("id"))
    )
    rows = rows.join(texts, "id").repartition("a", "part").sortWithinPartitions("a", "part", "turn")

    def run(batches):
        leader, own = None, None
        for batch in batches:
            a, b, turn = (batch.column(k).to_pylist() for k in range(3))
            found = []
            for begin, some in text_slices(batch.column(3)):
                for k, h in enumerate(_shingler().hashes(some), begin):
                    doc = weights.value.document(h)
                    if turn[k] == 0:
                        leader, own = a[k], doc
                    elif a[k] == leader and similarity(own, doc) >= threshold:
                        found.append((a[k], b[k]))
            columns = list(zip(*found, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return rows.select("a", "id", "turn", "text").mapInArrow(run, "a bigint, b bigint")


def shared_weights(texts: DataFrame, weights) -> DataFrame:
    """(id, weight, shares): a document's weight, and by segment the part of it that another of the texts holds."""

    def spread(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for begin, some in text_slices(batch.column(1)):
                made = [weights.value.document(h) for h in _shingler().hashes(some)]
                h, w = (np.concatenate([m[k] for m in made]) for k in (0, 1))
                own = np.repeat(ids[begin : begin + len(made)], [len(m[0]) for m in made])
                columns = [pa.array(h.view(np.int64)), pa.array(own), pa.array(w)]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "id", "weight"])

    def mark(batches):
        # Rows of one shingle stand together; the last row of a batch waits for the next batch.
        last, held = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, ids, w = (batch.column(k).to_numpy() for k in range(3))
            head = np.concatenate([[last is None or h[0] != last], h[1:] != h[:-1]])
            many = ~head
            many[:-1] |= ~head[1:]
            if held is not None:
                yield marked(*held, held_many | ~head[:1])
            held, held_many, last = (h[-1:], ids[-1:], w[-1:]), ~head[-1:], h[-1]
            yield marked(h[:-1], ids[:-1], w[:-1], many[:-1])
        if held is not None:
            yield marked(*held, held_many)

    def marked(h, ids, w, many):
        segment = (h.view(np.uint64) >> np.uint64(64 - SEGMENT_BITS)).astype(np.int32)
        return pa.RecordBatch.from_arrays([*map(pa.array, (ids, segment, w, w * many))], ["id", "segment", "weight", "shared"])

    rows = texts.select("id", "text").mapInArrow(spread, "hash bigint, id bigint, weight bigint")
    rows = rows.repartition("hash").sortWithinPartitions("hash")
    parts = rows.mapInArrow(mark, "id bigint, segment int, weight bigint, shared bigint")
    found = parts.groupBy("id", "segment").agg(F.sum("weight").alias("weight"), F.sum("shared").cast("int").alias("shared"))
    held = found.groupBy("id").agg(
        F.sum("weight").alias("weight"), F.map_from_entries(F.collect_list(F.struct("segment", "shared"))).alias("held")
    )
    each = F.transform(F.sequence(F.lit(0), F.lit(SEGMENTS - 1)), lambda k: F.coalesce(F.try_element_at("held", k), F.lit(0)))
    return held.select("id", "weight", each.alias("shares"))


def total(numbers):
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def coarse(shares: str):
    """The shares of ``COARSE`` segments, each the sum of several of the finer ones."""
    width = SEGMENTS // COARSE
    return F.array(*[total(F.slice(shares, k * width + 1, width)) for k in range(COARSE)])


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(one[1][i], two[1][j]).sum())
    return both / max(int(one[1].sum()) + int(two[1].sum()) - both, 1)


def classes(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, content, class_id (smallest doc_id of the class), repeats and whether it stands for its class,
    for each distinct row."""
    spark = docs.sparkSession
    small_batches(spark)
    weights = spark.sparkContext.broadcast(inverse_frequencies(docs))
    signed = Stored(signatures(docs, weights), "minhash-signatures").df
    unique = signed.groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"))
    # A node is a text, numbered here, since several texts can have one doc_id.
    name = F.coalesce("doc_id", F.xxhash64("content")).alias("name")
    unique = Stored(unique.select("content", name, F.monotonically_increasing_id().alias("id"), "bands"), "minhash-texts").df

    members = unique.select("id", F.posexplode("bands").alias("band", "key")).select("id", F.xxhash64("band", "key").alias("key"))
    leaders = members.groupBy("key").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = Stored(members.join(leaders, "key"), "minhash-groups").df

    involved = members.select("id").distinct().join(unique.select("id", "content"), "id")
    texts = docs.select(content().alias("content"), text_or_empty().alias("text")).join(involved, "content").select("id", "text")
    texts = Stored(texts.dropDuplicates(["id"]), "minhash-candidates", "zstd").df

    pairs = members.where("leader <> id").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links = Stored(linked(pairs, texts, weights, threshold), "minhash-links").df
    found = Stored(components(links), "minhash-components").df
    open_ids = _open(members, found).select("id").distinct()
    sizes = shared_weights(texts.join(open_ids, "id"), weights)
    sizes = Stored(sizes.select("*", coarse("shares").alias("coarse"), total("shares").alias("shared")), "minhash-weights").df
    for last in (False, True):
        # Groups that still hold several components, and their members that can have a link.
        rows = _open(members, found).join(sizes, "id")
        least = rows.groupBy("key").agg(F.min("weight").alias("least"))
        most = F.col("shared") * F.lit((1 + threshold) / threshold) - F.col("weight") + 1e-6
        rows = rows.join(least, "key").withColumn("most", most).where(F.col("most") >= F.col("least"))
        carried = ("id", "component", "weight", "coarse", "shares")
        rows = _several(Stored(rows.select("key", *carried), "minhash-open").df)
        one, two = (rows.select("key", *[F.col(c).alias(f"{c}_{i}") for c in carried]) for i in "ab")
        if not last:
            lead = rows.groupBy("key").agg(F.min_by("id", F.xxhash64("id", "key")).alias("leader"))
            one = one.join(lead, "key").where("id_a = leader").drop("leader")
        # The coarse bound is compiled and leaves few pairs for the finer one.
        common = [F.least(F.col("coarse_a")[k], F.col("coarse_b")[k]) for k in range(COARSE)]
        bounds = (sum(common[1:], common[0]), total(F.zip_with("shares_a", "shares_b", lambda x, y: F.least(x, y))))
        rough, fine = (b * F.lit((1 + threshold) / threshold) + 1e-6 >= F.col("weight_a") + F.col("weight_b") for b in bounds)
        can = F.when(rough, fine).otherwise(False)
        order = (F.col("id_a") < F.col("id_b")) if last else F.lit(True)
        pairs = one.join(two, "key").where((F.col("component_a") != F.col("component_b")) & can & order)
        pairs = pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
        found = extended(found, Stored(linked(pairs, texts, weights, threshold), "minhash-links").df)
    placed = unique.select("content", "id", "name").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    leads = Stored(placed.groupBy("component").agg(F.min(F.struct("name", "content")).alias("lead")), "minhash-classes").df
    # Where several classes begin with one doc_id, the first of them has its name.
    first = leads.groupBy("lead.name").agg(F.min("lead.content").alias("first"))
    own_name = F.when(F.col("lead.content") == F.col("first"), F.col("name")).otherwise(-F.abs(F.xxhash64("lead.content") % (1 << 62)))
    named = leads.withColumn("name", F.col("lead.name")).join(first, "name").select("component", "lead", own_name.alias("class_id"))
    named = placed.select("content", "name", "component").join(named, "component")
    named = named.select("content", "name", "class_id", (F.col("lead.content") == F.col("content")).alias("leads"))
    rows = signed.groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("repeats"))
    kept = F.col("leads") & (F.coalesce("doc_id", F.xxhash64("content")) == F.col("name"))
    return rows.join(named, "content").select("doc_id", "content", "class_id", "repeats", kept.alias("first"))


def _several(rows: DataFrame) -> DataFrame:
    """Rows of the groups that hold more than one component."""
    keys = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return rows.join(keys.select("key"), "key", "left_semi")


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, id, component) of the groups that are not yet one component."""
    placed = members.select("key", "id").join(found, "id", "left")
    return _several(placed.select("key", "id", F.coalesce("component", "id").alias("component")))


def duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id and kept for each row."""
    found = classes(docs, threshold).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    return found.select("doc_id", "class_id", (F.col("first") & (F.col("copy") == 1)).alias("kept"))


def deduplicate(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The documents with one row of every class left; all columns are kept."""
    found = classes(docs, threshold)
    kept = found.where("first")
    kept = Stored(kept.select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"), F.col("repeats").alias("_repeats")), "minhash-kept").df
    # The document travels as one value, so that no column of its own can clash with these.
    held = docs.select(F.col("doc_id").cast("bigint").alias("own_id"), content().alias("own"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    rows = held.join(kept, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_content")))
    single = rows.where("_repeats = 1").select("document")
    repeated = rows.where("_repeats > 1").dropDuplicates(["_id", "_content"]).select("document")
    return single.unionByName(repeated).select("document.*")
