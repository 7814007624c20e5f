"""Importance resampling towards a target distribution over hashed word runs, with a head-tail vocabulary.

Features of a text are its runs of one to three words, words joined by one space, repeats counted; a
feature falls into the bucket of its CRC-32. The vocabulary has a head: the most frequent words, with
the CRC state a run is in after them, and the most frequent pairs of these words, with the state and
bucket of the pair. Both are exact values for a bounded number of entries, and are sent to every task.
All other words and features, the tail, take their CRC directly: a word from its bytes, a run from the
state before its last word and that word. So head and tail feed the same, exact bucket totals. They
are counted over all documents and all target texts, and a document's weight is the sum of its
features' gains. Drawing is by Gumbel noise from a hash of the doc_id, so reruns agree.

Defined cases: a null text has no words, one or two words give the runs there are; a document
without words weighs 0; a null doc_id is hashed as an empty text and comes last among ties; repeated
rows are documents of their own, and equal ones are drawn in any order; no target text, or no
documents, leave totals of zero; a very long text is read in overlapping pieces of whole words; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import Stored

SLICE_BYTES = 2_000_000
# Fixed value: word characters, as bytes of UTF-8 text in lower case.
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_not_word = re.compile(rb"[^0-9a-z\x80-\xff]")


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    head_words: int = 16_384  # bounds what is sent to every task
    head_pairs: int = 65_536
    min_words: int = 20
    percent: int = 5
    seed: int = 42


# ---- CRC states of runs ------------------------------------------------------------------------------


class Appender:
    """CRC-32 of a run from the state before its last word: appending n bytes is linear over bits.

    ``tables[b]`` appends 2**b zero bytes to a state, by one lookup for each of its four bytes;
    ``short`` holds the tables of all small n at once.
    """

    SHORT = 48

    def __init__(self):
        self.tables = [self._table(lambda x: zlib.crc32(b"\0", x) ^ zlib.crc32(b"\0"))]
        self.short = np.stack(
            [self._table(lambda x, n=n: zlib.crc32(b"\0" * n, x) ^ zlib.crc32(b"\0" * n)) for n in range(self.SHORT)]
        ).reshape(-1)

    @staticmethod
    def _table(step) -> np.ndarray:
        bits = np.array([step(1 << k) for k in range(32)], dtype=np.uint32).reshape(4, 8)
        values = np.arange(256)
        out = np.zeros((4, 256), dtype=np.uint32)
        for k in range(8):
            out ^= np.where((values >> k) & 1, bits[:, k : k + 1], np.uint32(0)).astype(np.uint32)
        return out

    def _doubled(self, b: int) -> np.ndarray:
        while len(self.tables) <= b:
            last = self.tables[-1].reshape(-1)
            self.tables.append(self._table(lambda x, t=last: int(self._apply(t, np.zeros(1, np.int64), self._apply(t, np.zeros(1, np.int64), np.array([x], np.uint32)))[0])))
        return self.tables[b].reshape(-1)

    @staticmethod
    def _apply(tables: np.ndarray, base: np.ndarray, state: np.ndarray) -> np.ndarray:
        out = tables[base + (state & 255)]
        for k in (1, 2, 3):
            out = out ^ tables[base + 256 * k + ((state >> np.uint32(8 * k)) & 255)]
        return out

    def after(self, state: np.ndarray, added: np.ndarray, size: np.ndarray) -> np.ndarray:
        """States after appending pieces of ``size`` bytes whose own CRC is ``added``."""
        out = self._apply(self.short, np.where(size < self.SHORT, size, 0).astype(np.int64) * 1024, state)
        for i in np.flatnonzero(size >= self.SHORT).reshape(-1, 1):
            grown, left, b = state[i], int(size[i[0]]), 0
            while left >> b:
                if left >> b & 1:
                    grown = self._apply(self._doubled(b), np.zeros(1, np.int64), grown)
                b += 1
            out[i] = grown
        return out ^ added


@dataclass
class Head:
    """The frequent words in byte order with their states, and the frequent pairs of them."""

    words: list[bytes]
    pairs: list[tuple[int, int]]

    def __post_init__(self):
        self.value_set = pa.array(self.words, pa.binary())
        self.state = np.array([zlib.crc32(w) for w in self.words], dtype=np.uint32)
        self.joined = np.array([zlib.crc32(b" " + w) for w in self.words], dtype=np.uint32)
        # Pairs go to slots by their key; a pair whose slot is taken by a more frequent one is tail.
        self.bits = max(len(self.pairs).bit_length() + 2, 4)
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.pair_state = np.zeros(1 << self.bits, dtype=np.uint32)
        for one, two in self.pairs:
            key = one * len(self.words) + two
            slot = int(self.slot(np.array([key]))[0])
            if self.keys[slot] < 0:
                self.keys[slot] = key
                self.pair_state[slot] = zlib.crc32(self.words[one] + b" " + self.words[two])

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)


# ---- words of texts ------------------------------------------------------------------------------------


@dataclass
class Words:
    """Words of a slice of texts: each word's text number, entry in ``distinct``, and whether an
    earlier piece of the text has counted it."""

    text: np.ndarray
    entry: np.ndarray
    counted: np.ndarray
    distinct: pa.Array


def _begins(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = _IS_WORD[data]
    edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def pieces(text: bytes) -> Iterator[tuple[bytes, int]]:
    """A text in pieces of whole words, each with the number of words that it repeats of the last."""
    begin, repeated, end = 0, 0, 0
    while True:
        end = max(begin + SLICE_BYTES, end + 1)
        cut = _not_word.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        piece = text[begin:end]
        yield piece, repeated
        if end >= len(text):
            return
        last = _begins(np.frombuffer(piece, dtype=np.uint8))[0][-2:]
        repeated = len(last)
        begin = begin + int(last[0]) if repeated else end


def slices(texts: Iterable[bytes | None]) -> Iterator[Words]:
    """All words of all texts, in slices of bounded bytes; texts are numbered from 0."""
    waiting, size = [], 0
    for k, text in enumerate(texts):
        for piece, repeated in pieces((text or b"").lower()):
            waiting.append((k, piece, repeated))
            size += len(piece)
            if size >= SLICE_BYTES:
                yield _words(waiting)
                waiting, size = [], 0
    if waiting:
        yield _words(waiting)


def _words(parts: list[tuple[int, bytes, int]]) -> Words:
    data = np.frombuffer(b" ".join(p for _, p, _ in parts), dtype=np.uint8)
    begins, ends = _begins(data)
    edges = np.cumsum([len(p) + 1 for _, p, _ in parts])
    part = np.searchsorted(edges, begins, side="right")
    first = np.searchsorted(part, np.arange(len(parts)))
    repeated = np.array([r for *_, r in parts], dtype=np.int64)
    counted = (np.arange(len(begins)) - first[part]) < repeated[part] if len(begins) else np.zeros(0, bool)
    offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
    # Words side by side are an Arrow array of their own; encoding it is exact and needs no hash of ours.
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[_IS_WORD[data]].tobytes())]
    encoded = pa.Array.from_buffers(pa.binary(), len(begins), buffers).dictionary_encode()
    numbers = np.array([k for k, *_ in parts], dtype=np.int64)
    return Words(numbers[part], encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counted, encoded.dictionary)


class Features:
    """Buckets of all features of a slice, by head tables where they apply and directly elsewhere."""

    def __init__(self, head: Head, buckets: int):
        self.head, self.buckets, self.append = head, buckets, Appender()

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text number, bucket) of every feature that no earlier piece has counted."""
        head = self.head
        known = pc.index_in(words.distinct, value_set=head.value_set).fill_null(-1).to_numpy(zero_copy_only=False)
        state, joined = np.zeros(len(known), np.uint32), np.zeros(len(known), np.uint32)
        is_head = known >= 0
        state[is_head], joined[is_head] = head.state[known[is_head]], head.joined[known[is_head]]
        for k in np.flatnonzero(~is_head):
            word = words.distinct[int(k)].as_py()
            state[k], joined[k] = zlib.crc32(word), zlib.crc32(b" " + word)
        sizes = pc.binary_length(words.distinct).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        one, added, size, number = state[words.entry], joined[words.entry], sizes[words.entry], known[words.entry]
        text, fresh = words.text, ~words.counted
        next_same = text[1:] == text[:-1]
        two = np.zeros(max(len(one) - 1, 0), dtype=np.uint32)
        left = next_same.copy()  # pairs that still need a state
        both = np.flatnonzero(next_same & (number[1:] >= 0) & (number[:-1] >= 0))
        if len(both) and head.pairs:
            keys = number[both].astype(np.int64) * len(head.words) + number[both + 1]
            slot = head.slot(keys)
            hit = head.keys[slot] == keys
            two[both[hit]] = head.pair_state[slot[hit]]
            left[both[hit]] = False
        left = np.flatnonzero(left)
        two[left] = self.append.after(one[left], added[left + 1], size[left + 1])
        third = np.flatnonzero(next_same[1:] & next_same[:-1])
        three = self.append.after(two[third], added[third + 2], size[third + 2])
        pair = np.flatnonzero(next_same & fresh[1:])
        triple = fresh[third + 2]
        texts = np.concatenate([text[fresh], text[pair], text[third][triple]])
        states = np.concatenate([one[fresh], two[pair], three[triple]])
        return texts, (states % np.uint32(self.buckets)).astype(np.int64)


# ---- Spark steps ---------------------------------------------------------------------------------------


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes | None]:
    return (x.as_py() for x in batch.column(column).cast(pa.binary()))


def most_frequent(counted: DataFrame, limit: int) -> list:
    """Rows with the greatest ``n``, at most ``limit``, most frequent first.

    A histogram of sixteenths of powers of two tells from which count on they fit the limit, so that
    neither the driver nor one task gets a share of every partition.
    """
    kept = Stored(counted, "counts")
    step = F.floor(16 * F.log2(F.col("n").cast("double")))
    many, cut = 0, None
    for level, rows in sorted(kept.df.groupBy(step).count().collect(), reverse=True):
        many += rows
        if many > limit:
            break
        cut = level
    found = kept.df.where(step >= cut).collect() if cut is not None else []
    kept.drop()
    return sorted(found, key=lambda r: (-r.n, r[0]))


def head_words(texts: DataFrame, limit: int) -> list[bytes]:
    """The most frequent words of all texts, counted by slices before anything is exchanged."""

    def run(batches):
        for batch in batches:
            for words in slices(texts_of(batch)):
                counts = np.bincount(words.entry[~words.counted], minlength=len(words.distinct))
                yield pa.RecordBatch.from_arrays([words.distinct, pa.array(counts)], ["word", "n"])

    counted = texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return [bytes(r.word) for r in most_frequent(counted.where("n > 1"), limit)]


def head_pairs(texts: DataFrame, words: list[bytes], limit: int) -> list[tuple[int, int]]:
    """The most frequent pairs of head words, most frequent first."""
    many = len(words)

    def run(batches):
        value_set = pa.array(words, pa.binary())
        for batch in batches:
            for found in slices(texts_of(batch)):
                known = pc.index_in(found.distinct, value_set=value_set).fill_null(-1).to_numpy(zero_copy_only=False)
                number = known[found.entry].astype(np.int64)
                pair = (found.text[1:] == found.text[:-1]) & ~found.counted[1:] & (number[1:] >= 0) & (number[:-1] >= 0)
                keys, counts = np.unique(number[:-1][pair] * many + number[1:][pair], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])

    counted = texts.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    return [divmod(r.pair, many) for r in most_frequent(counted.where("n > 1"), limit)]


def vocabulary(texts: DataFrame, settings: Settings = Settings()) -> Head:
    words = head_words(texts, settings.head_words)
    return Head(words, head_pairs(texts, words, settings.head_pairs))


def bucket_totals(texts: DataFrame, head, settings: Settings) -> np.ndarray:
    """How many features of all texts fall into each bucket; ``head`` is a broadcast vocabulary."""

    def run(batches):
        features, totals = Features(head.value, settings.buckets), np.zeros(settings.buckets, dtype=np.int64)
        for batch in batches:
            for words in slices(texts_of(batch)):
                totals += np.bincount(features.of(words)[1], minlength=settings.buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(settings.buckets)), pa.array(totals)], ["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(settings.buckets, dtype=np.int64)
    for r in rows:  # one row for each bucket
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of how much likelier the target makes it."""
    s, t, many = source.astype(np.float64), target.astype(np.float64), len(source)
    ratio = (t + 1) * (s.sum() + many) / ((s + 1) * (t.sum() + many))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, head, gain: np.ndarray, settings: Settings) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""

    def run(batches):
        features = Features(head.value, settings.buckets)
        for batch in batches:
            many = batch.num_rows
            n_words, n_features, weight = (np.zeros(many, dtype=np.int64) for _ in range(3))
            for words in slices(texts_of(batch)):
                n_words += np.bincount(words.text[~words.counted], minlength=many)
                text, bucket = features.of(words)
                n_features += np.bincount(text, minlength=many)
                weight += np.bincount(text, weights=gain[bucket], minlength=many).astype(np.int64)
            columns = [batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ids.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int) -> Column:
    """A thousandfold standard Gumbel draw, fixed by seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def ranked(rows: DataFrame, order: list[Column], drawn: int) -> DataFrame:
    """Row numbers of the first ``drawn`` rows in ``order``, from ranges sorted side by side."""

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            numbers = pa.array(at + np.arange(1, batch.num_rows + 1))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.full(batch.num_rows, part)), numbers], ["row", "part", "inner"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("row")
    local = Stored(dealt.mapInArrow(run, "row bigint, part bigint, inner bigint"), "ranks").df
    # One row for each partition: their number bounds the window and the broadcast.
    sizes = local.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = sizes.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    placed = local.join(F.broadcast(before), "part")
    return placed.select("row", (F.col("inner") + F.col("before")).alias("rank")).where(F.col("rank") <= drawn)


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) of every document."""
    spark = docs.sparkSession
    texts = docs.select("text")
    head = spark.sparkContext.broadcast(vocabulary(texts, settings))
    gain = gains(bucket_totals(texts, head, settings), bucket_totals(target.select("text"), head, settings))
    scored = weights(docs, head, gain, settings).withColumn("score", F.col("weight") + noise(settings.seed))
    scored = Stored(scored.withColumn("row", F.monotonically_increasing_id()), "resampling").df
    eligible = scored.where(F.col("n_words") >= settings.min_words)
    drawn = eligible.count() * settings.percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features"), F.asc("row")]
    ranks = ranked(eligible.select("row", "score", "doc_id", "weight", "n_features"), order, drawn)
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
