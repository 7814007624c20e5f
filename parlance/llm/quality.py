"""Quality classifier: supervised subword embeddings, averaged per document.

Features are words and their character n-grams, hashed into a table of learned vectors, plus two
marks that stand for a word that repeats its predecessor and for a word seen before in the text. A
document is the mean of its features' vectors; a linear layer and softmax give the class. Training is
stochastic gradient descent in numpy on a bounded sample of labelled documents (``max_documents``,
those first in a seeded hash order). Tasks count the sample's features, one task learns from the counts,
and only the model, a table of fixed size, reaches the driver.

Scoring covers every whole text. With two classes the layer folds into the vectors: each feature has
one number, a word has the sum over its features, kept in a bounded cache. The new words of many texts
are hashed together, so that the work of a text hardly depends on how many of its words are new.

Defined cases: null and empty texts have no features and score by the bias alone; ties and repeated
rows score alike; null labels, and labels other than the two classes, are not learned from; a document
with several labels counts with each; without labels of both classes every score is the share of
class 1 (0.5 if there is none); other columns are kept by ``score`` and never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain, count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import small_batches, text_or_empty

WORDS_CACHED = 150_000
#: Words of texts that are scored together, and new words that are hashed together.
WORDS_SCORED, WORDS_HASHED = 1 << 15, 1 << 14


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    width: int = 8
    shortest: int = 3
    longest: int = 4
    max_documents: int = 3000
    steps: int = 600
    batch: int = 32
    rate: float = 1.0
    seed: int = 7


@cache
def crc_tables(size: int) -> np.ndarray:
    """For each place and byte, what the byte gives to the CRC-32 of ``size`` bytes: all of them are XORed."""
    zero = zlib.crc32(bytes(size))
    places = [[zlib.crc32(bytes(k) + bytes([b]) + bytes(size - 1 - k)) ^ zero for b in range(256)] for k in range(size)]
    tables = np.array(places, dtype=np.uint32)
    tables[0] ^= np.uint32(zero)
    return tables


def word_features(words: list[str], s: Settings) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Table rows of words and their character n-grams; rows 0 and 1 are the two marks.

    Yields (begin, end, of, rows) for runs of words: each feature's word, counted from ``begin``, and its row.
    """
    room = np.uint32(s.buckets - 2)
    for begin in range(0, len(words), WORDS_HASHED):
        edged = [f"<{w}>".encode("utf-8", "surrogatepass") for w in words[begin : begin + WORDS_HASHED]]
        data = np.frombuffer(b"".join(edged), np.uint8)
        sizes = np.fromiter(map(len, edged), np.int64, len(edged))
        word = np.repeat(np.arange(len(edged)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))
        of, hashes = [np.arange(len(edged))], [np.fromiter(map(zlib.crc32, edged), np.uint32, len(edged))]
        for n in range(s.shortest, s.longest + 1):
            places = max(len(data) - n + 1, 0)
            inside = left[:places] >= n
            crc = np.zeros(places, np.uint32)
            for k, table in enumerate(crc_tables(n)):
                crc ^= table[data[k : k + places]]
            of.append(word[:places][inside])
            hashes.append(crc[inside])
        yield begin, begin + len(edged), np.concatenate(of), 2 + (np.concatenate(hashes) % room).astype(np.int64)


def repeats(words: list[str]) -> tuple[int, int]:
    """Words equal to their predecessor, and words that occurred before."""
    return sum(a == b for a, b in zip(words, words[1:], strict=False)), len(words) - len(set(words))


def document_features(text: str | None, s: Settings) -> np.ndarray:
    """Counts of the table's rows in one text, as pairs (row, count)."""
    words = (text or "").split()
    times = Counter(words)
    counts = np.zeros(s.buckets, dtype=np.int64)
    counts[:2] = repeats(words)
    each = np.fromiter(times.values(), np.int64, len(times))
    for begin, end, of, rows in word_features(list(times), s):
        np.add.at(counts, rows, each[begin:end][of])
    rows = np.flatnonzero(counts)
    return np.stack([rows, counts[rows]], axis=1)


@dataclass
class Model:
    """One number for every table row, and a bias: what the softmax of two classes comes down to."""

    weights: np.ndarray
    bias: float
    settings: Settings


def draw(s: Settings):
    """The seeded order in which documents are taken for training."""
    return F.xxhash64(F.lit(s.seed), F.col("doc_id").cast("string"))


def train(labelled: DataFrame, s: Settings = Settings()) -> Model:
    """Learn from (doc_id, text, label); at most ``max_documents`` of them are used."""
    rows = labelled.where(F.col("label").isin(0, 1)).select(
        draw(s).alias("draw"), text_or_empty().alias("text"), F.col("label").cast("int").alias("label")
    )
    chosen = rows.orderBy("draw", "text").limit(s.max_documents)

    def run(batches):
        for batch in batches:
            pairs = [document_features(t, s) for t in batch.column(0).to_pylist()]
            rows, counts = ([p[:, k].astype(kind).tobytes() for p in pairs] for k, kind in ((0, "<u4"), (1, "<f4")))
            columns = [batch.column(1), batch.column(2), pa.array(rows, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["label", "draw", "rows", "counts"])

    def learn(batches):
        model = learned(pa.Table.from_batches(list(batches), FEATURES), s)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.astype("<f4").tobytes()], "bias": [model.bias]})

    features = chosen.select("text", "label", "draw").mapInArrow(run, "label int, draw bigint, rows binary, counts binary")
    # The sample is bounded, so one task learns from it; the driver sees the model alone.
    features = features.repartition(1).sortWithinPartitions("draw", "label", "rows")
    made = features.mapInArrow(learn, "weights binary, bias double").first()
    if made is None:
        return Model(np.zeros(s.buckets, np.float32), 0.0, s)
    return Model(np.frombuffer(made.weights, "<f4"), made.bias, s)


FEATURES = pa.schema([("label", pa.int32()), ("draw", pa.int64()), ("rows", pa.binary()), ("counts", pa.binary())])


def learned(found: pa.Table, s: Settings) -> Model:
    """The model of a table of labelled feature counts."""
    labels = np.array(found.column("label").to_pylist(), dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(s.buckets, np.float32), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), s)
    # Views of the table's buffers: the task holds the sample once.
    docs = [
        (np.frombuffer(r.as_buffer(), "<u4"), np.frombuffer(c.as_buffer(), "<f4"))
        for r, c in zip(found.column("rows"), found.column("counts"), strict=True)
    ]
    return fit(docs, labels, s)


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> Model:
    """Stochastic gradient descent over small batches; both classes weigh the same."""
    rng = np.random.default_rng(s.seed)
    vectors = ((rng.random((s.buckets, s.width)) - 0.5) / s.width).astype(np.float32)
    layer, bias = np.zeros((s.width, 2), np.float32), np.zeros(2, np.float32)
    balance = len(labels) / (2 * np.bincount(labels, minlength=2))
    step = 0
    while step < s.steps:
        order = rng.permutation(len(docs))
        for begin in range(0, len(order), s.batch):
            pick = order[begin : begin + s.batch]
            rate = s.rate * max(1 - step / s.steps, 0.0)
            step += 1
            sizes = np.array([len(docs[i][0]) for i in pick])
            rows = np.concatenate([docs[i][0] for i in pick]).astype(np.int64)
            share = np.concatenate([docs[i][1] / max(docs[i][1].sum(), 1) for i in pick])
            of = np.repeat(np.arange(len(pick)), sizes)
            mean = np.zeros((len(pick), s.width), np.float32)
            full = np.flatnonzero(sizes)
            if len(full):
                mean[full] = np.add.reduceat(vectors[rows] * share[:, None], (np.cumsum(sizes) - sizes)[full])
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            p = (p * balance[labels[pick]][:, None]).astype(np.float32)
            back = p @ layer.T
            layer -= rate * mean.T @ p / 4
            bias -= rate * p.mean(0)
            by_row = np.argsort(rows, kind="stable")
            ordered = rows[by_row]
            heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, int)
            if len(heads):
                vectors[ordered[heads]] -= rate * np.add.reduceat(back[of[by_row]] * share[by_row, None], heads)
    difference = layer[:, 1] - layer[:, 0]
    return Model(vectors @ difference, float(bias[1] - bias[0]), s)


class Scorer:
    """Adds up the numbers of whole texts; words met before come from a bounded cache."""

    def __init__(self, model: Model):
        self.model, self.weights = model, model.weights.astype(np.float64)
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)  # a new word gets the next number
        self.sums, self.counts = np.zeros(0), np.zeros(0, np.int64)

    def _learn(self) -> None:
        """Sums and counts of the words that were numbered since the last call."""
        new = list(islice(self.numbers, len(self.sums), None))
        sums, counts = [self.sums], [self.counts]
        for begin, end, of, rows in word_features(new, self.model.settings):
            sums.append(np.bincount(of, self.weights[rows], end - begin))
            counts.append(np.bincount(of, minlength=end - begin))
        self.sums, self.counts = np.concatenate(sums), np.concatenate(counts)

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        """The chance of class 1 of each text."""
        found, held, size = [], [], 0
        for text in texts:
            held.append((text or "").split())
            size += len(held[-1])
            if size >= WORDS_SCORED:
                found.append(self._together(held, size))
                held, size = [], 0
        return np.concatenate([*found, self._together(held, size)])

    def _together(self, texts: list[list[str]], size: int) -> np.ndarray:
        if len(self.numbers) > WORDS_CACHED:
            self._forget()
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(texts)), np.int64, size)
        self._learn()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        full = np.flatnonzero(sizes)
        heads = (np.cumsum(sizes) - sizes)[full]
        mean = np.zeros(len(texts))
        if len(full):
            same = np.append(False, at[1:] == at[:-1])
            same[heads] = False
            same = np.add.reduceat(same.astype(np.int64), heads)
            seen = np.array([len(texts[k]) - len(set(texts[k])) for k in full])
            total = np.add.reduceat(self.sums[at], heads) + same * self.weights[0] + seen * self.weights[1]
            mean[full] = total / (np.add.reduceat(self.counts[at], heads) + same + seen)
        return 1 / (1 + np.exp(-np.clip(self.model.bias + mean, -500, 500)))


_scorers: dict[str, Scorer] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``document`` (all columns of ``docs`` as one value) and ``score``, the chance of class 1."""
    small_batches(docs.sparkSession)
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.pandas_udf("double")
    def chance(texts: pd.Series) -> pd.Series:
        if name not in _scorers:  # one model at a time, kept between the tasks of a worker
            _scorers.clear()
            _scorers[name] = Scorer(shared.value)
        return pd.Series(_scorers[name].scores(texts), dtype="float64")

    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(document.alias("document"), chance(text_or_empty()).alias("score"))
