"""Token files: static range asymmetric numeral system over shared frequency tables.

All ids of the corpus are counted once; the counts, scaled to a power of two with at least one slot
for every id of the vocabulary, are the one table that all blocks share. Documents are sorted by id
over range partitions; each partition becomes independent blocks of whole documents. In a block many
coder states ("lanes") run side by side, id ``i`` belongs to lane ``i % lanes``, and their 32-bit
words are interleaved in decoding order. Every ``STRIDE`` steps a checkpoint keeps all states and the
place in the word stream, so segments of a block can be decoded in parallel; each segment and each
frame has a checksum, and a mismatch raises.

A token folder holds two Parquet tables: ``table`` (id, frequency) and ``blocks`` (part, ids before
it in the part, n_ids, frame). Frames are self-contained binaries; the container gives them Spark's commit protocol.

Defined cases: null and empty texts have the end id alone; a null doc_id comes first; rows of one
doc_id follow each other by a hash of their text; repeated rows are kept; a document never spans two
blocks, so a block is as long as its longest document needs; an empty table gives empty tables; other
columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.llm.common import Stored, text_or_empty
from parlance.llm.tokens import tokenizer

PRECISION = 20  # bits of the scaled frequencies; the vocabulary must have fewer ids than 2**20
LANES = 512
STRIDE = 128
BLOCK_IDS = 1 << 18
LOW = np.uint64(1 << 31)
MAGIC = b"ranS"
_HEAD = struct.Struct("<4sIqqiiii")  # magic, crc of the rest, ids, documents, lanes, steps, segments, words


def scale_counts(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2**PRECISION``, each at least one; the same for the same counts."""
    slots = 1 << PRECISION
    if len(counts) > slots // 2:
        raise ValueError("the vocabulary is too large for the precision")
    share = counts / max(int(counts.sum()), 1) * (slots - len(counts))
    scaled = np.floor(share).astype(np.int64) + 1
    rest = slots - int(scaled.sum())
    order = np.lexsort((np.arange(len(counts)), -counts))
    scaled[order[0]] += rest
    return scaled


def tables(scaled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frequencies, cumulated frequencies and the id of every slot."""
    freq = scaled.astype(np.uint64)
    below = (np.cumsum(scaled) - scaled).astype(np.uint64)
    return freq, below, np.repeat(np.arange(len(scaled), dtype=np.uint32), scaled)


def encode_frame(docs: list[tuple[int | None, np.ndarray]], coder) -> bytes:
    freq, below, _ = coder
    ids = np.concatenate([x for _, x in docs])
    lanes = int(np.clip(len(ids) // 256, 1, LANES))
    steps = -(-len(ids) // lanes)
    padded = np.zeros(steps * lanes, dtype=np.int64)
    padded[: len(ids)] = ids
    rows = padded.reshape(steps, lanes)
    f, c = freq[rows], below[rows]
    limit = f << np.uint64(63 - PRECISION)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words, marks, emitted = [], [], 0
    for t in range(steps - 1, -1, -1):
        full = state >= limit[t]
        if full.any():
            out = state[full]
            words.append((out & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            emitted += len(out)
            state[full] = out >> np.uint64(32)
        quotient, rest = np.divmod(state, f[t])
        state = (quotient << np.uint64(PRECISION)) + rest + c[t]
        if t % STRIDE == 0:
            marks.append((emitted, state.copy()))
    marks.reverse()
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    segments = [ids[b : b + STRIDE * lanes] for b in range(0, len(ids), STRIDE * lanes)]
    body = b"".join(
        [
            np.array([0 if d is None else d for d, _ in docs], dtype=np.int64).tobytes(),
            np.array([d is None for d, _ in docs], dtype=np.uint8).tobytes(),
            np.array([len(x) for _, x in docs], dtype=np.int64).tobytes(),
            np.array([len(stream) - e for e, _ in marks], dtype=np.int64).tobytes(),
            np.array([zlib.crc32(s.astype("<u4").tobytes()) for s in segments], dtype=np.uint32).tobytes(),
            *[s.tobytes() for _, s in marks],
            stream.tobytes(),
        ]
    )
    return _HEAD.pack(MAGIC, zlib.crc32(body), len(ids), len(docs), lanes, steps, len(marks), len(stream)) + body


class Frame:
    """A block's header and checkpoints; ``segment`` decodes one segment without the others."""

    def __init__(self, data: bytes):
        magic, crc, self.n_ids, n_docs, self.lanes, self.steps, n_marks, n_words = _HEAD.unpack_from(data)
        body = memoryview(data)[_HEAD.size :]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("damaged token block")
        self.at, self.body = 0, body
        doc_ids, missing = self._take(np.int64, n_docs), self._take(np.uint8, n_docs)
        self.doc_ids = [None if m else int(d) for d, m in zip(doc_ids, missing, strict=True)]
        self.sizes = self._take(np.int64, n_docs)
        self.places = self._take(np.int64, n_marks)
        self.checksums = self._take(np.uint32, n_marks)
        self.states = self._take(np.uint64, n_marks * self.lanes).reshape(n_marks, self.lanes)
        self.words = self._take(np.uint32, n_words)

    def _take(self, kind, count: int) -> np.ndarray:
        out = np.frombuffer(self.body, dtype=kind, count=count, offset=self.at)
        self.at += out.nbytes
        return out

    def segment(self, k: int, coder) -> np.ndarray:
        freq, below, symbols = coder
        state, place = self.states[k].copy(), int(self.places[k])
        steps = min(STRIDE, self.steps - k * STRIDE)
        out = np.empty((steps, self.lanes), dtype=np.uint32)
        mask, bits = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION)
        for t in range(steps):
            slot = state & mask
            out[t] = s = symbols[slot]
            state = freq[s] * (state >> bits) + slot - below[s]
            low = state < LOW
            n = int(np.count_nonzero(low))
            if n:
                state[low] = (state[low] << np.uint64(32)) | self.words[place : place + n]
                place += n
        ids = out.ravel()[: self.n_ids - k * STRIDE * self.lanes]
        if zlib.crc32(ids.tobytes()) != self.checksums[k]:
            raise ValueError("damaged token segment")
        return ids

    def documents(self, coder) -> Iterator[tuple[int | None, np.ndarray]]:
        ids = np.concatenate([self.segment(k, coder) for k in range(len(self.places))])
        ends = np.cumsum(self.sizes)
        for d, b, e in zip(self.doc_ids, ends - self.sizes, ends, strict=True):
            yield d, ids[b:e]


def token_rows(docs: DataFrame, path: str, end_id: int, spaces: bool) -> Stored:
    """Ids of each document, stored: doc_id, tie, row, ids (unsigned 16-bit, or 32-bit from 2**16 on)."""

    def run(batches):
        coder = tokenizer(path, spaces)
        width = np.uint16 if coder.library.get_vocab_size() <= 1 << 16 else np.uint32
        for batch in batches:
            ids = coder.encode(batch.column(2).to_pylist())
            packed = [np.append(x, np.uint32(end_id)).astype(width).tobytes() for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "tie", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("tie"), text_or_empty().alias("text"))
    made = rows.mapInArrow(run, "doc_id bigint, tie bigint, ids binary")
    return Stored(made.withColumn("row", F.monotonically_increasing_id()), "token-rows", "zstd")


def count_ids(rows: DataFrame, width, size: int) -> np.ndarray:
    """Occurrences of every id; one row for each id reaches the driver, so the vocabulary bounds it."""

    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=width)
            total += np.bincount(ids, minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    found = rows.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, dtype=np.int64)
    out[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, spaces: bool = False) -> None:
    """Encode all documents and write the token folder ``folder``."""
    spark = docs.sparkSession
    size = tokenizer(tokenizer_path, spaces).library.get_vocab_size()
    width = np.uint16 if size <= 1 << 16 else np.uint32
    rows = token_rows(docs, tokenizer_path, end_id, spaces)
    scaled = scale_counts(count_ids(rows.df, width, size))
    spark.createDataFrame(pa.table({"id": np.arange(size), "frequency": scaled})).coalesce(1).write.parquet(f"{folder}/table")
    coder = tables(scaled)

    def run(batches):
        part, first, waiting, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                waiting.append((d, np.frombuffer(x.as_py(), dtype=width)))
                size += len(waiting[-1][1])
                if size >= BLOCK_IDS:
                    yield block(part, first, size, waiting)
                    first, waiting, size = first + size, [], 0
        if waiting:
            yield block(part, first, size, waiting)

    def block(part, first, size, waiting):
        values = [[part], [first], [size], [encode_frame(waiting, coder)]]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["part", "first", "n_ids", "frame"])

    ranged = rows.df.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
    blocks = ranged.select("doc_id", "ids").mapInArrow(run, "part int, first bigint, n_ids bigint, frame binary")
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    rows.drop()


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    scaled = spark.read.parquet(f"{folder}/table").orderBy("id").toPandas()["frequency"].to_numpy()
    coder = tables(scaled)
    blocks = spark.read.parquet(f"{folder}/blocks")

    def run(batches):
        for batch in batches:
            for part, first, frame in zip(*[batch.column(k) for k in range(3)], strict=True):
                docs = list(Frame(frame.as_py()).documents(coder))
                n = np.array([len(x) for _, x in docs], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d for d, _ in docs], pa.int64()),
                        pa.array(np.full(len(docs), part.as_py(), np.int32)),
                        pa.array(first.as_py() + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array([x.tobytes() for _, x in docs], pa.binary()),
                    ],
                    ["doc_id", "part", "place", "n_tokens", "ids"],
                )

    docs = blocks.select("part", "first", "frame").mapInArrow(
        run, "doc_id bigint, part int, place bigint, n_tokens bigint, ids binary"
    )
    # One row for each partition of the writer, so their number bounds the window and the broadcast.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids"
    )
