"""Best-fit packing in bulk-synchronous rounds.

Documents become pieces of at most ``capacity`` tokens; full pieces fill a sequence each. The others
are packed in rounds. A round sorts the waiting pieces and the gaps of open sequences by size, largest
first, and sweeps once over both: a gap goes one level up, a piece one level down, so a piece and the
gap it meets on its level are each other's best fit (the smallest gap that no larger piece has taken).
Equal sizes are told apart by rank. The sweep is distributed: counts by (size, kind, bucket), at most
``2 * capacity * BUCKETS`` of them, give every group its starting level, ranks inside a group give
every row its own, and rows then meet by level. Levels hold at most ``2 * capacity`` rows. Matched
gaps shrink, and the next round begins from the stored result. New sequences are opened for the
tokens that wait, at first and whenever a round places few pieces.

Defined cases: null and empty texts are a piece of the end id alone; repeated rows and repeated or
null doc_ids are separate documents; equal lengths are ranked by a hash of their piece's number; an
empty table gives no pieces; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import Stored, text_or_empty
from parlance.llm.tokens import tokenizer

BUCKETS = 8
FEW = 0.05  # a round that places a smaller share of the waiting pieces opens new sequences

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, spaces: bool = True) -> Stored:
    """Token pieces of all documents, stored with a number ``piece_id``; the first piece is the short one."""

    def run(batches):
        coder = tokenizer(tokenizer_path, spaces)
        width = np.uint16 if coder.library.get_vocab_size() <= 1 << 16 else np.uint32
        for batch in batches:
            rows = []
            for d, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.append(ids, np.uint32(end_id))
                cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids), capacity), len(ids)]
                for k, (b, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[b:e]
                    rows.append((d, k, b, e - b, zlib.crc32(part.astype("<u4").tobytes()), part.astype(width).tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            )

    made = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, PIECE_SCHEMA)
    return Stored(made.withColumn("piece_id", F.monotonically_increasing_id()), "pieces", "zstd")


def sweep(rows: DataFrame) -> DataFrame:
    """One round: every row of both sides with the row it is matched to, if any.

    ``rows`` has kind (0 gap, 1 piece), id, size, used. The result adds mate_id, mate_size, mate_used,
    null for rows without a match.
    """
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int"))
    group = ["size", "kind", "bucket"]
    order = [F.col("size").desc(), "kind", "bucket"]
    step = F.when(F.col("kind") == 0, F.col("n")).otherwise(-F.col("n"))
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select(*group, (F.sum(step).over(Window.orderBy(*order)) - step).alias("from"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("id"))
    levelled = rows.withColumn("rank", rank).join(starts, group)
    level = F.when(F.col("kind") == 0, F.col("from") + F.col("rank")).otherwise(F.col("from") - F.col("rank") + 1)
    levelled = levelled.select("kind", "id", "size", "used", level.alias("level"))
    on_level = Window.partitionBy("level").orderBy(F.col("size").desc(), "kind")
    row = F.struct("kind", "id", "size", "used")
    mate = F.when(F.col("kind") == 1, F.lag(row).over(on_level)).otherwise(F.lead(row).over(on_level))
    found = levelled.withColumn("mate", mate)
    good = F.col("mate.kind") != F.col("kind")
    return found.select(
        "kind", "id", "size", "used", *[F.when(good, F.col(f"mate.{c}")).alias(f"mate_{c}") for c in ("id", "size", "used")]
    )


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """Place rows (id, size) with sizes from 1 to ``capacity``: id, sequence_id, offset."""
    spark = items.sparkSession
    full = F.col("size") == capacity
    piece, matched = F.col("kind") == 1, F.col("mate_id").isNotNull()
    whole = items.where(full).select("id", F.col("id").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    none = F.lit(0).cast("bigint")
    rows = items.where(~full).select(F.lit(1).alias("kind"), "id", F.col("size").cast("bigint").alias("size"), none.alias("used"))
    opened, rounds = 0, []
    left, tokens, large = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0)), F.count(F.when(F.col("size") * 2 > capacity, 1))
    ).first()
    more = max(math.ceil(tokens / capacity), large)
    while left:
        if more:
            new = spark.range(more).select(
                F.lit(0).alias("kind"),
                (-1 - opened - F.col("id")).alias("id"),
                F.lit(capacity).cast("bigint").alias("size"),
                none.alias("used"),
            )
            rows, opened = rows.unionByName(new), opened + more
        done = Stored(sweep(rows), "packing-round")
        rounds.append(done)
        before = left
        left, tokens, least = done.df.where(piece & ~matched).agg(
            F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0)), F.min("size")
        ).first()
        # Pieces without a mate wait on as they are, gaps with what their mate leaves.
        taken = F.coalesce(F.col("mate_size"), F.lit(0))
        open_ = (piece & ~matched) | (~piece & (F.col("size") - taken >= (least or capacity)))
        rows = done.df.where(open_).select("kind", "id", (F.col("size") - taken).alias("size"), (F.col("used") + taken).alias("used"))
        more = math.ceil(tokens / capacity) if before - left < FEW * before else 0
    if not rounds:
        return whole
    # All rounds have one schema and are read at once.
    done = spark.read.schema(rounds[0].schema).parquet(*[r.path for r in rounds]).where(piece & matched)
    return whole.unionByName(done.select("id", F.col("mate_id").alias("sequence_id"), F.col("mate_used").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, spaces: bool = True) -> DataFrame:
    """Pieces of all documents with their ids and places; ``sequences`` joins them to whole sequences."""
    made = pieces(docs, tokenizer_path, end_id, capacity, spaces)
    places = pack(made.df.select(F.col("piece_id").alias("id"), F.col("length").alias("size")), capacity)
    return made.df.join(places, F.col("piece_id") == F.col("id")).drop("id")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, length and the pieces' ids joined in order (at most one capacity)."""
    part = F.struct("offset", "length", "ids")
    return (
        packed.groupBy("sequence_id")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + p["length"]).alias("length"),
            F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        )
    )
