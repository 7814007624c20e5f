"""Contiguous shards of nearly equal bytes from global prefix sums.

Sizes are taken in one scan of the texts and stored as narrow rows. These are sorted by doc_id over
range partitions; each partition keeps its running sums, one row for each partition gives the sums
before it, and both together are the global byte position of every document. A document goes to the
shard in which its middle byte lies, so shards are contiguous and each cut is off its target by half
a document at most.

Defined cases: a null text has size 1 and checksum 0, like an empty one; null doc_ids come first; rows
of one doc_id are ordered by checksum and size, repeated rows by their stored number, so even one
doc_id on most rows is dealt over many partitions; an empty table gives no rows; fewer bytes than
shards leave shards empty; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import Stored, text_or_empty


def running(rows: DataFrame) -> DataFrame:
    """Global positions of sorted rows: adds ``before`` (bytes) and ``index`` (rows) ahead of each row."""

    def run(batches):
        part, at, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            ends = size + np.cumsum(sizes)
            extra = [
                pa.array(np.full(len(sizes), part, np.int32)),
                pa.array(ends - sizes),
                pa.array(at + np.arange(len(sizes))),
            ]
            at, size = at + len(sizes), int(ends[-1]) if len(sizes) else size
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["doc_id", "size", "text_crc32", "part", "inner", "place"])

    order = ["doc_id", "text_crc32", "size", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "size", "text_crc32")
    schema = "doc_id bigint, size bigint, text_crc32 bigint, part int, inner bigint, place bigint"
    local = Stored(ranged.mapInArrow(run, schema), "shard-rows").df
    # One row for each partition: their number bounds the window and the broadcast.
    totals = local.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    by_part = Window.orderBy("part")
    totals = totals.select(
        "part",
        (F.sum("bytes").over(by_part) - F.col("bytes")).alias("bytes_before"),
        (F.sum("rows").over(by_part) - F.col("rows")).alias("rows_before"),
    )
    return local.join(F.broadcast(totals), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        (F.col("bytes_before") + F.col("inner")).alias("before"),
        (F.col("rows_before") + F.col("place")).alias("index"),
    )


def assign_shards(docs: DataFrame, n_shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (the document's number in its shard)."""
    text = F.encode(text_or_empty(), "UTF-8")
    sizes = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"),
    )
    placed = running(Stored(sizes.withColumn("row", F.monotonically_increasing_id()), "shard-sizes").df)
    total = placed.agg(F.sum("size")).first()[0] or 1
    shard = F.least(F.expr(f"({n_shards}L * (before * 2 + size)) div {2 * total}L"), F.lit(n_shards - 1)).cast("int")
    dealt = placed.withColumn("shard", shard)
    firsts = dealt.groupBy("shard").agg(F.min("index").alias("first"))  # one row for each shard
    return dealt.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("index") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, assigned: DataFrame, folder: str) -> None:
    """Write the documents below ``folder/shard=k``, sorted by slot; doc_id must be unique here.

    Rows go to writers by slices of slots, so a shard is written by many tasks in order.
    """
    slice_rows = 100_000
    rows = docs.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
    rows = rows.withColumn("slice", F.floor(F.col("slot") / slice_rows))
    rows.repartition("shard", "slice").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
