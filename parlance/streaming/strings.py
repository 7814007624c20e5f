"""Incremental strings: each new file once, memory reuse, memory upsert."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators.memory import latest_tm, tm_lookup
from parlance.sources.datasets import append_tm
from parlance.streaming.tables import stream_table


def stream_new_strings(
    spark: SparkSession,
    folder: str,
    name: str = "events",
    event_id: str = "event_id",
    ts: str = "ts",
    horizon: str = "1 hour",
    sources: int = 1,
) -> DataFrame:
    """Rows of new files, once per event id within the horizon.

    ``sources`` > 1 reads as many feeds of the same files, as after a repeated delivery.
    """
    rows = stream_table(spark, folder, name)
    for _ in range(sources - 1):
        rows = rows.unionByName(stream_table(spark, folder, name))
    rows = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    return rows.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([event_id])


def stream_tm_reuse(stream: DataFrame, tm: DataFrame, **options) -> DataFrame:
    """Stream-static lookup: arriving strings that the memory can answer, and those it cannot."""
    return tm_lookup(stream, tm, **options)


def stream_merge_tm(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Upsert every micro-batch into the memory at ``path``.

    A batch appends a delta named by the checkpoint and its number, at the cost of its own rows. A
    repeated batch replaces its own output, so nothing is merged twice, and two streams or a new
    checkpoint never meet; readers overlay what was appended.
    """
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        append_tm(latest_tm(batch), path, f"{stream_id}-{batch_id:012d}")

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
