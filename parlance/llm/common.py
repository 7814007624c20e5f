"""Shared pieces of the training-data operators: tables, stored stages, ranges, small helpers."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.sources.workdir import new_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Stored:
    """A table written to the shared folder, so that no later step depends on an executor's memory.

    It is read with the schema it was written with: to look it up in the files takes a job for each
    reading, and every job costs the driver memory (4 MB for each broadcast of its stages and scans).
    """

    def __init__(self, df: DataFrame, name: str, codec: str = "snappy"):
        self.spark, self.schema = df.sparkSession, df.schema
        self.path = new_dir(self.spark, name)
        df.write.option("compression", codec).parquet(self.path)

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        """Remove the files; for stages that no returned frame reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    return Stored(df, name, codec).df


BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of a few hundred rows, unless the session asks for fewer.

    Spark's own 10,000 rows are 50 MB and more of whole texts, which a task holds several times over:
    in the JVM's buffers, in the worker's and as Python values. Counts of rows are all that can be set.
    """
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc32(data: bytes | memoryview) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` for functions that treat every batch alone."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def text_slices(column: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of consecutive rows with about ``limit`` bytes of text or fewer, or one long text."""
    begin, size = 0, 0
    for row, length in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
        if row > begin and size + length > limit:
            yield begin, column.slice(begin, row - begin).to_pylist()
            begin, size = row, 0
        size += length
    if len(column) > begin:
        yield begin, column.slice(begin).to_pylist()


def binary_column(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())
