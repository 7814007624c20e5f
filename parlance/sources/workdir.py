"""Where intermediate tables go: the shared folder the cluster names, never a node's own disk."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Removes what a query exchanged as soon as it has ended, and not when the driver happens to collect it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# How closely the steps of a run are packed, which stay longer than other tables.
STEP_LEVEL = 6
# The tables made inside the innermost ``passing``.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="parlance-")
    spark.conf.set(SETTING, folder)
    return folder


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path for one run; nothing is overwritten or shared between runs."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, mode: str = "errorifexists", level: int = 3) -> None:
    """Write a table, packed with zstd; the files of the write's exchanges are gone when it has ended."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        packed = df.write.mode(mode).option("compression", "zstd")
        packed.option("parquet.compression.codec.zstd.level", str(level)).parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows from a fresh table in the shared folder: what made them runs once.

    The planner knows a stored table's size, so it can tell whether to send it to every task.
    """
    path = new_dir(df.sparkSession, name)
    made = _made.get()
    if made is not None:
        made.append(path)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``stored`` makes inside: for a step whose own result is written inside, too."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            remove(spark, path)


class Fresh:
    """Keeps the steps of one run in tables of its own until they are dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __call__(self, make, name: str) -> DataFrame:
        path = new_dir(self.spark, name)
        with passing(self.spark):
            rows = make()
            save(rows, path, level=STEP_LEVEL)
        self.paths[name] = path
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                remove(self.spark, self.paths.pop(name))
