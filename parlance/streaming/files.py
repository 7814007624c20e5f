"""Pool files that are delivered again and again: the lines of those that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators.merging import line_digest
from parlance.operators.skew import key_join
from parlance.sources.datasets import committed
from parlance.sources.workdir import stored

FILE = ["mod_id", "file"]
LINES, DELTA, FULL = "lines", "digests", "folded"
STATE = (
    "mod_id string, file string, version bigint, at bigint,"
    " digest struct<n bigint, s0 decimal(30,0), s1 decimal(30,0), s2 decimal(30,0), s3 decimal(30,0)>"
)


def _folder(path: str, kind: str, batch: int) -> str:
    return f"{path}/part={kind}-{batch:012d}"


def file_digests(spark: SparkSession, path: str, before: int) -> DataFrame:
    """(mod_id, file, version, at, digest): the newest of every file, from batches before that number."""
    full = [int(n) for n in committed(spark, path, FULL) if int(n) < before][-1:]
    later = [int(n) for n in committed(spark, path, DELTA) if int(n) < before and int(n) > (full or [-1])[0]]
    folders = [_folder(path, FULL, n) for n in full] + [_folder(path, DELTA, n) for n in later]
    if not folders:
        return spark.createDataFrame([], STATE)
    rows = spark.read.schema(STATE).parquet(*folders)
    newest = F.max_by(F.struct("version", "at", "digest"), F.struct("version", "at")).alias("n")
    return rows.groupBy(*FILE).agg(newest).select(*FILE, "n.*")


def stream_changed_files(stream: DataFrame, path: str, checkpoint: str, fold_every: int = 32) -> None:
    """Write the lines of new and changed files of every micro-batch below ``path``.

    ``stream`` has (mod_id, file, version, idx, line), none of the first three null; a delivery of a
    file is whole within a batch. Of several in one batch the highest version counts, and an older
    one than that already seen counts for nothing. The state by file is a full-width digest of its lines
    (``line_digest``), kept as a table: a state operator would hold all lines of a file in one task,
    while here sums are combined before the exchange, and a file of any size is spread.

    A batch appends the digests that are new, all of them are folded together every ``fold_every``
    batches, and state is read in one scan. A repeated batch reads the state before it and replaces
    its own output.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = batch.groupBy(*FILE).agg(F.max("version").alias("version"))
        lines = stored(key_join(batch, newest, [*FILE, "version"], "left_semi"), "delivered")
        now = key_join(line_digest(lines), lines.groupBy(*FILE).agg(F.max("version").alias("version")), FILE, "inner")
        seen = file_digests(spark, path, number).select(*FILE, F.col("version").alias("_v"), F.col("digest").alias("_d"))
        both = key_join(now, seen, FILE, "left").filter("_v is null or version >= _v")
        both = both.withColumn("changed", ~F.col("digest").eqNullSafe(F.col("_d")))
        news = stored(both.filter("changed or version > _v"), "digests")
        changed = key_join(lines, news.filter("changed").select(*FILE), FILE, "left_semi")
        changed.write.mode("overwrite").parquet(_folder(path, LINES, number))
        rows = news.select(*FILE, "version", F.lit(number).cast("bigint").alias("at"), "digest")
        rows.write.mode("overwrite").parquet(_folder(path, DELTA, number))
        if (number + 1) % fold_every == 0:
            file_digests(spark, path, number + 1).write.mode("overwrite").parquet(_folder(path, FULL, number))

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def changed_lines(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """Lines that one batch wrote, by default the last one."""
    numbers = [int(n) for n in committed(spark, path, LINES)]
    return spark.read.parquet(_folder(path, LINES, numbers[-1] if batch is None else batch))
