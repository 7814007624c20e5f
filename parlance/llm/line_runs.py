"""Line dedup by levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends and with A-Z in lower case; the index
holds 128-bit hashes of keys with the number of documents they were found in. Documents come in
batches. A batch counts its own keys, drops those that the runs have already decided (found in
``min_docs`` documents or more) by a merge anti-join, and adds the rest as one sorted run of level 0.
When a level holds ``fanout`` runs they are compacted into one run of the next level, in which counts
of equal keys are summed. Runs are bucketed by hash, so the join exchanges the batch, never a run.
The keys of all runs whose counts reach ``min_docs`` together are the frequent ones; all their lines go.

Defined cases: every row is a document, also one that repeats another or has no doc_id; a null or
empty text has one empty line; keys shorter than ``min_chars`` code points are never counted, so
empty lines stay; a document whose lines all go keeps an empty text; an empty table gives no rows;
a very long text is one document like any other and its lines are sent on in bounded slices; other
columns are passed through; input columns n_lines and n_dropped are replaced.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import Stored, stored
from parlance.sources.workdir import new_dir

SLICE_BYTES = 8_000_000  # text whose keys one slice of a task counts before it hands them on
BUCKET_ROWS = 4_000_000  # counts that one bucket of a run should hold
COLUMNS = "hash binary, docs bigint"


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\x0b\x0c\r").lower()  # of bytes: ASCII letters only


def key_hash(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def hashes_of(text: bytes | None, min_chars: int) -> set[bytes]:
    """Hashes of the different keys of a text."""
    keys = {line_key(line) for line in (text or b"").split(b"\n")}
    return {key_hash(k) for k in keys if long_enough(k, min_chars)}


def count_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(batch, hash, docs) of (batch, text) rows, counted by slices of text; a key may have several rows."""

    def rows(counts: dict) -> pa.RecordBatch:
        batches, hashes = zip(*counts, strict=True)
        columns = [pa.array(batches, pa.int32()), pa.array(hashes, pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["batch", "hash", "docs"])

    def run(batches):
        counts, size = {}, 0
        for batch in batches:
            for number, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                number, text = number.as_py(), text.as_py()
                for h in hashes_of(text, min_chars):
                    counts[number, h] = counts.get((number, h), 0) + 1
                size += len(text or b"")
                if size > SLICE_BYTES and counts:
                    yield rows(counts)
                    counts, size = {}, 0
        if counts:
            yield rows(counts)

    return docs.mapInArrow(run, f"batch int, {COLUMNS}")


class LineIndex:
    """Levelled sorted runs of (hash, docs) in the shared folder; one batch is added at a time.

    A run is a bucketed table of the session's catalog over files of the shared folder. It is written
    whole before it is listed, so a lost executor or a repeated batch write leaves the listed runs as
    they are.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3, buckets: int = 64):
        self.spark, self.min_docs, self.fanout, self.buckets = spark, min_docs, fanout, buckets
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.folder = new_dir(spark, "line-runs")
        self.levels: list[list[str]] = []
        self.written = 0

    def _summed(self, first: DataFrame, *others: DataFrame) -> DataFrame:
        """One row for each hash, dealt as the runs are; rows come counted by slice or by run.

        Runs are given as files: a union of bucketed tables passes for dealt by hash, which Spark
        4.1 does not keep to when it runs it, so that equal hashes stayed apart.
        """
        for other in others:
            first = first.union(other)
        return first.select("hash", "docs").repartition(self.buckets, "hash").groupBy("hash").agg(F.sum("docs").alias("docs"))

    def _write(self, rows: DataFrame, level: int) -> None:
        table, self.written = f"{self.name}_{self.written}", self.written + 1
        writer = rows.select("hash", "docs").write.bucketBy(self.buckets, "hash").sortBy("hash")
        writer.option("path", f"{self.folder}/{table}").format("parquet").saveAsTable(table)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table)

    def _rows(self, table: str) -> DataFrame:
        return self.spark.read.schema(COLUMNS).parquet(f"{self.folder}/{table}")

    def _drop(self, tables: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for table in tables:
            self.spark.sql(f"drop table {table}")
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
            path.getFileSystem(conf).delete(path, True)

    def _compact(self, level: int) -> None:
        """Merge a full level into one run of the next; the merged runs go after it is written."""
        merged = self.levels[level]
        self._write(self._summed(*map(self._rows, merged)), level + 1)
        self.levels[level] = []
        self._drop(merged)
        if len(self.levels[level + 1]) >= self.fanout:
            self._compact(level + 1)

    def add(self, counted: DataFrame) -> None:
        """Take in a batch: rows (hash, docs), several for a hash if need be."""
        own = self._summed(counted)
        for tables in self.levels:
            for table in tables:
                decided = self.spark.table(table).where(F.col("docs") >= self.min_docs).select("hash")
                own = own.join(decided.hint("merge"), "hash", "left_anti")
        self._write(own, 0)
        if len(self.levels[0]) >= self.fanout:
            self._compact(0)

    def frequent(self) -> DataFrame:
        """Hashes found in ``min_docs`` documents or more, stored; the runs stay for further batches."""
        runs = [self._rows(t) for tables in self.levels for t in tables]
        if not runs:
            return self.spark.createDataFrame([], "hash binary")
        return stored(self._summed(*runs).where(F.col("docs") >= self.min_docs).select("hash"), "frequent-lines")

    def close(self) -> None:
        self._drop([t for tables in self.levels for t in tables])
        self.levels = []


def document_key() -> Column:
    """128 bits of a document's id and text: rows with one key lose the same lines."""
    whole = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def drop_lines(docs: DataFrame, frequent: DataFrame, min_chars: int = 1) -> DataFrame:
    """The documents with the lines of frequent keys taken out of ``text``; adds n_lines and n_dropped.

    Input columns of these two names give way. Only (document, hash) rows meet the frequent hashes.
    Whether these, and then the documents' own lists, are sent to every task is left to the planner's
    check of their stored size.
    """

    def pairs_of(ids: list, hashes: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(hashes, pa.binary())], ["_key", "hash"])

    def found(batches):
        for batch in batches:
            ids, hashes, size = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                text = text.as_py() or b""
                own = hashes_of(text, min_chars)
                ids += [key.as_py()] * len(own)
                hashes += own
                size += len(text)
                if size > SLICE_BYTES:
                    yield pairs_of(ids, hashes)
                    ids, hashes, size = [], [], 0
            yield pairs_of(ids, hashes)

    def cut(batches):
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, gone in zip(batch.column("text").cast(pa.binary()), batch.column("_gone"), strict=True):
                stay = every = (text.as_py() or b"").split(b"\n")
                gone = set(gone.as_py() or ())
                if gone:
                    stay = [x for x in every if not (long_enough(k := line_key(x), min_chars) and key_hash(k) in gone)]
                kept.append(b"\n".join(stay))
                lines.append(len(every))
                dropped.append(len(every) - len(stay))
            columns = {c: batch.column(c) for c in names}
            columns["text"] = pa.array(kept, pa.binary()).cast(pa.string(), safe=False)
            columns |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    pairs = docs.select(document_key().alias("_key"), "text").mapInArrow(found, "_key binary, hash binary")
    gone = pairs.join(frequent, "hash", "left_semi").groupBy("_key").agg(F.collect_set("hash").alias("_gone"))
    rows = docs.withColumn("_key", document_key()).join(stored(gone, "lines-to-drop"), "_key", "left").drop("_key")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped"))])
    return rows.mapInArrow(cut, schema)


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, batches: int = 4, fanout: int = 3) -> DataFrame:
    """Hashes of the keys found in ``min_docs`` documents or more, taken in batch by batch.

    Documents are dealt to batches by a checksum of their id and text. One scan counts all batches.
    """
    spark = docs.sparkSession
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int")
    kept = Stored(count_keys(docs.select(number.alias("batch"), "text"), min_chars), "line-counts")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), kept.df.count() // BUCKET_ROWS)
    index = LineIndex(spark, min_docs, fanout, buckets)
    for k in range(batches):
        index.add(kept.df.where(F.col("batch") == k))
    out = index.frequent()
    index.close()
    kept.drop()
    return out


def dedup_lines(docs: DataFrame, min_docs: int, min_chars: int = 1, **settings) -> DataFrame:
    """The documents without the lines found in ``min_docs`` of them; adds n_lines and n_dropped."""
    return drop_lines(docs, frequent_lines(docs, min_docs, min_chars, **settings), min_chars)
