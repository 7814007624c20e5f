"""A transactional sink for trees of text files, as a Spark data source.

Rows are (path, line), dealt by path and sorted within their task. A task streams the lines of a file
one batch after the other into a draft and moves each finished draft into the staged tree, so a task
that is run again, or twice at a time, only replaces its files by equal ones. When all tasks are
done, the commit marks the staged tree as complete and exchanges it for the published folder as a
whole: files of earlier runs that are not written again are gone, and readers never see half a tree.
A commit that was interrupted after its mark is finished by ``recover``, one before it is undone. The
file system must be able to rename folders.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "parlance_files"
STAGED, COMPLETE = "_staged-", "COMPLETE"


def file_system(place: str) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path and the path in it."""
    if place.startswith("file:"):  # a plain path behind its scheme, no URI with escapes
        return fs.LocalFileSystem(), "/" + place.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(place.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme as Spark resolves it, so that files go where Spark reads them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return found.replace("file:/", "file:///", 1) if found.startswith("file:/") and "://" not in found else found


@dataclass
class Written(WriterCommitMessage):
    files: int
    lines: int


class TreeWriter(DataSourceArrowWriter):
    """Writes one staged tree. ``head``, ``foot`` and ``empty`` are the fixed texts around the lines."""

    def __init__(self, options: dict):
        self.out, self.root = options["path"], options["root"]
        self.head, self.foot, self.empty = (options.get(k, "").encode() for k in ("head", "foot", "empty"))
        self.staged = posixpath.join(self.out, STAGED + uuid.uuid4().hex)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        target, staged = file_system(self.staged)
        drafts = posixpath.join(staged, "drafts", uuid.uuid4().hex)
        target.create_dir(drafts, recursive=True)
        path, stream, lines, done = None, None, 0, Written(0, 0)

        def close() -> None:
            stream.write((self.foot if lines else self.empty))
            stream.close()
            final = posixpath.join(staged, "tree", path)
            target.create_dir(posixpath.dirname(final), recursive=True)
            target.move(posixpath.join(drafts, str(done.files)), final)
            done.files += 1
            done.lines += lines

        for batch in batches:
            # A line that is null only says that the file exists.
            for of, line in zip(batch.column("path"), batch.column("line").cast(pa.binary()), strict=True):
                if (of := of.as_py()) != path:
                    if stream is not None:
                        close()
                    path, lines = of, 0
                    stream = target.open_output_stream(posixpath.join(drafts, str(done.files)))
                if (line := line.as_py()) is not None:
                    stream.write((b"\n" if lines else self.head) + line)
                    lines += 1
        if stream is not None:
            close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        target, staged = file_system(self.staged)
        target.create_dir(posixpath.join(staged, "tree", self.root), recursive=True)
        with target.open_output_stream(posixpath.join(staged, COMPLETE)) as mark:
            mark.write(self.root.encode())
        publish(target, staged)

    def abort(self, messages: list[Written | None]) -> None:
        target, staged = file_system(self.staged)
        if target.get_file_info(staged).type == fs.FileType.Directory:
            target.delete_dir(staged)


def publish(target: fs.FileSystem, staged: str) -> None:
    """Exchange a complete staged tree for the published one; safe to repeat from any point."""
    with target.open_input_stream(posixpath.join(staged, COMPLETE)) as mark:
        root = mark.read().decode()
    new, old = posixpath.join(staged, "tree", root), posixpath.join(staged, "old")
    final = posixpath.join(posixpath.dirname(staged), root)
    there = lambda path: target.get_file_info(path).type == fs.FileType.Directory
    if there(new):  # until it is moved, what is published is the old tree
        if there(final):
            target.move(final, old)
        target.create_dir(posixpath.dirname(final), recursive=True)
        target.move(new, final)
    target.delete_dir(staged)


def recover(place: str) -> None:
    """Finish commits that were interrupted after their mark; drop what was staged without one."""
    target, out = file_system(place)
    if target.get_file_info(out).type != fs.FileType.Directory:
        return
    for found in target.get_file_info(fs.FileSelector(out)):
        if found.base_name.startswith(STAGED):
            if target.get_file_info(posixpath.join(found.path, COMPLETE)).type == fs.FileType.File:
                publish(target, found.path)
            else:
                target.delete_dir(found.path)


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> TreeWriter:
        return TreeWriter(self.options)


def write_tree(
    lines: DataFrame, order: list[str], out: str, root: str, head: str = "", foot: str = "", empty: str = ""
) -> None:
    """Publish ``lines`` (path below ``out``, line, and the columns of ``order``) as the folder ``root``.

    Every path must lie below ``root``, which is replaced as a whole. One writer at a time. A file is
    written by one task, whatever its size, and no task holds more of it than a batch.
    """
    spark = lines.sparkSession
    place = qualified(spark, out)
    recover(place)
    spark.dataSource.register(TreeSource)
    dealt = lines.repartition("path").sortWithinPartitions("path", *order).select("path", "line")
    writer = dealt.write.format(FORMAT).mode("append").option("path", place).option("root", root)
    writer.option("head", head).option("foot", foot).option("empty", empty).save()
