"""Stored tables: translation memory, run state, glossary, issue log."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance import schemas
from parlance.operators.memory import latest_tm
from parlance.operators.quality import RunAborted

BASE, DELTA, FOLDED = "version", "delta", "folded"


def _write_rows(df: DataFrame, folder: str) -> None:
    (
        df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.MEMORY])
        .write.mode("overwrite")
        .partitionBy("target_lang", "domain")
        .parquet(folder)
    )


def write_tm(df: DataFrame, path: str, version: int) -> None:
    """Write one complete version of the memory next to the earlier ones.

    The job's commit makes it visible, a repeated write of the same version replaces only that
    version, and readers of older versions are not disturbed.
    """
    _write_rows(df, f"{path}/part={BASE}-{version}")


def append_tm(df: DataFrame, path: str, name: str | int) -> None:
    """Write only the rows that changed, as a delta of that name (a number, or stream and batch).

    The cost is that of the changed rows; ``read_tm`` overlays them, ``compact_tm`` folds them in.
    A repeated write of one name replaces its own rows. Names carry no order: rows are newest by
    their own times, so a delta counts whatever complete versions exist.
    """
    _write_rows(df, f"{path}/part={DELTA}-{name}")


def tm_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed complete versions, oldest first."""
    return sorted(int(n) for n in committed(spark, path, BASE))


def committed(spark: SparkSession, path: str, kind: str) -> list[str]:
    """Names of written folders of a kind, from the folder names and their success marks."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/part={kind}-*/_SUCCESS"))
    names = [m.getPath().getParent().getName() for m in marks or []]
    return sorted(n.split("=", 1)[1].split("-", 1)[1] for n in names)


def _folded(spark: SparkSession, path: str, version: int) -> set[str]:
    """Names of the deltas that a complete version already holds."""
    if str(version) not in committed(spark, path, FOLDED):
        return set()
    return {r.name for r in spark.read.schema("name string").json(f"{path}/part={FOLDED}-{version}").collect()}


def read_tm(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    as_of: str | None = None,
    target_lang: str | None = None,
) -> DataFrame:
    """The newest state, or one complete version; ``as_of`` gives the rows current at that time.

    Deltas that the newest complete version has not folded in are overlaid, newest row per key and
    pair of languages. ``target_lang`` reads that language's folders only.
    """
    if version is not None:
        df, overlaid = _rows(spark, path, f"{path}/part={BASE}-{version}"), False
    else:
        df, overlaid = _history(spark, path)
    if target_lang is not None:
        df = df.filter(F.col("target_lang") == target_lang)
    return latest_tm(df, as_of) if overlaid or as_of is not None else df


def read_tm_history(spark: SparkSession, path: str) -> DataFrame:
    """Every stored version of every row, superseded ones too; input of ``tm_history``."""
    return _history(spark, path)[0]


def _rows(spark: SparkSession, path: str, *folders: str) -> DataFrame:
    """Rows of any number of written folders, as one scan: they are partitions of one table."""
    df = spark.read.schema(schemas.MEMORY).option("basePath", path).parquet(*folders)
    return df.select(*schemas.MEMORY.fieldNames())


def _history(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """All rows of the newest complete version and of the deltas beside it; whether any overlap.

    However many deltas there are, the plan has one scan.
    """
    complete = tm_versions(spark, path)
    folded = _folded(spark, path, complete[-1]) if complete else set()
    deltas = [n for n in committed(spark, path, DELTA) if n not in folded]
    folders = [f"{path}/part={BASE}-{complete[-1]}"] if complete else []
    folders += [f"{path}/part={DELTA}-{n}" for n in deltas]
    if not folders:
        return spark.createDataFrame([], schemas.MEMORY), False
    return _rows(spark, path, *folders), bool(deltas) or bool(folded)


def compact_tm(spark: SparkSession, path: str) -> int | None:
    """Fold all deltas into the next complete version; returns its number, None without deltas.

    Superseded rows are kept, so history and ``as_of`` give the same before and after. The list of
    folded deltas is committed first: a crash between the two leaves the older version valid.
    """
    complete = tm_versions(spark, path)
    done = _folded(spark, path, complete[-1]) if complete else set()
    names = [n for n in committed(spark, path, DELTA) if n not in done]
    if not names:
        return None
    number = complete[-1] + 1 if complete else 0
    listed = spark.createDataFrame([(n,) for n in sorted({*done, *names})], "name string")
    listed.coalesce(1).write.mode("overwrite").json(f"{path}/part={FOLDED}-{number}")
    write_tm(_history(spark, path)[0], path, number)
    return number


def write_state(candidates: DataFrame, path: str) -> None:
    """Hand-over between the two halves of a run, as JSON lines with a schema version."""
    stamped = candidates.withColumn("schema_version", F.lit(schemas.STATE_SCHEMA_VERSION))
    as_schema(stamped, schemas.STATE).write.mode("overwrite").json(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(schemas.STATE).json(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise RunAborted(f"no translation state at {path}; run the translate step first") from exc
        raise


def read_glossary(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Layered terms from JSON-lines files (scope, scope_value, term, preferred, forbidden)."""
    return spark.read.schema(schemas.GLOSSARY).json(paths)


def write_glossary(glossary: DataFrame, path: str) -> None:
    glossary.select(*schemas.GLOSSARY.fieldNames()).write.mode("overwrite").json(path)


def issue_lines(issues: DataFrame) -> DataFrame:
    """One JSON text per issue; absent context fields are left out."""
    fields = [c for c in schemas.ISSUES.fieldNames() if c in issues.columns]
    return issues.select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "true"}).alias("value")
    )


def write_issues(issues: DataFrame, path: str) -> None:
    issue_lines(issues).write.mode("overwrite").text(path)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    return lines.select(F.from_json("value", schemas.ISSUES).alias("i")).select("i.*")


def as_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns to a schema; columns the input lacks become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
