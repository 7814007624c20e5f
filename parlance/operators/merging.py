"""Raw entries merged into one key space, set operations over keys and tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import each
from parlance.functions.tokens import MECHANISMS, tokens_of
from parlance.operators.skew import segment_rows
from parlance.schemas import KEY
from parlance.sources.workdir import stored


def last_value_in_file(entries: DataFrame) -> DataFrame:
    """Inside one file a repeated key keeps its first position and its last value."""
    return entries.groupBy("mod_id", "file", "key").agg(
        F.max_by("value", "pos").alias("value"), F.min("pos").alias("pos")
    )


def merge_keyed_files(entries: DataFrame) -> DataFrame:
    """Across files, in name order, the first file's value wins.

    Both rules in one aggregation: the lowest file, then the highest position inside it. Partial
    results are combined before the shuffle, so a key repeated in very many files stays cheap.
    """
    winner = F.min_by(
        F.struct("value", "file"), F.struct(F.col("file"), (-F.col("pos")).alias("latest_first"))
    )
    return (
        entries.groupBy("mod_id", "key")
        .agg(winner.alias("winner"))
        .select("mod_id", "key", "winner.file", "winner.value")
    )


def duplicate_key_report(entries: DataFrame) -> DataFrame:
    """Keys that occur in more than one file of a mod."""
    return (
        entries.groupBy("mod_id", "key", "file")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("mod_id", "key")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("n").alias("entries"),
            F.min("file").alias("kept_file"),
        )
        .filter("files > 1")
    )


def resolve_load_order(entries: DataFrame, load_order: DataFrame) -> DataFrame:
    """For an identical key the mod loaded latest wins."""
    placed = entries.join(load_order, "mod_id")
    return (
        placed.groupBy("key")
        .agg(F.max_by(F.struct("mod_id", "value"), F.struct("position", "mod_id")).alias("w"))
        .select("key", F.col("w.mod_id").alias("mod_id"), F.col("w.value").alias("value"))
    )


def union_domains(keyed: DataFrame, definjected: DataFrame, pools: DataFrame) -> DataFrame:
    """One string table; columns a domain lacks become null."""
    both = keyed.unionByName(definjected, allowMissingColumns=True)
    return both.unionByName(pools, allowMissingColumns=True)


def key_set_integrity(source: DataFrame, output: DataFrame, keys=KEY) -> DataFrame:
    """Keys lost or invented on the way, with their side. Kept keys are not returned."""
    sides = source.select(*keys, F.lit(1).alias("s"), F.lit(0).alias("o")).unionAll(
        output.select(*keys, F.lit(0), F.lit(1))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.max("s").alias("s"), F.max("o").alias("o"))
        .filter("s + o = 1")
        .select(*keys, F.when(F.col("s") == 1, "lost").otherwise("invented").alias("status"))
    )


def token_multiset_diff(candidates: DataFrame, mechanism: str, identity: list[str]) -> DataFrame:
    """Missing and extra tokens with counts, one row per string and distinct token."""
    assert mechanism in MECHANISMS

    def counted(column: str, sign: int) -> DataFrame:
        return candidates.select(
            *identity,
            each(tokens_of(mechanism, column)).alias("token"),
            F.lit(sign).alias("sign"),
        ).filter("token is not null")

    return (
        counted("translated_text", 1)
        .unionAll(counted("source_text", -1))
        .groupBy(*identity, "token")
        .agg(F.sum("sign").alias("delta"))
        .filter("delta <> 0")
        .select(
            *identity,
            "token",
            F.when(F.col("delta") < 0, "missing").otherwise("extra").alias("kind"),
            F.abs("delta").alias("n"),
        )
    )


def order_pack(accepted: DataFrame) -> DataFrame:
    """Position of every entry inside its pack file, by code point of the key, pool lines by index.

    Rows are dealt by ranges of file and key, so a large file is spread over many tasks; a row's
    position is its number in its range plus the sizes of the file's earlier ranges.
    """
    pool = F.col("domain") == "Strings"
    index = F.when(pool, F.col("idx")) if "idx" in accepted.columns else F.lit(None)
    source = F.when(F.col("domain") != "Keyed", F.col("file")) if "file" in accepted.columns else F.lit(None)
    placed = accepted.withColumns({"_file": source.cast("string"), "_idx": index.cast("bigint")})
    keys, order = ["mod_id", "domain", "def_type", "_file"], ["_idx", "key_path"]
    dealt = placed.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    numbered = segment_rows(stored(dealt, "pack-order"), keys, order, F.col("_range"), {})
    return numbered.select(*accepted.columns, F.col("_rn").alias("position"))


def rediff_changed_files(lines: DataFrame, old_lines: DataFrame) -> DataFrame:
    """Every line of a pool file in which any line was added, changed or removed.

    Lines have no stable key, so a file is compared by a digest of its lines as a multiset: the number
    of lines, and four sums that take in all 256 bits of every line's hash. Sums are combined before
    the shuffle: no file's text is gathered anywhere.
    """
    now, before = line_digest(lines), line_digest(old_lines)
    both = now.join(before.withColumnRenamed("digest", "old"), ["mod_id", "file"], "left")
    changed = both.filter(~F.col("digest").eqNullSafe(F.col("old"))).select("mod_id", "file")
    return lines.join(changed, ["mod_id", "file"], "left_semi")


def line_digest(lines: DataFrame) -> DataFrame:
    """(mod_id, file, digest) of (idx, line) rows, whatever their order."""
    mark = F.sha2(F.concat_ws("\u0001", "idx", "line"), 256)
    marked = lines.select("mod_id", "file", mark.alias("_mark"))
    lanes = [F.conv(F.substring("_mark", 1 + 16 * k, 16), 16, 10).cast("decimal(20,0)") for k in range(4)]
    return marked.groupBy("mod_id", "file").agg(
        F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{k}") for k, x in enumerate(lanes)]).alias("digest")
    )
