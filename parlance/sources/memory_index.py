"""The memory kept in buckets by what it is searched for: joins with it exchange the strings only.

An index belongs to one complete version of a stored memory and to one target language. It has four
tables, each dealt into the same number of buckets and sorted by its join column: the keys, the newest
accepted row per mod and lookup, the one per lookup, and the texts by id.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.text import source_hash
from parlance.functions.tokens import token_signature
from parlance.operators.memory import accepted, in_language, with_hashes
from parlance.schemas import KEY, TARGET_LANG
from parlance.sources import datasets

# Table -> its columns; the first one is the join column, which the table is dealt and sorted by.
TABLES = {
    "keys": "key binary, mod_id string, domain string, def_type string, key_path string,"
    " value_hash string, source_hash string",
    "own": "mod_lookup binary, lookup binary, tm_mod string, updated_at timestamp, id bigint",
    "anyone": "lookup binary, id bigint",
    "texts": "id bigint, translation string",
}
MARK = "name string, buckets int"


@dataclass(frozen=True)
class MemoryIndex:
    """Tables of one index in the session's catalog, under a common first name."""

    spark: SparkSession
    name: str

    def table(self, part: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{part}")


def digest(*columns: str) -> Column:
    """A full-width digest that no other values share: lengths go before values, nulls have a mark."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _lookup_keys(df: DataFrame, signed: str) -> DataFrame:
    """Add ``lookup``, and ``mod_lookup`` for rows of a mod; ``signed`` holds the tokens that count."""
    marked = df.withColumn("_signature", token_signature(signed).cast("string"))
    looked = marked.withColumn("lookup", digest("source_hash", "_signature", "semantic_type")).drop("_signature")
    of_mod = F.unhex(F.sha2(F.concat(F.hex("lookup"), F.col("mod_id")), 256))
    return looked.withColumn("mod_lookup", of_mod)


def _register(spark: SparkSession, folder: str, name: str, buckets: int) -> MemoryIndex:
    """Make an index known to this session; its files may stem from another one."""
    for part, columns in TABLES.items():
        by = columns.split(" ", 1)[0]
        spark.sql(
            f"create table if not exists {name}_{part} ({columns}) using parquet"
            f" clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{folder}/{name}/{part}'"
        )
    return MemoryIndex(spark, name)


def _fill(index: MemoryIndex, part: str, rows: DataFrame, buckets: int) -> None:
    """Rows are dealt as the buckets are, so each bucket is one file."""
    columns = [c.split(" ", 1)[0] for c in TABLES[part].split(", ")]
    rows.select(*columns).repartition(buckets, columns[0]).write.insertInto(f"{index.name}_{part}")


def open_index(
    spark: SparkSession, path: str, target_lang: str | None = TARGET_LANG, buckets: int | None = None
) -> MemoryIndex:
    """The index of the newest state of the memory at ``path``, built if that state has none yet.

    Rows appended beside the newest complete version are folded in first, so that the index answers
    for all of them. ``buckets`` counts for building only; by default there are as many as the session
    has shuffle partitions. A session with more of these than buckets may exchange the memory again.

    Every build writes to a place of its own, and a mark written last makes it the index of its
    version: a build that was stopped, or two at a time, do no harm.
    """
    datasets.compact_tm(spark, path)
    versions = datasets.tm_versions(spark, path)
    folder = f"{path}/index-{target_lang}-{versions[-1] if versions else 'none'}"
    try:
        mark = spark.read.schema(MARK).json(f"{folder}/mark").first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        mark = None
    if mark is not None:
        return _register(spark, folder, mark["name"], mark["buckets"])
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = _register(spark, folder, f"memory_{uuid.uuid4().hex}", count)
    tm = in_language(datasets.latest_tm(datasets.read_tm(spark, path)), target_lang)
    _fill(index, "keys", tm.withColumn("key", digest(*KEY)), count)
    _fill(index, "texts", tm, count)
    newest = F.max(F.struct("updated_at", "id")).alias("n")
    looked = _lookup_keys(accepted(tm), "translation").filter("mod_lookup is not null")
    own = looked.groupBy("mod_lookup", "lookup", F.col("mod_id").alias("tm_mod")).agg(newest)
    _fill(index, "own", own.select("mod_lookup", "lookup", "tm_mod", "n.*"), count)
    first = F.min_by("id", F.struct("tm_mod", "updated_at", "id")).alias("id")
    _fill(index, "anyone", index.table("own").groupBy("lookup").agg(first), count)
    made = spark.createDataFrame([(index.name, count)], MARK)
    made.coalesce(1).write.mode("overwrite").json(f"{folder}/mark")
    return index


def indexed_changes(strings: DataFrame, index: MemoryIndex) -> DataFrame:
    """``detect_changes`` against an index. Keys meet by their digest, the only exchange is the strings'."""
    hashed = strings if {"value_hash", "source_hash"} <= set(strings.columns) else with_hashes(strings)
    s = hashed.select(digest(*KEY).alias("_key"), *KEY, "value_hash", "source_hash")
    names = [*KEY, "value_hash", "source_hash"]
    m = index.table("keys").select("key", *[F.col(c).alias(f"m_{c}") for c in names])
    kind = (
        F.when(F.col("key").isNull(), "new")
        .when(F.col("_key").isNull(), "orphaned")
        .when(F.col("value_hash") == F.col("m_value_hash"), "unchanged")
        .otherwise("stale")
    )
    return s.join(m, F.col("_key") == F.col("key"), "full").select(
        *[F.when(F.col("_key").isNull(), F.col(f"m_{k}")).otherwise(F.col(k)).alias(k) for k in KEY],
        kind.alias("change"),
        F.coalesce(F.col("source_hash") == F.col("m_source_hash"), F.lit(False)).alias("same_normalized"),
    )


def indexed_lookup(
    strings: DataFrame,
    index: MemoryIndex,
    cross_mod_types: tuple[str, ...] | None = (),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``tm_lookup`` against an index: three joins, each exchanging keys, hashes and ids of the strings.

    Strings of one text and mod share a join key; the memory side has one row for it, and the
    runtime's splitting of skewed partitions deals the strings of a hot one over many tasks.
    """
    hashed = strings.withColumn("source_hash", source_hash("source_text"))
    s = _lookup_keys(hashed, "source_text").select(
        *KEY, "semantic_type", "source_hash", *carry,
        F.col("lookup").alias("_lookup"), F.col("mod_lookup").alias("_mod_lookup"),
    )
    allowed = F.lit(True)
    if cross_mod_types is not None:
        allowed = F.coalesce(F.col("semantic_type").isin(*cross_mod_types), F.lit(False))
    own = index.table("own").select("mod_lookup", F.col("id").alias("_own"))
    anyone = index.table("anyone").select("lookup", F.col("id").alias("_any"))
    texts = index.table("texts").select(F.col("id").alias("_id"), F.col("translation").alias("tm_translation"))
    found = s.join(own, F.col("_mod_lookup") == F.col("mod_lookup"), "left").drop("mod_lookup", "_mod_lookup")
    found = found.join(anyone, F.col("_lookup") == F.col("lookup"), "left")
    other = F.when(allowed, F.col("_any"))
    scope = F.when(F.col("_own").isNotNull(), "same_mod").when(other.isNotNull(), "cross_mod")
    kept = found.select(
        *KEY, "semantic_type", "source_hash", *carry, F.coalesce("_own", other).alias("_hit"), scope.alias("tm_scope")
    )
    # Strings without a hit get a spread-out join key, or all of them would meet in one task.
    placed = kept.withColumn("_join", F.coalesce("_hit", F.xxhash64("mod_id", "domain", "key_path")))
    joined = placed.join(texts, (F.col("_join") == F.col("_id")) & F.col("_hit").isNotNull(), "left")
    return joined.select(*KEY, "semantic_type", "source_hash", *carry, "tm_scope", "tm_translation")
