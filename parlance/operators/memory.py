"""Strings against the translation memory: changes, lookups, history, upsert.

Comparisons carry keys and hashes through the shuffle; texts stay where they are unless the
result needs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import source_hash, value_hash
from parlance.functions.tokens import token_sequence, token_signature
from parlance.operators.skew import key_join, segment_lag
from parlance.schemas import ACCEPTED_REVIEWS, KEY, MEMORY_KEY, TARGET_LANG


def with_hashes(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "value_hash": value_hash("source_text"),
            "source_hash": source_hash("source_text"),
        }
    )


def in_language(tm: DataFrame, target_lang: str | None) -> DataFrame:
    """The memory rows of one target language; all of them for None or a table without languages."""
    if target_lang is None or "target_lang" not in tm.columns:
        return tm
    return tm.filter(F.col("target_lang") == target_lang)


def _keys(df: DataFrame) -> DataFrame:
    known = "value_hash" in df.columns
    return df.select(
        *KEY, F.col("value_hash") if known else value_hash("source_text").alias("value_hash")
    )


def detect_changes(
    strings: DataFrame, tm: DataFrame, target_lang: str | None = TARGET_LANG
) -> DataFrame:
    """new / stale / unchanged / orphaned for every key of either side, in one target language."""

    def side(df: DataFrame) -> DataFrame:
        hashed = df if {"value_hash", "source_hash"} <= set(df.columns) else with_hashes(df)
        return hashed.select(*KEY, "value_hash", "source_hash")

    s = side(strings)
    m = side(in_language(tm, target_lang)).toDF(*[f"m_{c}" for c in (*KEY, "value_hash", "source_hash")])
    joined = s.join(
        m,
        (F.col("mod_id") == F.col("m_mod_id"))
        & (F.col("domain") == F.col("m_domain"))
        & F.col("def_type").eqNullSafe(F.col("m_def_type"))
        & (F.col("key_path") == F.col("m_key_path")),
        "full",
    )
    kind = (
        F.when(F.col("m_key_path").isNull(), "new")
        .when(F.col("key_path").isNull(), "orphaned")
        .when(F.col("value_hash") == F.col("m_value_hash"), "unchanged")
        .otherwise("stale")
    )
    return joined.select(
        *[F.coalesce(k, f"m_{k}").alias(k) for k in KEY],
        kind.alias("change"),
        F.coalesce(F.col("source_hash") == F.col("m_source_hash"), F.lit(False)).alias(
            "same_normalized"
        ),
    )


def new_keys(
    strings: DataFrame, tm: DataFrame, target_lang: str | None = TARGET_LANG
) -> DataFrame:
    return key_join(strings, in_language(tm, target_lang).select(*KEY), KEY, "left_anti")


def orphaned_keys(
    strings: DataFrame, tm: DataFrame, target_lang: str | None = TARGET_LANG
) -> DataFrame:
    return key_join(in_language(tm, target_lang), strings.select(*KEY), KEY, "left_anti")


def stale_keys(
    strings: DataFrame, tm: DataFrame, target_lang: str | None = TARGET_LANG
) -> DataFrame:
    """Same key, reworded English; the previous hash is kept for the report."""
    previous = _keys(in_language(tm, target_lang)).withColumnRenamed("value_hash", "previous_hash")
    return key_join(_keys(strings), previous, KEY, "inner").filter(
        "value_hash <> previous_hash"
    )


def reusable_keys(
    strings: DataFrame, tm: DataFrame, target_lang: str | None = TARGET_LANG
) -> DataFrame:
    """Unchanged strings: they never reach a translator again."""
    known = "value_hash" in strings.columns
    s = strings if known else strings.withColumn("value_hash", value_hash("source_text"))
    return key_join(s, _keys(in_language(tm, target_lang)), (*KEY, "value_hash"), "left_semi")


def accepted(tm: DataFrame) -> DataFrame:
    return tm.filter(
        (F.col("validation_status") == "passed") & F.col("review_status").isin(*ACCEPTED_REVIEWS)
    )


def tm_lookup(
    strings: DataFrame,
    tm: DataFrame,
    cross_mod_types: tuple[str, ...] | None = (),
    carry: tuple[str, ...] = (),
    target_lang: str | None = TARGET_LANG,
) -> DataFrame:
    """Best accepted translation per string: own mod first, then other mods (``tm_hits``).

    Only keys, hashes and memory ids travel through the lookups; the texts of the memory are
    exchanged once, by id, for the rows that were found.
    """
    return with_texts(tm_hits(strings, tm, cross_mod_types, carry, target_lang), tm, target_lang)


def tm_hits(
    strings: DataFrame,
    tm: DataFrame,
    cross_mod_types: tuple[str, ...] | None = (),
    carry: tuple[str, ...] = (),
    target_lang: str | None = TARGET_LANG,
) -> DataFrame:
    """``tm_id`` and ``tm_scope`` of the best memory row for every string, without any text.

    Both lookup tables hold one row per lookup key, made by a combining aggregate, so a join never
    multiplies rows.

    Masked hashes make different tokens look equal; a hit therefore counts only if the stored
    translation carries exactly the string's tokens. ``cross_mod_types`` names the semantic types
    opted in to reuse across mods; None allows every type. Only rows of ``target_lang`` count. ``carry`` names columns of ``strings``
    to take along.
    """
    tm = in_language(tm, target_lang)
    s = strings.select(
        *KEY,
        "semantic_type",
        source_hash("source_text").alias("source_hash"),
        token_signature("source_text").alias("signature"),
        *carry,
    )
    rows = accepted(tm).select(
        F.col("mod_id").alias("tm_mod"),
        F.col("semantic_type").alias("tm_sem"),
        F.col("source_hash").alias("tm_hash"),
        # The signature belongs to the lookup key: a row with other tokens is no candidate.
        token_signature("translation").alias("tm_signature"),
        "updated_at",
        "id",
    )
    keys = ["tm_hash", "tm_signature", "tm_sem"]
    own = rows.groupBy("tm_mod", *keys).agg(F.max(F.struct("updated_at", "id")).alias("newest"))
    anyone = own.groupBy(*keys).agg(F.min(F.struct("tm_mod", "newest")).alias("first_mod"))
    same = (
        F.col("source_hash").eqNullSafe(F.col("tm_hash"))
        & F.col("signature").eqNullSafe(F.col("tm_signature"))
        & F.col("semantic_type").eqNullSafe(F.col("tm_sem"))
    )
    allowed = (
        F.lit(True)
        if cross_mod_types is None
        else F.coalesce(F.col("semantic_type").isin(*cross_mod_types), F.lit(False))
    )
    own_id, any_id = F.col("own_id"), F.when(allowed, F.col("first_mod.newest.id"))
    return (
        s.join(own, (F.col("mod_id") == F.col("tm_mod")) & same, "left")
        .select(*s.columns, F.col("newest.id").alias("own_id"))
        .join(anyone, same, "left")
        .select(
            *KEY,
            "semantic_type",
            "source_hash",
            *carry,
            F.coalesce(own_id, any_id).alias("tm_id"),
            F.when(own_id.isNotNull(), "same_mod")
            .when(any_id.isNotNull(), "cross_mod")
            .alias("tm_scope"),
        )
    )


def with_texts(found: DataFrame, tm: DataFrame, target_lang: str | None = TARGET_LANG) -> DataFrame:
    """``tm_translation`` for the rows that have a ``tm_id``, in its place."""
    # Strings without a hit get a spread-out join key, or all of them would meet in one task.
    texts = in_language(tm, target_lang).select(F.col("id").alias("_id"), F.col("translation").alias("tm_translation"))
    spread_key = F.coalesce("tm_id", F.xxhash64("mod_id", "domain", "key_path"))
    hit = (F.col("_join") == F.col("_id")) & F.col("tm_id").isNotNull()
    return (
        found.withColumn("_join", spread_key).join(texts, hit, "left").drop("_join", "_id", "tm_id")
    )


def coverage_vs_existing(strings: DataFrame, existing: DataFrame) -> DataFrame:
    """Which keys already have a text in the target language."""
    e = existing.groupBy(*KEY).agg(F.lit(True).alias("known"))
    return key_join(strings.select(*KEY), e, KEY, "left").select(
        *KEY, F.coalesce("known", F.lit(False)).alias("has_translation")
    )


def latest_tm(tm: DataFrame, as_of: str | None = None, keys=MEMORY_KEY) -> DataFrame:
    """Newest row per key; ``row_number() = 1`` is limited per partition before the shuffle."""
    rows = tm if as_of is None else tm.filter(F.col("updated_at") <= F.to_timestamp(F.lit(as_of)))
    w = Window.partitionBy(*keys).orderBy(F.col("updated_at").desc(), F.col("id").desc())
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def tm_history(tm: DataFrame, segment: Column | None = None) -> DataFrame:
    """Previous English and previous translation of every stored version."""
    return segment_lag(
        tm,
        list(MEMORY_KEY),
        ["updated_at", "id"],
        F.to_date("updated_at") if segment is None else segment,
        {"previous_source": "source_text", "previous_translation": "translation"},
    )


def merge_tm(tm: DataFrame, updates: DataFrame) -> DataFrame:
    """Current rows after an upsert. Superseded rows stay in the stored history."""
    return latest_tm(tm.unionByName(updates, allowMissingColumns=True))


def cross_mod_duplicates(strings: DataFrame, approximate: bool = False) -> DataFrame:
    """Identical (normalized text, semantic type) used by at least two mods."""
    base = strings.select(
        "mod_id", "semantic_type", source_hash("source_text").alias("source_hash")
    )
    if approximate:
        grouped = base.groupBy("source_hash", "semantic_type").agg(
            F.approx_count_distinct("mod_id").alias("mods"), F.count(F.lit(1)).alias("strings")
        )
    else:
        # Two combining steps instead of a distinct expansion: a hot text shrinks to one row per
        # mod before the second exchange.
        grouped = (
            base.groupBy("source_hash", "semantic_type", "mod_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("source_hash", "semantic_type")
            .agg(F.count(F.lit(1)).alias("mods"), F.sum("n").alias("strings"))
        )
    return grouped.filter("mods >= 2")


def translation_key(df: DataFrame) -> DataFrame:
    """Add the columns two strings must share to share one translation.

    The normalized hash ignores which token stands where, so the token sequence belongs to it.
    """
    return df.withColumns(
        {
            "source_hash": source_hash("source_text"),
            "token_sequence": token_sequence("source_text"),
        }
    )


SHARED = ("source_hash", "token_sequence", "semantic_type")


def unique_sources(strings: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct text and semantic type: all that a translator has to see."""
    return translation_key(strings).groupBy(*SHARED, *by).agg(
        F.min("source_text").alias("source_text"), F.count(F.lit(1)).alias("uses")
    )


def fan_out_translations(
    strings: DataFrame, unique_translations: DataFrame, by: tuple[str, ...] = ()
) -> DataFrame:
    """Copy each distinct text's translation to every key that uses it."""
    keys = (*SHARED, *by)
    result = [c for c in unique_translations.columns if c not in (*keys, *strings.columns)]
    u = unique_translations.select(*keys, *result)
    return key_join(translation_key(strings), u, keys, "left").select(*strings.columns, *result)
