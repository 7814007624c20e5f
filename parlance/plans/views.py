"""Localization tables derived from the general-purpose tables of a data folder.

The texts carry no placeholders, so tokens, memory rows and damage are added by fixed rules of the
row's own columns. Every view covers all rows and whole texts of its base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.text import normalize_source, source_hash, value_hash
from parlance.operators.rules import SemanticRule, classify_semantic_type, template_key
from parlance.operators.skew import spread
from parlance.schemas import MEMORY
from parlance.sources.datasets import as_schema
from parlance.sources.workdir import new_dir, save


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The text table, spread over the cores when it comes as one split."""
    return spread(table(spark, folder, "documents").select("doc_id", *columns), "doc_id")


OVERRIDES = (
    SemanticRule("letter_message", "Short notification.", keyed_key_pattern="^Letter.*"),
    SemanticRule("quest_text", "Quest narration.", keyed_key_pattern="^Quest.*"),
)


def strings(spark: SparkSession, folder: str) -> DataFrame:
    """Current source strings, one per document."""
    return strings_of(documents(spark, folder, "text", "lang", "source"))


def strings_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("source").alias("mod_id"),
        "doc_id",
        F.expr(
            "case doc_id % 3 when 0 then 'DefInjected' when 1 then 'Keyed' else 'Strings' end"
        ).alias("domain"),
        F.expr(
            "case when doc_id % 3 = 0 then case doc_id % 4 when 0 then 'ThingDef'"
            " when 1 then 'HediffDef' when 2 then 'TraitDef' else 'GeneDef' end end"
        ).alias("def_type"),
        F.expr(
            "case doc_id % 3 when 0 then concat('Def', doc_id, '.label')"
            " when 1 then concat(case doc_id % 5 when 0 then 'Letter' when 1 then 'Quest'"
            " else 'Msg' end, doc_id)"
            " else concat('pool', doc_id % 4, '.txt#', doc_id) end"
        ).alias("key_path"),
        F.expr(
            "case doc_id % 3 when 0 then concat('Defs_', lang) when 1 then concat('Texts_', lang)"
            " else concat('pool', doc_id % 4) end"
        ).alias("file"),
        F.expr(
            r"concat(text, ' {0} {1} {PAWN_nameDef}',"
            r" case when doc_id % 4 = 0 then ' <b>[pawn_nameFull]</b>' else '' end,"
            r" case when doc_id % 6 = 1 then '\\n' else '' end)"
        ).alias("source_text"),
        "lang",
    )


def typed_strings(spark: SparkSession, folder: str) -> DataFrame:
    return classify_semantic_type(strings(spark, folder), OVERRIDES)


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Review outcome per document, one row each.

    Stored, so that the planner knows how small it is before the texts are dealt for a join with it.
    """
    rows = (
        table(spark, folder, "labels")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    )
    return stored(spark, rows, "labels")


def memory(spark: SparkSession, folder: str) -> DataFrame:
    """Earlier snapshot, for reviewed (labelled) documents.

    toxic = 1: the English was reworded since; quality = 0: the key is gone by now; every
    eleventh translation has lost a placeholder.
    """
    joined = typed_strings(spark, folder).join(labels(spark, folder), "doc_id")
    old_text = F.when(
        F.col("toxic") == 1, F.concat("source_text", F.lit(" reworded"))
    ).otherwise(F.col("source_text"))
    rows = joined.withColumns(
        {
            "source_text": old_text,
            "key_path": F.when(
                F.col("quality") == 0, F.concat("key_path", F.lit("_old"))
            ).otherwise(F.col("key_path")),
        }
    ).withColumns(
        {
            "id": F.col("doc_id"),
            "source_lang": F.lit("en"),
            "target_lang": F.lit("ru"),
            "normalized_source": normalize_source("source_text"),
            "source_hash": source_hash("source_text"),
            "value_hash": value_hash("source_text"),
            "translation": F.concat(
                F.lit("[RU] "),
                F.when(
                    F.col("doc_id") % 11 == 0,
                    F.replace("source_text", F.lit("{0}"), F.lit("")),
                ).otherwise(F.col("source_text")),
            ),
            "mod_version": F.lit("1.0"),
            "provider": F.expr("concat('p', doc_id % 2)"),
            "prompt_version": F.lit("v1"),
            "validation_status": F.lit("passed"),
            "review_status": F.expr(
                "case when doc_id % 5 = 0 then 'unreviewed' else 'human_accepted' end"
            ),
            "created_at": F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")),
        }
    )
    return as_schema(rows.withColumn("updated_at", F.col("created_at")), MEMORY)


def updates(spark: SparkSession, folder: str) -> DataFrame:
    """A later memory version of every current string."""
    return updates_of(typed_strings(spark, folder))


def updates_of(typed: DataFrame) -> DataFrame:
    rows = typed.withColumns(
        {
            "id": F.col("doc_id") + 1_000_000_000,
            "source_lang": F.lit("en"),
            "target_lang": F.lit("ru"),
            "normalized_source": normalize_source("source_text"),
            "source_hash": source_hash("source_text"),
            "value_hash": value_hash("source_text"),
            "translation": F.concat(F.lit("[RU2] "), F.col("source_text")),
            "mod_version": F.lit("1.1"),
            "provider": F.lit("p2"),
            "prompt_version": F.lit("v2"),
            "validation_status": F.lit("passed"),
            "review_status": F.lit("unreviewed"),
            "created_at": F.timestamp_seconds(F.lit(1735689600) + F.col("doc_id")),
        }
    )
    return as_schema(rows.withColumn("updated_at", F.col("created_at")), MEMORY)


def history(spark: SparkSession, folder: str) -> DataFrame:
    return memory(spark, folder).unionByName(updates(spark, folder))


# How a candidate is damaged, by doc_id % 9; the other rows stay whole.
DAMAGE = r"""case doc_id % 9
 when 0 then replace(source_text, '{0}', '')
 when 1 then replace(source_text, '{PAWN_nameDef}', '{pawn_namedef}')
 when 2 then concat(source_text, ' {0} {0}')
 when 3 then replace(source_text, '<b>', '')
 when 4 then replace(source_text, '[pawn_nameFull]', '')
 when 5 then concat(source_text, '\\n')
 when 6 then concat(source_text, ' <3')
 else source_text end"""


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """One translation attempt per string."""
    return typed_strings(spark, folder).select(
        "*",
        F.expr("concat('p', doc_id % 2)").alias("provider_id"),
        F.lit("v1").alias("prompt_version"),
        F.concat(F.lit("[RU] "), F.expr(DAMAGE)).alias("translated_text"),
        F.lit("pending").alias("validation_status"),
        F.lit("unreviewed").alias("review_status"),
    )


def two_passes(spark: SparkSession, folder: str) -> DataFrame:
    """Every string translated by p0 (damaged) and p1 (every fifth word dropped for some)."""
    base = candidates(spark, folder).drop("provider_id")
    p = F.explode(F.array(F.lit("p0"), F.lit("p1"))).alias("provider_id")
    second = F.expr("case when doc_id % 2 = 0 then concat('[RU] ', source_text) else translated_text end")
    return base.select("*", p).withColumn(
        "translated_text",
        F.when(F.col("provider_id") == "p1", second).otherwise(F.col("translated_text")),
    )


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """Raw file entries whose keys repeat inside a file and across files."""
    return documents(spark, folder, "source", "text").select(
        F.col("source").alias("mod_id"),
        F.expr("concat('f', doc_id % 3, '_', doc_id div 6000, '.xml')").alias("file"),
        F.col("doc_id").alias("pos"),
        F.expr("concat('K', doc_id div 120)").alias("key"),
        F.col("text").alias("value"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Provider runs: who, on what, when, how long, whether it failed."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("key"),
        F.col("event_type").alias("provider"),
        F.col("value").alias("latency"),
        k.alias("tokens"),
        (k < 20).alias("failed"),
    )


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table written once and read back, as glossaries are kept; cuts what was derived."""
    path = new_dir(spark, name)
    save(df, path)
    return spark.read.schema(df.schema).parquet(path)


def glossary_from_memory(spark: SparkSession, folder: str) -> DataFrame:
    """Layered terms taken from reviewed texts: toxic ones mod-wide, low quality by type."""
    base = (
        typed_strings(spark, folder)
        .join(labels(spark, folder), "doc_id")
        .select("*", template_key("source_text").alias("term"))
    )
    scope = (
        F.when(F.col("toxic") == 1, "mod")
        .when((F.col("quality") == 0) & F.col("semantic_type").isNotNull(), "semantic_type")
        .otherwise("global")
    )
    value = F.when(F.col("scope") == "mod", F.col("mod_id")).when(
        F.col("scope") == "semantic_type", F.col("semantic_type")
    )
    rows = base.withColumn("scope", scope).select(
        "scope",
        value.alias("scope_value"),
        "term",
        F.concat(F.lit("RU:"), F.col("key_path"), F.lit(" {0} {1} {PAWN_nameDef}")).alias(
            "preferred"
        ),
        F.array().cast("array<string>").alias("forbidden"),
    )
    return stored(spark, rows, "glossary")


def word_glossary(spark: SparkSession) -> DataFrame:
    """A small configured term list over frequent words of the texts."""
    rows = [
        ("global", None, "the", "G-the", ["teh", "[RU] the"]),
        ("global", None, "of the", "G-of-the", ["of that"]),
        ("global", None, "that", "G-that", []),
        ("global", None, "la", "G-la", ["le"]),
        ("global", None, "der", "G-der", ["die"]),
        ("mod", "src1", "the", "M1-the", ["and"]),
        ("mod", "src2", "that", "M2-that", []),
        ("semantic_type", "thing_label", "the", "T-the", ["of"]),
        ("semantic_type", "quest_text", "que", "Q-que", ["de la"]),
    ]
    return spark.createDataFrame(
        rows, "scope string, scope_value string, term string, preferred string, forbidden array<string>"
    )


def providers(spark: SparkSession) -> DataFrame:
    rows = [
        ("view", "local", "model-a", 120.0, 2, 16),
        ("click", "local", "model-b", 60.0, 1, 32),
        ("purchase", "remote", "model-c", 60.0, 1, 64),
        ("signup", "remote", "model-d", 30.0, 0, 8),
        ("p0", "local", "model-e", 60.0, 2, 7),
        ("p1", "remote", "model-f", 60.0, 2, 11),
    ]
    return spark.createDataFrame(
        rows,
        "id string, kind string, model string, timeout_seconds double, max_retries int,"
        " max_batch_size int",
    )


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Reference text and a hypothesis in which every fifth word is missing."""
    docs = documents(spark, folder, "source", "lang", "text")
    w = F.split("text", r"[ \n]+")
    kept = F.filter(w, lambda x, i: i % 5 != 4)
    return docs.select(
        "doc_id",
        "source",
        "lang",
        F.col("text").alias("reference"),
        F.array_join(kept, " ").alias("hypothesis"),
    )


def mods(spark: SparkSession, folder: str) -> DataFrame:
    """One mod per crawled page: id from the page, name from its host."""
    return table(spark, folder, "pages").select(
        F.concat(F.lit("mod."), F.lpad(F.col("page_id").cast("string"), 9, "0")).alias("mod_id"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
    ).select("mod_id", F.concat(F.col("host"), F.lit(" & <friends>")).alias("name"))


def pool_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line pools: every document is one pool file."""
    docs = documents(spark, folder, "source", "text")
    return docs.select(
        F.col("source").alias("mod_id"),
        F.expr("concat('pool', doc_id, '.txt')").alias("file"),
        F.col("text"),
    )


