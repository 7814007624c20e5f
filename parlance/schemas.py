"""Column names, fixed vocabularies and schemas shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# These vocabularies are part of the data model.
DOMAINS = ("DefInjected", "Keyed", "Strings")
PROVIDER_KINDS = ("local", "remote")
VALIDATION_STATUSES = ("pending", "passed", "failed")
REVIEW_STATUSES = ("unreviewed", "auto_accepted", "human_accepted", "rejected")
DEFAULT_GAME_VERSION = "1.6"
SOURCE_LANGUAGE = "English"
TARGET_LANGUAGE = "Russian"
STATE_SCHEMA_VERSION = 2
# Language codes of memory rows; lookups see one pair unless they are given another.
SOURCE_LANG = "en"
TARGET_LANG = "ru"

ACCEPTED_REVIEWS = ("auto_accepted", "human_accepted")

# One string is identified by these four columns (def_type may be null).
KEY = ("mod_id", "domain", "def_type", "key_path")
# A memory row belongs to one string and one pair of languages.
MEMORY_KEY = (*KEY, "source_lang", "target_lang")

STRINGS = T.StructType(
    [
        T.StructField("mod_id", T.StringType(), False),
        T.StructField("domain", T.StringType(), False),
        T.StructField("key_path", T.StringType(), False),
        T.StructField("source_text", T.StringType(), False),
        T.StructField("def_type", T.StringType()),
        T.StructField("semantic_type", T.StringType()),
    ]
)

STATE_COLUMNS = (
    "mod_id",
    "domain",
    "key_path",
    "source_text",
    "def_type",
    "semantic_type",
    "translated_text",
    "provider_id",
    "prompt_version",
    "validation_status",
    "review_status",
    "file",
)

STATE = T.StructType(
    [T.StructField("schema_version", T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in STATE_COLUMNS]
    + [T.StructField("idx", T.LongType())]
)

MEMORY = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source_lang", T.StringType()),
        T.StructField("target_lang", T.StringType()),
        T.StructField("source_text", T.StringType()),
        T.StructField("normalized_source", T.StringType()),
        T.StructField("source_hash", T.StringType()),
        T.StructField("value_hash", T.StringType()),
        T.StructField("translation", T.StringType()),
        T.StructField("mod_id", T.StringType()),
        T.StructField("mod_version", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("def_type", T.StringType()),
        T.StructField("key_path", T.StringType()),
        T.StructField("semantic_type", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("prompt_version", T.StringType()),
        T.StructField("validation_status", T.StringType()),
        T.StructField("review_status", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

ENTRIES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

MANIFESTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("mod_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("supported_versions", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

GLOSSARY = T.StructType(
    [
        T.StructField("scope", T.StringType()),
        T.StructField("scope_value", T.StringType()),
        T.StructField("term", T.StringType()),
        T.StructField("preferred", T.StringType()),
        T.StructField("forbidden", T.ArrayType(T.StringType())),
    ]
)

PROVIDERS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("quantization", T.StringType()),
        T.StructField("timeout_seconds", T.DoubleType()),
        T.StructField("max_retries", T.IntegerType()),
        T.StructField("structured_output", T.BooleanType()),
        T.StructField("max_batch_size", T.IntegerType()),
    ]
)

ISSUES = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("logger", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("mod_id", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("exc_info", T.StringType()),
    ]
)
