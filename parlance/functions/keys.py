"""Keys, paths and identifiers taken apart and put together with column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.text import as_col
from parlance.schemas import TARGET_LANGUAGE

# .../<mod dir>[/<version>]/Languages/<language>/<domain>[/<def type>]/<file>.<ext>
RESOURCE_PATH = (
    r"([^/]+)(?:/(\d+\.\d+))?/Languages/([^/]+)/"
    r"(?:(DefInjected)/([^/]+)|(Keyed)|(Strings))/(.+)\.(xml|txt)$"
)


def classify_domain_by_key(key: Column | str) -> Column:
    """A dotted key addresses a Def field, a flat one is Keyed."""
    return F.when(F.contains(as_col(key), F.lit(".")), "DefInjected").otherwise("Keyed")


def parse_def_key(key: Column | str) -> Column:
    """def_name, field_path, the path without list indices, the indices, the gender suffix."""
    parts = F.split(as_col(key), r"\.")
    path = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    is_index = lambda p: p.rlike("^[0-9]+$")
    return F.struct(
        parts[0].alias("def_name"),
        F.array_join(path, ".").alias("field_path"),
        F.array_join(F.filter(path, lambda p: ~is_index(p)), ".").alias("field_pattern"),
        F.array_join(F.filter(path, is_index), ",").alias("list_indices"),
        F.regexp_extract(as_col(key), r"(Female|Male)$", 1).alias("gender"),
    )


def parse_resource_path(path: Column | str) -> Column:
    p = as_col(path)
    part = lambda i: F.nullif(F.regexp_extract(p, RESOURCE_PATH, i), F.lit(""))
    return F.struct(
        part(1).alias("mod_dir"),
        part(2).alias("version"),
        part(3).alias("language"),
        F.coalesce(part(4), part(6), part(7)).alias("domain"),
        part(5).alias("def_type"),
        part(8).alias("file_stem"),
    )


def output_path(
    mod_id: Column | str,
    domain: Column | str,
    def_type: Column | str,
    file_stem: Column | str | None = None,
    language: str = TARGET_LANGUAGE,
) -> Column:
    """Target path of a pack file, namespaced by mod; no file stem gives the one-file form."""
    d = as_col(domain)
    ext = F.when(d == "Strings", ".txt").otherwise(".xml")
    name = as_col(mod_id)
    if file_stem is not None:
        stem = as_col(file_stem)
        name = F.concat(name, F.when(stem.isNull(), "").otherwise(F.concat(F.lit("__"), stem)))
    folder = F.when(d == "DefInjected", as_col(def_type))
    return F.concat_ws("/", F.lit(f"Languages/{language}"), d, folder, F.concat(name, ext))


def parse_provider_id(provider_id: Column | str) -> Column:
    """``kind:backend:model``; the model part may itself hold colons."""
    parts = F.split(as_col(provider_id), ":", 3)
    return F.struct(
        F.get(parts, F.lit(0)).alias("kind"),
        F.get(parts, F.lit(1)).alias("backend"),
        F.get(parts, F.lit(2)).alias("model"),
    )
