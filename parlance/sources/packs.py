"""Writers for output packs: lines rendered by expressions, published by the tree sink.

A pack file holds the accepted entries of one (mod, domain, def type, source file) in a fixed order.
Its lines are rows until the sink streams them out, so no value and no task holds a whole file.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.keys import output_path
from parlance.functions.text import XML_NAME, comment_safe, xml_escape
from parlance.operators.quality import filter_emittable
from parlance.schemas import DEFAULT_GAME_VERSION, TARGET_LANGUAGE
from parlance.sources.pack_sink import file_system, qualified, write_tree

# How the serialised files begin and are indented.
DECLARATION = "<?xml version='1.0' encoding='utf-8'?>\n"
INDENT = "  "


def element(tag: Column, text: Column, indent: str = INDENT) -> Column:
    """One indented element on its own line; an empty text gives an empty-element tag."""
    full = F.concat(F.lit("<"), tag, F.lit(">"), xml_escape(text), F.lit("</"), tag, F.lit(">"))
    return F.concat(
        F.lit(indent), F.when(text == "", F.concat(F.lit("<"), tag, F.lit(" />"))).otherwise(full)
    )


def invalid_keys(candidates: DataFrame) -> DataFrame:
    """Keys that cannot be element names and so cannot go into an XML pack."""
    return candidates.filter((F.col("domain") != "Strings") & ~F.col("key_path").rlike(XML_NAME))


def _xml_lines(candidates: DataFrame, path: Column, require_review: bool) -> DataFrame:
    """(path, mod_id, key_path, line) of the accepted entries, and a line of null for every file."""
    placed = candidates.withColumn("path", path)
    line = F.concat(
        F.lit(INDENT + "<!--"),
        comment_safe("source_text"),
        F.lit("-->\n"),
        element(F.col("key_path"), F.col("translated_text")),
    )
    files = placed.select("path", "mod_id").distinct()
    return (
        filter_emittable(placed, require_review)
        .select("path", "mod_id", "key_path", line.alias("line"))
        .unionByName(files.select("*", F.lit("").alias("key_path"), F.lit(None).cast("string").alias("line")))
    )


def keyed_lines(candidates: DataFrame, language: str = TARGET_LANGUAGE, require_review: bool = False) -> DataFrame:
    """Entries of the Keyed packs: one file for each mod."""
    path = output_path("mod_id", F.lit("Keyed"), F.lit(None), None, language)
    return _xml_lines(candidates.filter("domain = 'Keyed'"), path, require_review)


def definjected_lines(candidates: DataFrame, language: str = TARGET_LANGUAGE, require_review: bool = False) -> DataFrame:
    """Entries of the DefInjected packs: one file for each mod, def type and source file."""
    path = output_path("mod_id", F.lit("DefInjected"), "def_type", "file", language)
    return _xml_lines(candidates.filter("domain = 'DefInjected'"), path, require_review)


def string_lines(candidates: DataFrame, language: str = TARGET_LANGUAGE, require_review: bool = False) -> DataFrame:
    """Lines of the pools in index order, newlines written as two characters."""
    path = output_path("mod_id", F.lit("Strings"), F.lit(None), "file", language)
    pools = filter_emittable(candidates.filter("domain = 'Strings'"), require_review)
    line = F.replace("translated_text", F.lit("\n"), F.lit("\\n"))
    return pools.select(path.alias("path"), "mod_id", "idx", line.alias("line"))


XML = {"head": DECLARATION + "<LanguageData>\n", "foot": "\n</LanguageData>\n", "empty": DECLARATION + "<LanguageData />\n"}
POOL = {"foot": "\n"}


def _written(lines: DataFrame) -> DataFrame:
    return lines.groupBy("path", "mod_id").agg(F.count("line").alias("entries"))


def write_keyed_pack(
    candidates: DataFrame, out: str, language: str = TARGET_LANGUAGE, require_review: bool = False
) -> DataFrame:
    """Publish the folder of the domain as a whole; returns path, mod_id and entries of its files."""
    lines = keyed_lines(candidates, language, require_review)
    write_tree(lines, ["key_path", "line"], out, f"Languages/{language}/Keyed", **XML)
    return _written(lines)


def write_definjected_pack(
    candidates: DataFrame, out: str, language: str = TARGET_LANGUAGE, require_review: bool = False
) -> DataFrame:
    lines = definjected_lines(candidates, language, require_review)
    write_tree(lines, ["key_path", "line"], out, f"Languages/{language}/DefInjected", **XML)
    return _written(lines)


def write_strings_pack(
    candidates: DataFrame, out: str, language: str = TARGET_LANGUAGE, require_review: bool = False
) -> DataFrame:
    lines = string_lines(candidates, language, require_review)
    write_tree(lines, ["idx", "line"], out, f"Languages/{language}/Strings", **POOL)
    return _written(lines)


def write_files(files: DataFrame, out: str) -> None:
    """Write small (path, text) rows as files below ``out``; safe to repeat after a lost executor."""
    place = qualified(files.sparkSession, out)

    def write(rows: Iterable) -> None:
        target, root = file_system(place)
        folder = None
        for row in rows:
            final = posixpath.join(root, row["path"])
            if folder != posixpath.dirname(final):
                folder = posixpath.dirname(final)
                target.create_dir(folder, recursive=True)
            draft = f"{final}.{uuid.uuid4().hex}.tmp"
            with target.open_output_stream(draft) as stream:
                stream.write(row["text"].encode("utf-8"))
            target.move(draft, final)

    files.select("path", "text").foreachPartition(write)


@dataclass(frozen=True)
class ManifestOptions:
    """Overridable fields of the generated manifest."""

    name: str = "Translation Pack [RU]"
    author: str = "parlance"
    package_id: str = "parlance.translationpack.ru"
    game_version: str = DEFAULT_GAME_VERSION


def join_mod_names(mods: DataFrame) -> DataFrame:
    """The description list, ", "-joined in id order, as ordered pieces (mod_id, piece).

    Concatenated in mod_id order the pieces are the list; no row ever holds all names.
    """
    first = mods.select(F.min("mod_id")).scalar()
    comma = F.when(F.col("mod_id") == first, "").otherwise(", ")
    return mods.select("mod_id", F.concat(comma, F.col("name")).alias("piece"))


def render_manifest(mods: DataFrame, options: ManifestOptions = ManifestOptions()) -> DataFrame:
    """Manifest text as ordered pieces (section, mod_id, text).

    The pieces in (section, mod_id) order, concatenated, are the file. Sections that list mods
    take their frame from the first and last mod id, so they vanish when there are no mods.
    """
    spark = mods.sparkSession
    first, last = mods.select(F.min("mod_id")).scalar(), mods.select(F.max("mod_id")).scalar()
    at_first, at_last = F.col("mod_id") == first, F.col("mod_id") == last
    opened = lambda text: F.when(at_first, text).otherwise("")
    closed = lambda text: F.when(at_last, text).otherwise("")

    def plain(tag: str, value: str, indent: str = INDENT) -> Column:
        return F.concat(element(F.lit(tag), F.lit(value), indent), F.lit("\n"))

    dependency = F.concat(
        opened("  <modDependencies>\n"),
        F.lit("    <li>\n"),
        element(F.lit("packageId"), F.col("mod_id"), INDENT * 3),
        F.lit("\n"),
        element(F.lit("displayName"), F.col("name"), INDENT * 3),
        F.lit("\n    </li>\n"),
        closed("  </modDependencies>\n"),
    )
    load_after = F.concat(
        opened("  <loadAfter>\n"),
        element(F.lit("li"), F.col("mod_id"), INDENT * 2),
        F.lit("\n"),
        closed("  </loadAfter>\n"),
    )
    names = F.explode(
        F.array(
            F.struct(F.lit(1).alias("section"), xml_escape("piece").alias("text")),
            F.struct(F.lit(3).alias("section"), F.col("dependency").alias("text")),
            F.struct(F.lit(4).alias("section"), F.col("load_after").alias("text")),
        )
    )
    comma = F.when(at_first, "").otherwise(", ")
    per_mod = mods.select(
        "mod_id",
        F.concat(comma, F.col("name")).alias("piece"),
        dependency.alias("dependency"),
        load_after.alias("load_after"),
    ).select("mod_id", names.alias("p"))
    per_mod = per_mod.select("p.section", "mod_id", "p.text")

    head = F.concat(
        F.lit(DECLARATION + "<ModMetaData>\n"),
        plain("name", options.name),
        plain("author", options.author),
        plain("packageId", options.package_id),
        F.lit("  <description>Russian translation for: "),
    )
    nobody = F.when(F.isnull(first), "no source mods").otherwise("")
    middle = F.concat(
        nobody,
        F.lit(".</description>\n  <supportedVersions>\n"),
        plain("li", options.game_version, INDENT * 2),
        F.lit("  </supportedVersions>\n"),
    )
    frame = spark.range(1).select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("section"), head.alias("text")),
                F.struct(F.lit(2).alias("section"), middle.alias("text")),
                F.struct(F.lit(5).alias("section"), F.lit("</ModMetaData>\n").alias("text")),
            )
        ).alias("p")
    )
    return per_mod.unionAll(frame.select("p.section", F.lit("").alias("mod_id"), "p.text"))


def write_manifest(
    mods: DataFrame, out: str, options: ManifestOptions = ManifestOptions()
) -> None:
    """Write ``About/About.xml``: one file, streamed in order by one task.

    Its pieces are a few hundred bytes a mod; the sort spills, and no row holds more than one piece.
    """
    ordered = render_manifest(mods, options).coalesce(1).sortWithinPartitions("section", "mod_id")
    place = qualified(mods.sparkSession, out)

    def write(rows: Iterable) -> None:
        target, root = file_system(place)
        folder = posixpath.join(root, "About")
        target.create_dir(folder, recursive=True)
        draft = posixpath.join(folder, f"About.xml.{uuid.uuid4().hex}.tmp")
        with target.open_output_stream(draft) as stream:
            for row in rows:
                stream.write(row["text"].encode("utf-8"))
        target.move(draft, posixpath.join(folder, "About.xml"))

    ordered.foreachPartition(write)
