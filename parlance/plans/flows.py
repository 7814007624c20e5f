"""The two halves of a run, composed from the operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import value_hash
from parlance.operators.gates import ALL_GATES, require_filled, validate
from parlance.operators.memory import SHARED, fan_out_translations, unique_sources
from parlance.operators.providers import PASSTHROUGH, Provider, provider_disagreement, translate_with
from parlance.operators.quality import fail_if_any, filter_emittable
from parlance.operators.routing import RouterPolicy, assign_review_status, low_agreement, route_tiers, with_reuse
from parlance.operators.rules import glossary_terms_in_text
from parlance.operators.skew import key_join
from parlance.schemas import KEY
from parlance.sources.datasets import read_state, write_state
from parlance.sources.memory_index import MemoryIndex
from parlance.sources.packs import (
    ManifestOptions,
    invalid_keys,
    write_definjected_pack,
    write_keyed_pack,
    write_manifest,
    write_strings_pack,
)
from parlance.sources.workdir import Fresh, stored


# How a flow keeps a step: (what makes it, its name) -> the rows from a stored table. With a method
# ``drop(*names)`` it is told which steps no later one reads.
Keep = Callable[[Callable[[], DataFrame], str], DataFrame]


def keep_fresh(make: Callable[[], DataFrame], name: str) -> DataFrame:
    return stored(make(), name)


def translate_unique(
    unique: DataFrame,
    policy: RouterPolicy,
    local: Provider,
    remote: Provider,
    gates: tuple[str, ...],
    keep: Keep = keep_fresh,
    second: Provider | None = None,
) -> DataFrame:
    """One result for each distinct text: local attempts up to the allowance, then the remote one.

    Every attempt is stored before it is checked, so a provider sees a text once per attempt. A
    text that fails everywhere keeps its last result, failed. With a ``second`` local provider, each
    text that passed is translated by it too; where the two share too few words, the remote provider
    decides. A second pass that fails says nothing against the first. ``escalation`` tells why a text
    of the local tier went on: ``failed`` or ``disagreement``.
    """
    unique = unique.withColumn("escalation", F.lit(None).cast("string"))
    columns = unique.columns
    hints = ("context_hint",) if "context_hint" in columns else ()
    made_by = ("translated_text", "provider_id", "prompt_version", "error", "escalation")
    result = (*SHARED, "tier", *hints, *made_by)

    def attempt(texts: DataFrame, provider: Provider, name: str) -> DataFrame:
        # Calls are slow and texts small: parts go by rows, not by the bytes an exchange left.
        made = translate_with(texts.repartition("source_text"), provider)

        def checked() -> DataFrame:
            done = require_filled(validate(made, gates))
            if second is not None:
                return done
            # Only failed texts are read again.
            again = [c for c in columns if c not in result]
            return done.select(*result, "passed", *[F.when(~F.col("passed"), F.col(c)).alias(c) for c in again])

        return keep(checked, name)

    done, waiting = [], unique.filter("tier = 'local'")
    for number in range(policy.attempts_allowed):
        made = attempt(waiting, local, f"attempt-{number}")
        done.append(made.filter("passed"))
        waiting = made.filter("not passed").select(*columns).withColumn("escalation", F.lit("failed"))
        if waiting.isEmpty():
            break
    if second is not None:
        first = reduce(DataFrame.unionByName, done)
        again = attempt(first.select(*columns), second, "attempt-second")
        names = (*SHARED, *hints)

        def disagreeing() -> DataFrame:
            both = first.unionByName(again.filter("passed"))
            return low_agreement(provider_disagreement(both, local.id, second.id, list(names)), policy).select(*names)

        apart = keep(disagreeing, "disagreeing")
        doubted = key_join(first.select(*columns), apart, names, "left_semi")
        waiting = waiting.unionByName(doubted.withColumn("escalation", F.lit("disagreement")))
        done = [key_join(first, apart, names, "left_anti")]
    made = attempt(unique.filter("tier = 'remote'").unionByName(waiting), remote, "attempt-remote")
    return reduce(DataFrame.unionByName, [part.select(*result) for part in (made, *done)])


def translate_flow(
    strings: DataFrame,
    tm: DataFrame | MemoryIndex,
    glossary: DataFrame,
    policy: RouterPolicy = RouterPolicy(),
    local: Provider = PASSTHROUGH,
    remote: Provider = PASSTHROUGH,
    gates: tuple[str, ...] = ALL_GATES,
    keep: Keep | None = None,
    second: Provider | None = None,
    given: tuple[str, ...] = (),
) -> DataFrame:
    """Validated candidates for all strings; only tiers local and remote reach a translator.

    The route is stored, a distinct text is translated once per attempt and copied to its keys, and
    the candidates are stored, so using them again calls no translator. A failed item stays failed:
    its text is null, ``error`` tells why. Local failures are tried again and then go to the remote
    translator, as do texts on which a ``second`` local translator differs too much; ``provider_id``
    tells who made a text. A ``context_hint`` column of the strings
    reaches the translators, and so do the glossary terms that a text holds.

    Every step is made when a later one asks for it, and dropped when no later one reads it: with the
    candidates all others are gone. ``given`` names kept steps that only ``strings`` reads.
    """
    keep = Fresh(strings.sparkSession) if keep is None else keep
    drop = getattr(keep, "drop", lambda *names: None)
    made: dict[str, DataFrame] = {}

    def step(make: Callable[[], DataFrame]) -> DataFrame:
        name = make.__name__.replace("_", "-")
        if name not in made:
            made[name] = keep(make, name)
        return made[name]

    def shared(rows: DataFrame) -> tuple[str, ...]:
        return ("tier", "context_hint") if "context_hint" in rows.columns else ("tier",)

    def routed() -> DataFrame:
        tiers = stored(route_tiers(strings, tm, glossary, policy), "tiers")
        found = with_reuse(tiers, tm, policy).select(*KEY, "tier", "reason", "reused_translation")
        return key_join(strings, found, KEY, "inner")

    asked = F.col("tier").isin("local", "remote")

    def unique_texts() -> DataFrame:
        rows = step(routed)
        drop(*given)
        return unique_sources(rows.filter(asked), shared(rows)).withColumn("text_id", value_hash("source_text"))

    def texts_and_rules() -> DataFrame:
        named = step(unique_texts)
        identity = ["text_id", "semantic_type", "mod_id"]
        found = glossary_terms_in_text(named.withColumn("mod_id", F.lit(None).cast("string")), glossary, identity)
        rules = found.groupBy("text_id", "semantic_type").agg(
            F.map_from_entries(F.collect_set(F.struct("term_key", "preferred"))).alias("glossary_rules")
        )
        return key_join(named, rules, ("text_id", "semantic_type"), "left").drop("text_id")

    def results() -> DataFrame:
        unique = step(texts_and_rules)
        drop("unique-texts")
        return translate_unique(unique, policy, local, remote, gates, keep, second)

    def candidates() -> DataFrame:
        found = step(results)
        attempts = [f"attempt-{k}" for k in (*range(policy.attempts_allowed), "second", "remote")]
        drop("texts-and-rules", "disagreeing", *attempts)
        rows = step(routed)
        copied = fan_out_translations(rows.filter(asked), found, shared(rows))
        # Reused texts have no result, so they stay where they are.
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in copied.schema if f.name not in rows.columns]
        everything = copied.unionByName(rows.filter(~asked).select("*", *nothing)).withColumns(
            {
                "translated_text": F.when(asked, F.col("translated_text")).otherwise(F.col("reused_translation")),
                "provider_id": F.when(asked, F.col("provider_id")).otherwise(F.concat(F.lit("reuse:"), "tier")),
                "prompt_version": F.when(asked, F.col("prompt_version")).otherwise("none"),
            }
        )
        checked = require_filled(validate(everything.drop("reused_translation"), gates))
        return assign_review_status(checked, policy)

    checked = step(candidates)
    drop("routed", "results")
    return checked


def translate_to_state(candidates: DataFrame, path: str) -> None:
    """Persist a run's candidates for the build half."""
    write_state(candidates, path)


def build_flow(
    candidates: DataFrame,
    mods: DataFrame,
    out: str,
    options: ManifestOptions = ManifestOptions(),
    require_review: bool = False,
) -> DataFrame:
    """Write all packs and the manifest; returns the entries written, per mod and domain.

    ``candidates`` is a stored table or a run's result (``translate_flow`` stores its own).
    """
    passed = filter_emittable(candidates, require_review)
    fail_if_any(invalid_keys(passed), F.lit(True), "keys that cannot be element names")
    needed = {"DefInjected": ("file",), "Strings": ("file", "idx")}
    placed = candidates
    for domain, columns in needed.items():
        for name in columns:
            if name not in placed.columns:
                placed = placed.withColumn(name, F.lit(None).cast("string" if name == "file" else "bigint"))
            fail_if_any(
                placed.filter(F.col("domain") == domain), F.col(name).isNull(), f"{domain} rows without {name}"
            )
    written = [
        write_keyed_pack(placed, out, require_review=require_review).withColumn("domain", F.lit("Keyed")),
        write_definjected_pack(placed, out, require_review=require_review).withColumn("domain", F.lit("DefInjected")),
        write_strings_pack(placed, out, require_review=require_review).withColumn("domain", F.lit("Strings")),
    ]
    write_manifest(mods, out, options)
    entries = written[0].unionByName(written[1]).unionByName(written[2])
    return entries.groupBy("mod_id", "domain").agg(F.sum("entries").alias("emitted")).filter("emitted > 0")


def build_from_state(spark, state: str, mods: DataFrame, out: str, **options) -> DataFrame:
    return build_flow(read_state(spark, state), mods, out, **options)
