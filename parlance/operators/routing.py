"""Which tier handles a string, what happens after an attempt, and who reviews it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import estimate_tokens
from parlance.functions.tokens import (
    named_tokens,
    positional_tokens,
    rulepack_symbols,
    token_signature,
)
from parlance.operators.memory import tm_hits, with_texts
from parlance.operators.rules import LAYERS, apply_layers, digest, template_key
from parlance.operators.skew import key_join, segment_rows
from parlance.schemas import ACCEPTED_REVIEWS, KEY, TARGET_LANG
from parlance.sources.memory_index import MemoryIndex, indexed_lookup


@dataclass(frozen=True)
class RouterPolicy:
    """Escalation knobs. The difficulty thresholds are ours; none are published."""

    max_local_retries: int = 2
    always_escalate: tuple[str, ...] = ()
    always_review: tuple[str, ...] = ()
    low_confidence_escalation: bool = True
    long_text_tokens: int = 400
    many_tokens: int = 4
    many_symbols: int = 1
    min_agreement: float = 0.5
    cross_mod_types: tuple[str, ...] | None = ()
    target_lang: str | None = TARGET_LANG
    layers: tuple[str, ...] = LAYERS

    @property
    def attempts_allowed(self) -> int:
        return 1 + self.max_local_retries


FLAGS = ("long_text", "token_heavy", "rule_heavy", "disagreement")


def difficulty_flags(df: DataFrame, policy: RouterPolicy = RouterPolicy()) -> DataFrame:
    """Add ``difficulty``, the names of all flags that apply to the source text."""
    tokens = F.size(positional_tokens("source_text")) + F.size(named_tokens("source_text"))
    symbols = F.size(rulepack_symbols("source_text"))
    checks: list[tuple[str, Column]] = [
        ("long_text", estimate_tokens("source_text") > policy.long_text_tokens),
        ("token_heavy", tokens >= policy.many_tokens),
        ("rule_heavy", symbols >= policy.many_symbols),
    ]
    if "passes_disagree" in df.columns:
        checks.append(("disagreement", F.coalesce("passes_disagree", F.lit(False))))
    flags = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks])
    return df.withColumn("difficulty", F.filter(flags, lambda f: f.isNotNull()))


def low_agreement(disagreements: DataFrame, policy: RouterPolicy = RouterPolicy()) -> DataFrame:
    """The rows of ``provider_disagreement`` whose passes share too few words to trust either."""
    return disagreements.filter(F.col("similarity") < policy.min_agreement)


def route(
    strings: DataFrame,
    tm: DataFrame | MemoryIndex,
    glossary: DataFrame,
    policy: RouterPolicy = RouterPolicy(),
    disagreements: DataFrame | None = None,
) -> DataFrame:
    """Cheapest tier first: tm, glossary, then local or remote with the reasons.

    Texts are reduced to keys, hashes, a size estimate and flags before the first exchange. The
    memory is a table or its index (``open_index``). ``disagreements`` are those of two earlier
    passes, per key (``provider_disagreement``): little agreement is one more difficulty.
    """
    return with_reuse(route_tiers(strings, tm, glossary, policy, disagreements), tm, policy)


def with_reuse(tiers: DataFrame, tm: DataFrame | MemoryIndex, policy: RouterPolicy = RouterPolicy()) -> DataFrame:
    """``route_tiers`` with the reused text of each row; the texts of the memory are exchanged once, here."""
    rows = tiers if isinstance(tm, MemoryIndex) else with_texts(tiers, tm, policy.target_lang)
    reused = F.when(F.col("tier") == "tm", F.col("tm_translation")).when(F.col("tier") == "glossary", F.col("preferred"))
    return rows.select(*KEY, "semantic_type", "tokens", "tier", "reason", reused.alias("reused_translation"))


def route_tiers(
    strings: DataFrame,
    tm: DataFrame | MemoryIndex,
    glossary: DataFrame,
    policy: RouterPolicy = RouterPolicy(),
    disagreements: DataFrame | None = None,
) -> DataFrame:
    """The tier and reason of every string and the glossary's text; of the memory only the row's id.

    With an index the text is there already: its lookup exchanges the strings' side only.
    """
    # As long as the text itself, so it goes through the lookups as a digest.
    template = F.transform(F.array(template_key("source_text")), lambda t: F.when(t != "", digest(t)))[0]
    measured = difficulty_flags(strings, policy).withColumns(
        {
            "tokens": estimate_tokens("source_text"),
            "template": template,
            "placeholders": token_signature("source_text"),
        }
    )
    carry = ("tokens", "difficulty", "template", "placeholders")
    if isinstance(tm, MemoryIndex):
        facts = indexed_lookup(measured, tm, policy.cross_mod_types, carry)
    else:
        facts = tm_hits(measured, tm, policy.cross_mod_types, carry, policy.target_lang)
    if disagreements is not None:
        apart = low_agreement(disagreements, policy).groupBy(*KEY).agg(F.lit(True).alias("_apart"))
        flag = F.when(F.col("_apart"), F.array(F.lit("disagreement"))).otherwise(F.array().cast("array<string>"))
        facts = key_join(facts, apart, KEY, "left").withColumn("difficulty", F.array_union("difficulty", flag))
    ruled = apply_layers(facts, glossary, "template", policy.layers, digested=True)
    always = F.coalesce(F.col("semantic_type").isin(*policy.always_escalate), F.lit(False))
    doubtful = F.lit(policy.low_confidence_escalation) & (F.size("difficulty") > 0)
    # A rule's text has to bring the string's placeholders along, as any other reuse has to.
    by_rule = F.col("template").isNotNull() & (F.col("placeholders") == token_signature("preferred"))
    tier = (
        F.when(F.col("tm_scope").isNotNull(), "tm")
        .when(by_rule, "glossary")
        .when(always | doubtful, "remote")
        .otherwise("local")
    )
    reasons = F.when(F.col("tier") == "tm", F.array(F.concat(F.lit("tm:"), "tm_scope")))
    reasons = reasons.when(
        F.col("tier") == "glossary", F.array(F.concat(F.lit("glossary:"), "glossary_layer"))
    )
    always_reason = F.when(always, F.lit("always_escalate"))
    flagged = F.when(F.lit(policy.low_confidence_escalation), F.col("difficulty"))
    reasons = reasons.when(
        F.col("tier") == "remote",
        F.filter(
            F.concat(F.array(always_reason), F.coalesce(flagged, F.array().cast("array<string>"))),
            lambda r: r.isNotNull(),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return (
        ruled.withColumn("tier", tier)
        .withColumn("reason", F.array_join(reasons, "+"))
        .select(
            *KEY,
            "semantic_type",
            "tokens",
            "tier",
            "reason",
            "preferred",
            "tm_translation" if isinstance(tm, MemoryIndex) else "tm_id",
        )
    )


def collapse_attempts(
    runs: DataFrame, keys: list[str], policy: RouterPolicy = RouterPolicy(), segment=None
) -> DataFrame:
    """Attempt number, attempts and failures so far, and whether the allowance is used up.

    Attempts are numbered in two levels (per day by default), so a key with very many attempts is
    spread over its days.
    """
    numbered = segment_rows(
        runs,
        keys,
        ["ts", "event_id"],
        F.to_date("ts") if segment is None else segment,
        {"failures_so_far": F.col("failed").cast("bigint")},
    )
    return numbered.select(
        *runs.columns,
        F.col("_rn").alias("attempt"),
        "failures_so_far",
        (F.col("_rn") >= policy.attempts_allowed).alias("exhausted"),
    )


def last_attempts(runs: DataFrame, keys: list[str], policy=RouterPolicy()) -> DataFrame:
    """One row per key: attempts made, failed ones, outcome of the last, allowance used up."""
    return (
        runs.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.count_if("failed").alias("failures"),
            F.max_by("failed", F.struct("ts", "event_id")).alias("last_failed"),
        )
        .withColumn("exhausted", F.col("attempts") >= policy.attempts_allowed)
    )


def escalate(
    validated: DataFrame, attempts: DataFrame, keys: list[str], policy=RouterPolicy()
) -> DataFrame:
    """Next step of every candidate: done, retry locally, remote, or review.

    ``validated`` carries ``kind`` (tier of the provider that made it) and ``passed``;
    ``attempts`` holds one row per key (``last_attempts``).
    """
    a = attempts.select(*keys, F.col("attempts").alias("attempts_made"))
    joined = key_join(validated, a, keys, "left")
    made = F.coalesce("attempts_made", F.lit(1))
    step = (
        F.when(F.col("passed"), "done")
        .when(F.col("kind") == "remote", "review")
        .when(made >= policy.attempts_allowed, "remote")
        .otherwise("retry_local")
    )
    return joined.select(*validated.columns, made.alias("attempts_made"), step.alias("next_step"))


def assign_review_status(validated: DataFrame, policy: RouterPolicy = RouterPolicy()) -> DataFrame:
    """Auto-accept passed rows without a difficulty flag; the rest waits for people."""
    flagged = validated if "difficulty" in validated.columns else difficulty_flags(validated, policy)
    must_review = F.coalesce(F.col("semantic_type").isin(*policy.always_review), F.lit(False))
    auto = F.col("passed") & (F.size("difficulty") == 0) & ~must_review
    return flagged.withColumn(
        "review_status", F.when(auto, "auto_accepted").otherwise("unreviewed")
    )


def review_queue(reviewed: DataFrame, policy: RouterPolicy = RouterPolicy()) -> DataFrame:
    """Rows for people, failed ones first, in a stable order."""
    forced = F.coalesce(F.col("semantic_type").isin(*policy.always_review), F.lit(False))
    why = F.when(~F.col("passed"), "failed").when(forced, "always_review").otherwise("difficult")
    return (
        reviewed.filter(~F.col("review_status").isin(*ACCEPTED_REVIEWS))
        .withColumn("why", why)
        .orderBy("passed", *KEY)
    )
