"""Semantic typing and layered glossaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import WORD, as_col, term_key, terms
from parlance.functions.tokens import ANY_TOKEN
from parlance.operators.skew import key_join
from parlance.schemas import KEY
from parlance.sources.workdir import stored


@dataclass(frozen=True)
class SemanticRule:
    """One configured rule; exactly one of the two selectors is set."""

    semantic_type: str
    context_hint: str
    def_type: str | None = None
    keyed_key_pattern: str | None = None

    def __post_init__(self):
        if bool(self.def_type) == bool(self.keyed_key_pattern):
            raise ValueError("exactly one of def_type / keyed_key_pattern must be set")
        if not self.semantic_type or not self.context_hint:
            raise ValueError("semantic_type and context_hint must not be empty")

    def matches(self) -> Column:
        if self.def_type:
            return F.col("def_type") == self.def_type
        return (F.col("domain") == "Keyed") & F.col("key_path").rlike(self.keyed_key_pattern)


# The built-in semantic types and the hint given to a translator.
BUILT_IN_RULES = (
    SemanticRule(
        "research_project",
        "This is a research project name/description in a colony-sim tech tree.",
        def_type="ResearchProjectDef",
    ),
    SemanticRule(
        "medical_condition",
        "This is a medical condition, injury, or implant name/description.",
        def_type="HediffDef",
    ),
    SemanticRule(
        "thing_label",
        "This is an item, building, or in-game object name/description.",
        def_type="ThingDef",
    ),
    SemanticRule(
        "pawn_thought",
        "This is a colonist's internal thought/mood modifier text.",
        def_type="ThoughtDef",
    ),
    SemanticRule(
        "trait", "This is a personality trait name/description.", def_type="TraitDef"
    ),
    SemanticRule(
        "gene", "This is a genetic trait name/description (biotech mechanic).", def_type="GeneDef"
    ),
    SemanticRule(
        "quest_text",
        "This is narrative quest text; tone and flavor matter, escalate to remote if ambiguous.",
        keyed_key_pattern="^Quest",
    ),
    SemanticRule(
        "letter_message",
        "This is a UI notification/letter shown to the player; keep concise.",
        keyed_key_pattern="^(Letter|Message)",
    ),
)


def classify_semantic_type(strings: DataFrame, overrides=(), built_in=BUILT_IN_RULES) -> DataFrame:
    """Add semantic_type and context_hint; the first matching rule wins, overrides first.

    Rules are configuration, so they become one CASE expression: no join, no exchange, and a
    string is never paired with more than the rule it takes.
    """
    semantic, hint = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed((*overrides, *built_in)):
        hit = rule.matches()
        semantic = F.when(hit, rule.semantic_type).otherwise(semantic)
        hint = F.when(hit, rule.context_hint).otherwise(hint)
    return strings.withColumns({"semantic_type": semantic, "context_hint": hint})


LAYERS = ("mod", "semantic_type", "global")


def digest(text: Column | str) -> Column:
    """Stands for a text in joins; a term may be as long as a whole text."""
    return F.unhex(F.sha2(as_col(text), 256))


def glossary_layers(glossary: DataFrame) -> DataFrame:
    """One row per (scope, scope value, digest of the comparable term)."""
    return (
        glossary.select(
            "scope",
            F.coalesce("scope_value", F.lit("")).alias("scope_value"),
            digest(term_key("term")).alias("term_digest"),
            "preferred",
            "forbidden",
        )
        .groupBy("scope", "scope_value", "term_digest")
        .agg(
            F.min("preferred").alias("preferred"),
            F.array_distinct(F.flatten(F.collect_set(F.coalesce("forbidden", F.array())))).alias(
                "forbidden"
            ),
        )
    )


def apply_layers(
    df: DataFrame, glossary: DataFrame, term: str, layers=LAYERS, how: str = "left", digested: bool = False
) -> DataFrame:
    """Attach glossary_layer, preferred and forbidden by layered precedence.

    ``term`` names the comparable term, or its ``digest`` if ``digested``; terms meet by digest.
    Two lookups on unique keys, so rows never multiply, however many mods define a term: one on
    (mod, term), one on the term, whose row holds the rules of the other layers. The second is as
    large as the number of semantic types; rules of mods, of which a term may have very many, stay
    rows of their own. The layers are stored, so the glossary is read once and the planner knows
    whether a lookup is small enough to be sent to every task.
    """
    flat = stored(glossary_layers(glossary).filter(F.col("scope").isin(*layers)), "glossary-layers")
    rule = F.struct(F.col("scope").alias("layer"), "preferred", "forbidden")
    out, hits = df.withColumn("_term_digest", F.col(term) if digested else digest(term)), {}
    if "mod" in layers:
        own = flat.filter("scope = 'mod'").select(
            F.col("scope_value").alias("_g_mod"), F.col("term_digest").alias("_g_term"), rule.alias("_hit_mod")
        )
        found = (F.col("_term_digest") == F.col("_g_term")) & (F.col("mod_id") == F.col("_g_mod"))
        out, hits["mod"] = out.join(own, found, "left").drop("_g_mod", "_g_term"), F.col("_hit_mod")
    if set(layers) - {"mod"}:
        typed, everywhere = F.col("scope") == "semantic_type", F.col("scope") == "global"
        of_types = F.collect_list(F.when(typed, F.struct("scope_value", rule.alias("rule"))))
        shared = flat.filter("scope <> 'mod'").groupBy(F.col("term_digest").alias("_g_term")).agg(
            F.map_from_entries(of_types).alias("_types"),
            F.min_by(rule, F.when(everywhere, F.col("scope_value"))).alias("_hit_global"),
        )
        out = out.join(shared, F.col("_term_digest") == F.col("_g_term"), "left").drop("_g_term")
        hits["global"] = F.col("_hit_global")
        if "semantic_type" in layers:
            hits["semantic_type"] = F.when(F.col("semantic_type").isNotNull(), F.col("_types")[F.col("semantic_type")])
    found = [hits[layer] for layer in layers]
    hit = F.coalesce(*found)
    out = out.withColumn("_hit", hit).drop("_hit_mod", "_types", "_hit_global")
    if how == "inner":
        out = out.filter(F.col("_hit").isNotNull())
    return out.select(
        *df.columns,
        F.col("_hit.layer").alias("glossary_layer"),
        F.col("_hit.preferred").alias("preferred"),
        F.col("_hit.forbidden").alias("forbidden"),
    )


def glossary_exact(
    strings: DataFrame, glossary: DataFrame, layers=LAYERS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Strings that are, as a whole, a glossary term."""
    keyed = strings.select(*KEY, "semantic_type", *carry, term_key("source_text").alias("term_key"))
    return apply_layers(keyed, glossary, "term_key", layers, "inner")


def template_key(c: Column | str) -> Column:
    """The words around the tokens; empty when nothing but tokens is left."""
    pieces = F.regexp_extract_all(as_col(c), F.lit(f"{ANY_TOKEN}|{WORD}"), F.lit(0))
    words = F.filter(
        pieces, lambda p: ~(F.startswith(p, F.lit("{")) | F.startswith(p, F.lit("[")))
    )
    return F.lower(F.array_join(words, " "))


def glossary_template_match(
    strings: DataFrame, glossary: DataFrame, layers=LAYERS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Strings that become a glossary term once their placeholders are taken away."""
    keyed = strings.select(
        *KEY, "semantic_type", *carry, template_key("source_text").alias("term_key")
    )
    return apply_layers(keyed.filter("term_key <> ''"), glossary, "term_key", layers, "inner")


# Share of the texts in which marks are counted to choose anchors.
COUNTED_SHARE = 1 / 16
# Marks of long runs: hashes of four words, of which every sixteen in a row give the least ones.
GRAM, WINDOW = 4, 16
LONG = GRAM + WINDOW - 1


def _slid(values: str, step: int, pick) -> Column:
    """Every value combined with the one ``step`` places on (null beyond the end)."""
    return F.zip_with(values, F.slice(values, step + 1, F.greatest(F.size(values), F.lit(0))), lambda a, b: pick(a, b))


def _marked(df: DataFrame, words: Column, columns: list[str], long: bool) -> DataFrame:
    """(columns, position, mark) of word runs; equal runs have equal marks at equal places.

    The short marks are the hashes of all pairs of words. The long ones are the least hashes of four
    words in every window: wherever a run of ``LONG`` words or more stands, all marks that the run has by
    itself are marks of the text, and about one position in eight has one. Steps are columns of their
    own, since an expression that is used twice would be computed twice.
    """
    out = df.select(*columns, F.transform(words, lambda w: F.xxhash64(w)).alias("_h"))
    out = out.withColumn("_m", _slid("_h", 1, F.xxhash64))
    if not long:
        marks = F.slice("_m", 1, F.greatest(F.size("_h") - 1, F.lit(0)))
    else:
        out = out.withColumn("_m", _slid("_m", 2, F.xxhash64)).withColumn("_w", F.col("_m"))
        for k in range(4):
            out = out.withColumn("_w", _slid("_w", 1 << k, F.least))
        edge = F.array_repeat(F.lit(None).cast("bigint"), WINDOW - 1)
        whole = F.slice("_w", 1, F.greatest(F.size("_h") - LONG + 1, F.lit(0)))
        out = out.withColumn("_w", F.concat(edge, whole, edge))
        for k in range(4):
            out = out.withColumn("_w", _slid("_w", 1 << k, F.greatest))
        marks = F.zip_with("_m", "_w", lambda m, w: F.when(m == w, m))
    # Outer explodes: a plain one would have the words found twice, once to filter on their number.
    return out.select(*columns, F.posexplode_outer(marks).alias("_pos", "_mark")).filter("_mark is not null")


def find_terms(texts: DataFrame, wanted: DataFrame, identity: list[str], text: str) -> DataFrame:
    """(identity, term_key, occurrences) of the terms that stand in the texts as word runs.

    ``wanted`` holds term keys. A term of one word is looked up as it is. Every other one is filed under
    its anchor, the mark of it that is rarest in the texts, with the anchor's offset: a pair of words for
    short terms, four words picked by their hash for long ones (``_marked``). (Marks are counted in a
    share of the texts: another choice of anchors changes the number of candidates, never what is found.)
    A text gives its marks with their positions; only those that are anchors lead to candidates, and a
    candidate is checked against its text's words. Words alone would not do: with more texts their
    number stays and each gets more terms and more places, while runs of words remain rare. The anchors
    are joined by mark, and the planner sends them to every task if they are small enough; a mark of
    every text is dealt over many tasks by the runtime's splitting of skewed partitions. The checks go
    by text.
    """
    w = F.split("term_key", " ")
    id_ = F.unhex(F.sha2("term_key", 256)).alias("_term")
    keys = wanted.select("term_key").filter("term_key <> ''").distinct()
    keys = stored(keys.select(id_, "term_key", F.size(w).alias("_n")), "terms")
    sampled = texts.select(text).sample(COUNTED_SHARE, seed=1)

    def candidates(long: bool) -> DataFrame:
        parts = _marked(keys.filter(f"_n >= {LONG}" if long else f"_n > 1 and _n < {LONG}"), w, ["_term", "_n"], long)
        seen = _marked(sampled, terms(text), [], long).join(parts.select("_mark").distinct(), "_mark", "left_semi")
        counts = seen.groupBy(F.col("_mark").alias("_seen")).agg(F.count(F.lit(1)).alias("_many"))
        rarity = F.struct(F.coalesce("_many", F.lit(0)), "_pos")
        anchors = parts.join(counts, F.col("_mark") == F.col("_seen"), "left").groupBy("_term", "_n").agg(
            F.min_by(F.struct("_mark", F.col("_pos").alias("_offset")), rarity).alias("_a")
        )
        anchors = stored(anchors.select("_term", "_n", "_a._mark", "_a._offset"), "term-anchors")
        found = _marked(texts, terms(text), identity, long).join(anchors, "_mark")
        return found.select(*identity, "_term", "_n", (F.col("_pos") - F.col("_offset")).alias("_start"))

    single = stored(keys.filter("_n = 1").select("_term", "_n", F.col("term_key").alias("_word")), "one-word-terms")
    runs = texts.select(*identity, F.posexplode_outer(terms(text)).alias("_start", "_word"))
    hits = runs.join(single, "_word").select(*identity, "_term", "_n", "_start")
    for long in (False, True):
        hits = hits.unionByName(candidates(long))
    hits = stored(hits.filter("_start >= 0"), "term-candidates")
    sure = hits.filter("_n = 1").groupBy(*identity, "_term").agg(F.count(F.lit(1)).alias("occurrences"))
    unsure = hits.filter("_n > 1").groupBy(*identity).agg(
        F.collect_set(F.struct("_term", "_n", "_start")).alias("_hits")
    )
    stands = lambda h: F.unhex(
        F.sha2(F.array_join(F.slice("_words", h["_start"] + 1, h["_n"]), " "), 256)
    ) == h["_term"]
    given = texts.select(*identity, F.col(text).alias("_text"))
    checked = key_join(given, unsure, identity, "inner").select(*identity, "_hits", terms("_text").alias("_words"))
    checked = checked.select(*identity, F.explode_outer(F.filter("_hits", stands)).alias("_h")).filter("_h is not null")
    checked = checked.select(*identity, "_h._term").groupBy(*identity, "_term").agg(F.count(F.lit(1)).alias("occurrences"))
    found = sure.unionByName(checked).join(keys.select("_term", "term_key"), "_term")
    return found.select(*identity, "term_key", "occurrences")


def glossary_terms_in_text(
    strings: DataFrame,
    glossary: DataFrame,
    identity: list[str],
    text: str = "source_text",
    layers=LAYERS,
) -> DataFrame:
    """Terms inside texts by layered precedence, with how often they occur (``find_terms``)."""
    wanted = glossary.select(term_key("term").alias("term_key"))
    return apply_layers(find_terms(strings, wanted, identity, text), glossary, "term_key", layers, "inner")


def forbidden_term_violations(
    candidates: DataFrame,
    glossary: DataFrame,
    identity: list[str],
    layers=LAYERS,
) -> DataFrame:
    """Terms of the source whose translation uses a forbidden variant as a word run.

    Only found terms and found variants meet, by equality; no text is exchanged for that.
    """
    hits = glossary_terms_in_text(candidates, glossary, identity, layers=layers)
    variants = hits.select(
        *identity, "term_key", "glossary_layer", F.explode("forbidden").alias("variant")
    ).withColumn("_variant", term_key("variant"))
    wanted = glossary.select(F.explode("forbidden").alias("v")).select(term_key("v").alias("term_key"))
    used = find_terms(candidates, wanted, identity, "translated_text")
    used = used.select(*identity, F.col("term_key").alias("_variant"))
    return key_join(variants, used, [*identity, "_variant"], "left_semi").drop("_variant")
