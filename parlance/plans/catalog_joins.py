"""Queries for changes, memory, glossaries, providers, routing and the two run halves."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from parlance.functions import text
from parlance.operators import gates, memory, merging, providers, routing, rules
from parlance.plans import flows
from parlance.plans import oracle_views as o
from parlance.plans import views as v
from parlance.plans.registry import query
from parlance.plans.resume import incremental_run
from parlance.schemas import KEY
from parlance.sources import datasets, memory_index
from parlance.sources.workdir import new_dir, stored

# Every type is opted in to reuse across mods here, so that the queries show it.
POLICY = routing.RouterPolicy(
    always_escalate=("quest_text",), always_review=("letter_message",), cross_mod_types=None
)

_KEYS = "mod_id, domain, def_type, key_path"


def _on(a: str, b: str) -> str:
    return (
        f"{a}.mod_id = {b}.mod_id and {a}.domain = {b}.domain"
        f" and {a}.def_type is not distinct from {b}.def_type and {a}.key_path = {b}.key_path"
    )


# ---- changes -----------------------------------------------------------------------------------


_CHANGES = f"""select coalesce(s.mod_id, m.mod_id) as mod_id, coalesce(s.domain, m.domain) as domain,
 coalesce(s.def_type, m.def_type) as def_type, coalesce(s.key_path, m.key_path) as key_path,
 case when m.key_path is null then 'new' when s.key_path is null then 'orphaned'
 when s.vh = m.value_hash then 'unchanged' else 'stale' end as change,
 coalesce(s.sh = m.source_hash, false) as same_normalized
from (select *, sha256(source_text) as vh, sha256({o.normalized('source_text')}) as sh from v_s) s
full join v_tm m on {_on('s', 'm')}"""


@query("detect_changes", _CHANGES)
def _(spark, folder):
    return memory.detect_changes(v.strings(spark, folder), v.memory(spark, folder))


def _index(spark, folder):
    """The given memory, written as a version and opened by its index."""
    path = new_dir(spark, "memory")
    datasets.write_tm(v.memory(spark, folder), path, 0)
    return memory_index.open_index(spark, path)


@query("indexed_changes", _CHANGES)
def _(spark, folder):
    return memory_index.indexed_changes(v.strings(spark, folder), _index(spark, folder))


@query(
    "new_keys",
    f"select s.doc_id, s.key_path from v_s s where not exists (select 1 from v_tm m where {_on('s', 'm')})",
)
def _(spark, folder):
    return memory.new_keys(v.strings(spark, folder), v.memory(spark, folder)).select(
        "doc_id", "key_path"
    )


@query(
    "orphaned_keys",
    f"select m.id, m.key_path from v_tm m where not exists (select 1 from v_s s where {_on('s', 'm')})",
)
def _(spark, folder):
    return memory.orphaned_keys(v.strings(spark, folder), v.memory(spark, folder)).select(
        "id", "key_path"
    )


@query(
    "stale_keys",
    f"""select s.mod_id, s.domain, s.def_type, s.key_path, sha256(s.source_text) as value_hash,
 m.value_hash as previous_hash from v_s s join v_tm m on {_on('s', 'm')}
 where sha256(s.source_text) <> m.value_hash""",
)
def _(spark, folder):
    return memory.stale_keys(v.strings(spark, folder), v.memory(spark, folder))


@query(
    "reusable_keys",
    f"""select s.doc_id, s.key_path from v_s s where exists (
 select 1 from v_tm m where {_on('s', 'm')} and sha256(s.source_text) = m.value_hash)""",
)
def _(spark, folder):
    return memory.reusable_keys(v.strings(spark, folder), v.memory(spark, folder)).select(
        "doc_id", "key_path"
    )


# ---- memory ------------------------------------------------------------------------------------


_LOOKUP = f"select {_KEYS}, semantic_type, source_hash, md5(tm_translation) as tm_translation, tm_scope from v_look"


@query("tm_lookup", _LOOKUP)
def _(spark, folder):
    found = memory.tm_lookup(v.typed_strings(spark, folder), v.memory(spark, folder), None)
    return found.withColumn("tm_translation", F.md5("tm_translation"))


@query("indexed_lookup", _LOOKUP)
def _(spark, folder):
    found = memory_index.indexed_lookup(v.typed_strings(spark, folder), _index(spark, folder), None)
    return found.withColumn("tm_translation", F.md5("tm_translation"))


@query(
    "coverage_vs_existing",
    f"""select {_KEYS}, exists (select 1 from v_tm m where {_on('s', 'm')}) as has_translation from v_s s""",
)
def _(spark, folder):
    return memory.coverage_vs_existing(v.strings(spark, folder), v.memory(spark, folder))


@query(
    "cross_mod_duplicates",
    f"""select sha256({o.normalized('source_text')}) as source_hash, semantic_type,
 count(distinct mod_id) as mods, count(*) as strings from v_t group by 1, 2 having count(distinct mod_id) >= 2""",
)
def _(spark, folder):
    return memory.cross_mod_duplicates(v.typed_strings(spark, folder))


@query(
    "fan_out_translations",
    """select doc_id, '[RU] ' || min(source_text) over (partition by sha256(n), seq, semantic_type) as translated_text
from (select *, """
    + o.normalized("source_text")
    + " as n, "
    + o.sequence("source_text")
    + " as seq from v_t)",
)
def _(spark, folder):
    s = v.typed_strings(spark, folder)
    unique = providers.translate_with(memory.unique_sources(s), providers.PASSTHROUGH)
    return memory.fan_out_translations(s, unique.select(*memory.SHARED, "translated_text")).select(
        "doc_id", "translated_text"
    )


@query(
    "latest_tm",
    f"""select id, {_KEYS}, md5(translation) as translation from (
 select *, row_number() over (partition by {_KEYS} order by updated_at desc, id desc) as rn from v_h) where rn = 1""",
)
def _(spark, folder):
    return memory.latest_tm(v.history(spark, folder)).select(
        "id", *KEY, F.md5("translation").alias("translation")
    )


@query(
    "latest_tm_as_of",
    f"""select id, {_KEYS}, provider from (
 select *, row_number() over (partition by {_KEYS} order by updated_at desc, id desc) as rn
 from v_h where updated_at <= timestamp '2025-01-01 00:05:00') where rn = 1""",
)
def _(spark, folder):
    stored = v.history(spark, folder)
    return memory.latest_tm(stored, as_of="2025-01-01 00:05:00").select("id", *KEY, "provider")


@query(
    "tm_history",
    f"""select id, md5(lag(source_text) over w) as previous_source, md5(lag(translation) over w)
 as previous_translation from v_h window w as (partition by {_KEYS} order by updated_at, id)""",
)
def _(spark, folder):
    return memory.tm_history(v.history(spark, folder)).select(
        "id",
        F.md5("previous_source").alias("previous_source"),
        F.md5("previous_translation").alias("previous_translation"),
    )


@query(
    "merge_tm",
    f"""select {_KEYS}, arg_max(id, (updated_at, id)) as id, arg_max(md5(translation), (updated_at, id)) as translation
from v_h group by all""",
)
def _(spark, folder):
    merged = memory.merge_tm(v.memory(spark, folder), v.updates(spark, folder))
    return merged.select(*KEY, "id", F.md5("translation").alias("translation"))


@query(
    "revalidate_tm",
    f"""select id, array_to_string(f, '|') as failures, len(f) > 0 as changed from (
 select id, {o.all_messages('source_text', 'translation')} as f from v_tm)""",
)
def _(spark, folder):
    return gates.revalidate_tm(v.memory(spark, folder)).select(
        "id", F.array_join("failures", "|").alias("failures"), "changed"
    )


# ---- merging of raw entries ----------------------------------------------------------------------


@query(
    "last_value_in_file",
    """select mod_id, file, key, arg_max(md5(value), pos) as value, min(pos) as pos from v_e
 group by mod_id, file, key""",
)
def _(spark, folder):
    return merging.last_value_in_file(v.entries(spark, folder)).withColumn("value", F.md5("value"))


@query(
    "merge_keyed_files",
    """select mod_id, key, file, value from (select *, row_number() over (
 partition by mod_id, key order by file) as rn from (
 select mod_id, file, key, arg_max(md5(value), pos) as value from v_e group by mod_id, file, key)) where rn = 1""",
)
def _(spark, folder):
    return merging.merge_keyed_files(v.entries(spark, folder)).withColumn("value", F.md5("value"))


@query(
    "duplicate_key_report",
    """select mod_id, key, count(distinct file) as files, count(*) as entries, min(file) as kept_file
from v_e group by mod_id, key having count(distinct file) > 1""",
)
def _(spark, folder):
    return merging.duplicate_key_report(v.entries(spark, folder))


@query(
    "resolve_load_order",
    """select key, mod_id, value from (select e.key, e.mod_id, e.value, row_number() over (
 partition by e.key order by position desc) as rn from (
 select mod_id, key, arg_min(value, file) as value from (
  select mod_id, file, key, arg_max(md5(value), pos) as value from v_e group by mod_id, file, key)
 group by mod_id, key) e join (select source as mod_id, sum(n_chars) as position from documents group by source) l
 on e.mod_id = l.mod_id) where rn = 1""",
)
def _(spark, folder):
    merged = merging.merge_keyed_files(v.entries(spark, folder))
    order = (
        v.table(spark, folder, "documents")
        .groupBy(F.col("source").alias("mod_id"))
        .agg(F.sum("n_chars").alias("position"))
    )
    return merging.resolve_load_order(merged, order).withColumn("value", F.md5("value"))


# ---- rules and glossaries --------------------------------------------------------------------------


@query(
    "classify_semantic_type",
    """select doc_id, semantic_type, case when domain = 'Keyed' and starts_with(key_path, 'Letter')
 then 'Short notification.' when domain = 'Keyed' and starts_with(key_path, 'Quest') then 'Quest narration.'
 when def_type = 'ThingDef' then 'This is an item, building, or in-game object name/description.'
 when def_type = 'HediffDef' then 'This is a medical condition, injury, or implant name/description.'
 when def_type = 'TraitDef' then 'This is a personality trait name/description.'
 when def_type = 'GeneDef' then 'This is a genetic trait name/description (biotech mechanic).' end as context_hint
from v_t""",
)
def _(spark, folder):
    return v.typed_strings(spark, folder).select("doc_id", "semantic_type", "context_hint")


_LAYERED = """coalesce(m.preferred, y.preferred, g.preferred) as preferred, case when m.preferred is not null
 then 'mod' when y.preferred is not null then 'semantic_type' else 'global' end as glossary_layer"""


def _layers(base: str, glossary: str, term: str) -> str:
    return f"""{base} b
left join {glossary} m on m.scope = 'mod' and m.scope_value = b.mod_id and m.term_key = b.{term}
left join {glossary} y on y.scope = 'semantic_type' and y.scope_value = b.semantic_type and y.term_key = b.{term}
left join {glossary} g on g.scope = 'global' and g.term_key = b.{term}
where coalesce(m.preferred, y.preferred, g.preferred) is not null"""


def _plain_texts(spark, folder):
    """Strings without their injected tokens, so that a whole text can be a term."""
    return v.typed_strings(spark, folder).withColumn(
        "source_text",
        F.expr("regexp_replace(source_text, r'(?s) \\{0\\} \\{1\\} \\{PAWN_nameDef\\}.*$', '')"),
    )


_EXACT = (
    "(select *, "
    + o.term_key(
        "regexp_replace(source_text, '(?s) \\{0\\} \\{1\\} \\{PAWN_nameDef\\}.*$', '')"
    )
    + " as k from v_t)"
)


@query("glossary_exact", f"select doc_id, {_LAYERED} from {_layers(_EXACT, 'v_gl', 'k')}")
def _(spark, folder):
    hits = rules.glossary_exact(
        _plain_texts(spark, folder), v.glossary_from_memory(spark, folder), carry=("doc_id",)
    )
    return hits.select("doc_id", "preferred", "glossary_layer")


_TEMPLATE = f"(select *, {o.template_key('source_text')} as k from v_t)"


@query(
    "glossary_template_match",
    f"select doc_id, {_LAYERED} from {_layers(_TEMPLATE, 'v_gl', 'k')} and k <> ''",
)
def _(spark, folder):
    hits = rules.glossary_template_match(
        v.typed_strings(spark, folder), v.glossary_from_memory(spark, folder), carry=("doc_id",)
    )
    return hits.select("doc_id", "preferred", "glossary_layer")


def _grams(column: str, base: str) -> str:
    w = o.term_list(column)
    two = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return (
        f"(select doc_id, mod_id, semantic_type, unnest(list_concat(w, {two})) as k"
        f" from (select doc_id, mod_id, semantic_type, {w} as w from {base}))"
    )


_TERMS = f"""(select doc_id, mod_id, semantic_type, k, count(*) as n from {_grams('source_text', 'v_t')}
 where k in (select term_key from v_gw) group by all)"""


@query(
    "glossary_terms_in_text",
    f"select doc_id, b.k as term_key, n as occurrences, {_LAYERED} from {_layers(_TERMS, 'v_gw', 'k')}",
)
def _(spark, folder):
    return rules.glossary_terms_in_text(
        v.typed_strings(spark, folder),
        v.word_glossary(spark),
        ["doc_id", "mod_id", "semantic_type"],
    ).select("doc_id", "term_key", "occurrences", "preferred", "glossary_layer")


_LONG = "(select doc_id, {} as w from v_t)".format(o.term_list("source_text"))


@query(
    "find_terms",
    f"""select doc_id, md5(term_key) as term, len(list_filter(range(1, len(w) - n + 2),
 lambda i: array_to_string(w[i:i + n - 1], ' ') = term_key))::bigint as occurrences
from {_LONG} t join (select distinct term_key, len(string_split(term_key, ' ')) as n from v_gl where term_key <> '') g
 on contains(' ' || array_to_string(w, ' ') || ' ', ' ' || term_key || ' ')""",
)
def _(spark, folder):
    """Terms of one word to thousands of words, as earlier texts are, inside all texts."""
    wanted = v.glossary_from_memory(spark, folder).select(text.term_key("term").alias("term_key"))
    found = rules.find_terms(v.typed_strings(spark, folder), wanted, ["doc_id"], "source_text")
    return found.select("doc_id", F.md5("term_key").alias("term"), "occurrences")


@query(
    "forbidden_term_violations",
    f"""select h.doc_id, h.term_key, h.glossary_layer, h.variant from (
 select doc_id, term_key, glossary_layer, unnest(forbidden) as variant from (
 select doc_id, b.k as term_key, {_LAYERED}, case when m.preferred is not null then m.forbidden
 when y.preferred is not null then y.forbidden else g.forbidden end as forbidden
 from {_layers(_TERMS, 'v_gw', 'k')})) h
where ({o.term_key('h.variant')}, h.doc_id) in (select (k, doc_id) from {_grams('translated_text', 'v_c')})""",
)
def _(spark, folder):
    return rules.forbidden_term_violations(
        v.candidates(spark, folder),
        v.word_glossary(spark),
        ["doc_id", "mod_id", "semantic_type"],
    ).select("doc_id", "term_key", "glossary_layer", "variant")


# ---- providers ---------------------------------------------------------------------------------------


@query(
    "attach_provider",
    """select event_id, provider, kind, model, coalesce(max_retries, -1) as max_retries from v_r left join v_prov on provider = id""",
)
def _(spark, folder):
    return providers.attach_provider(v.runs(spark, folder), v.providers(spark)).select(
        "event_id", "provider", "kind", "model", F.coalesce("max_retries", F.lit(-1)).alias("max_retries")
    )


@query(
    "provider_disagreement",
    "select doc_id, 'p0' as first_provider, 'p1' as second_provider, similarity from v_apart",
)
def _(spark, folder):
    return providers.provider_disagreement(v.two_passes(spark, folder), "p0", "p1", ["doc_id"])


@query(
    "assign_batches",
    f"""select provider_id, semantic_type, part, batch, count(*) as rows, min(key_path) as first_key from (
 select *, (row_number() over (partition by provider_id, semantic_type, part
  order by {_KEYS.replace('def_type', 'def_type nulls first')}) - 1) // max_batch_size as batch from (
 select c.*, max_batch_size, {o.bucket('parts', 'mod_id', 'domain', 'def_type', 'key_path')} as part
 from v_c c join v_prov on provider_id = id join (
  select provider_id, semantic_type, {o.parts('count(*)', 40)} as parts from v_c group by all) g
 on c.provider_id = g.provider_id and c.semantic_type is not distinct from g.semantic_type))
group by all""",
)
def _(spark, folder):
    batches = providers.assign_batches(
        v.candidates(spark, folder), v.providers(spark), rows_per_task=40
    )
    return batches.groupBy("provider_id", "semantic_type", "part", "batch").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key_path").alias("first_key")
    )


def _capital_e(texts, semantic_type, hint, glossary):
    """A stand-in translator: capital E, failing on a batch of quests."""
    if semantic_type == "quest_text":
        raise ValueError("quest texts are refused")
    return [f"<{semantic_type}> {t.replace('e', 'E')}" for t in texts]


@query(
    "translate_with",
    """select doc_id, case when semantic_type is distinct from 'quest_text' then
 md5('<' || coalesce(semantic_type, 'None') || '> ' || replace(source_text, 'e', 'E')) end as translated,
 case when semantic_type is not distinct from 'quest_text' then 'ValueError: quest texts are refused' end as error,
 'test:capital-e' as provider_id from v_t""",
)
def _(spark, folder):
    provider = providers.Provider(
        id="test:capital-e", kind="local", prompt_version="v1", max_batch_size=16, translate=_capital_e
    )
    s = v.typed_strings(spark, folder)
    return providers.translate_with(s, provider).select(
        "doc_id", F.md5("translated_text").alias("translated"), "error", "provider_id"
    )


@query(
    "contract_violations",
    f"""select {_KEYS}, 1 as asked, case when doc_id % 10 = 3 then 0 else 2 end as given from v_s
 where doc_id % 10 in (3, 4)""",
)
def _(spark, folder):
    s = v.strings(spark, folder)
    copies = F.expr("case doc_id % 10 when 3 then 0 when 4 then 2 else 1 end")
    results = s.select("*", F.explode(F.array_repeat(F.lit(1), copies)).alias("_i"))
    return providers.contract_violations(s, results)


@query(
    "score_with",
    """select doc_id, round(1.0 - abs(length(source_text) - length(translated_text))::double
 / greatest(length(translated_text), 1), 6) as score from v_c""",
)
def _(spark, folder):
    def closeness(source, translated):
        return 1.0 - (source.str.len() - translated.str.len()).abs() / translated.str.len().clip(1)

    return providers.score_with(v.candidates(spark, folder), closeness).select(
        "doc_id", F.round("score", 6).alias("score")
    )


# ---- gates and routing ---------------------------------------------------------------------------------


@query(
    "check_placeholders",
    "select doc_id, array_to_string(f, '|') as failures, len(f) = 0 as passed from (select doc_id,"
    f" list_concat({o.messages('positional', 'source_text', 'translated_text')},"
    f" {o.messages('named', 'source_text', 'translated_text')}) as f from v_c)",
)
def _(spark, folder):
    return gates.check_placeholders(v.candidates(spark, folder)).select(
        "doc_id", F.array_join("failures", "|").alias("failures"), "passed"
    )


@query(
    "validate",
    "select doc_id, array_to_string(failures, '|') as failures, passed, validation_status from v_v",
)
def _(spark, folder):
    return gates.validate(v.candidates(spark, folder)).select(
        "doc_id", F.array_join("failures", "|").alias("failures"), "passed", "validation_status"
    )


@query(
    "route",
    f"select {_KEYS}, semantic_type, tokens, tier, reason, md5(reused) as reused from v_route",
)
def _(spark, folder):
    routed = routing.route(
        v.typed_strings(spark, folder),
        v.memory(spark, folder),
        v.glossary_from_memory(spark, folder),
        POLICY,
    )
    return routed.select(
        *KEY, "semantic_type", "tokens", "tier", "reason", F.md5("reused_translation").alias("reused")
    )


@query(
    "route_disagreement",
    f"select {_KEYS}, semantic_type, tokens, tier, reason, md5(reused) as reused from v_route2",
)
def _(spark, folder):
    passes = providers.provider_disagreement(v.two_passes(spark, folder), "p0", "p1", list(KEY))
    routed = routing.route(
        v.typed_strings(spark, folder),
        _index(spark, folder),
        v.glossary_from_memory(spark, folder),
        replace(POLICY, min_agreement=0.95),
        passes,
    )
    return routed.select(
        *KEY, "semantic_type", "tokens", "tier", "reason", F.md5("reused_translation").alias("reused")
    )


@query(
    "collapse_attempts",
    """select event_id, key, row_number() over w as attempt, (sum(failed::int) over w)::bigint as failures_so_far,
 row_number() over w >= 3 as exhausted from v_r window w as (partition by key order by ts, event_id
 rows between unbounded preceding and current row)""",
)
def _(spark, folder):
    return routing.collapse_attempts(v.runs(spark, folder), ["key"]).select(
        "event_id", "key", "attempt", "failures_so_far", "exhausted"
    )


@query(
    "last_attempts",
    """select key, provider, count(*) as attempts, count_if(failed)::bigint as failures,
 arg_max(failed, (ts, event_id)) as last_failed, count(*) >= 3 as exhausted from v_r group by key, provider""",
)
def _(spark, folder):
    return routing.last_attempts(v.runs(spark, folder), ["key", "provider"])


# Runs are tied to candidates through the run key: string n belongs to user n.
_ESCALATE_BASE = "select v_v.*, kind, 'u' || doc_id as key from v_v left join v_prov on provider_id = id"


@query(
    "escalate",
    f"""select doc_id, coalesce(attempts, 1) as attempts_made, case when passed then 'done'
 when kind = 'remote' then 'review' when coalesce(attempts, 1) >= 3 then 'remote' else 'retry_local' end as next_step
from ({_ESCALATE_BASE}) b left join (select key, count(*) as attempts from v_r
 where provider in ('view', 'click') group by key) a on a.key = b.key""",
)
def _(spark, folder):
    checked = gates.validate(v.candidates(spark, folder)).withColumn("provider", F.col("provider_id"))
    placed = providers.attach_provider(checked, v.providers(spark)).withColumn(
        "key", F.concat(F.lit("u"), F.col("doc_id").cast("string"))
    )
    tried = v.runs(spark, folder).filter(F.col("provider").isin("view", "click"))
    attempts = routing.last_attempts(tried, ["key"])
    return routing.escalate(placed, attempts, ["key"]).select("doc_id", "attempts_made", "next_step")


_REVIEWED = f"""(select *, case when passed and len(d) = 0 and semantic_type is distinct from 'letter_message'
 then 'auto_accepted' else 'unreviewed' end as review_status from (select *, {o.DIFFICULTY} as d from v_v))"""


@query("assign_review_status", f"select doc_id, review_status from {_REVIEWED}")
def _(spark, folder):
    checked = gates.validate(v.candidates(spark, folder))
    return routing.assign_review_status(checked, POLICY).select("doc_id", "review_status")


@query(
    "review_queue",
    f"""select doc_id, case when not passed then 'failed' when semantic_type is not distinct from
 'letter_message' then 'always_review' else 'difficult' end as why from {_REVIEWED} where review_status = 'unreviewed'""",
)
def _(spark, folder):
    checked = gates.validate(v.candidates(spark, folder))
    reviewed = routing.assign_review_status(checked, POLICY).select(
        "doc_id", *KEY, "semantic_type", "passed", "review_status"
    )
    # Stored, as the candidates of a run are: a sort first samples its input, and a filter copies what
    # it tests, so the gates would search every text several times.
    return routing.review_queue(stored(reviewed, "reviewed"), POLICY).select("doc_id", "why")


# ---- run halves --------------------------------------------------------------------------------------------

_MADE = f"""(select r.*, case when tier in ('tm', 'glossary') then reused else '[RU] ' || min(source_text) over (
 partition by tier, sha256({o.normalized('source_text')}), {o.sequence('source_text')}, semantic_type) end as translated_text
 from v_route r)"""


@query(
    "translate_flow",
    f"""select {_KEYS}, tier, validation_status, case when validation_status = 'passed' and len(difficulty) = 0
 and semantic_type is distinct from 'letter_message' then 'auto_accepted' else 'unreviewed' end as review_status,
 md5(translated_text) as translation from (
 select *, case when len({o.all_messages('source_text', 'translated_text')}) = 0 then 'passed' else 'failed' end
 as validation_status from {_MADE})""",
)
def _(spark, folder):
    made = flows.translate_flow(
        v.typed_strings(spark, folder),
        v.memory(spark, folder),
        v.glossary_from_memory(spark, folder),
        POLICY,
    )
    return made.select(
        *KEY, "tier", "validation_status", "review_status", F.md5("translated_text").alias("translation")
    )


_TODO = f"""(select s.* from v_route s left join v_tm m on {_on('s', 'm')}
 where m.key_path is null or m.value_hash <> sha256(s.source_text)) r"""


@query(
    "incremental_run",
    f"""select * from (select {_KEYS}, md5(source_text) as source, md5(translated_text) as translation,
 case when tier in ('tm', 'glossary') then 'reuse:' || tier else 'skeleton:passthrough' end as provider, true as renewed
 from {_MADE.replace('v_route r', _TODO)} where len({o.all_messages('source_text', 'translated_text')}) = 0
union all select {_KEYS}, md5(source_text), md5(translation), provider, false from v_tm)
qualify row_number() over (partition by {_KEYS} order by renewed desc) = 1""",
)
def _(spark, folder):
    tm = v.memory(spark, folder)
    made = incremental_run(
        v.typed_strings(spark, folder), tm, v.glossary_from_memory(spark, folder), new_dir(spark, "runs"),
        datetime(2100, 1, 1), POLICY,
    )
    return made.memory.select(
        *KEY,
        F.md5("source_text").alias("source"),
        F.md5("translation").alias("translation"),
        "provider",
        (F.col("updated_at") >= F.lit("2100-01-01").cast("timestamp")).alias("renewed"),
    )
