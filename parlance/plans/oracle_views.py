"""SQL forms of the derived views and of the shared expressions, for checking in another engine."""

from __future__ import annotations

from parlance.functions.text import SPACE_RUN, WHITESPACE, WORD
from parlance.functions.tokens import ANY_TOKEN, CONTROL, ENTITY, MECHANISMS, RICH_TEXT


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {quoted(WHITESPACE)})"


def mask(x: str, mark: str = "{#}") -> str:
    return f"regexp_replace({x}, {quoted(ANY_TOKEN)}, {quoted(mark)}, 'g')"


def normalized(x: str) -> str:
    return f"trim(regexp_replace({mask(x)}, {quoted(SPACE_RUN)}, ' ', 'g'))"


def term_list(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {quoted(WORD)})"


def term_key(x: str) -> str:
    return f"array_to_string({term_list(x)}, ' ')"


def template_key(x: str) -> str:
    return term_key(mask(x, " "))


def tokens(mechanism: str, x: str) -> str:
    return f"regexp_extract_all({x}, {quoted(MECHANISMS[mechanism][0])}, 1)"


def signature(x: str) -> str:
    sides = [f"array_to_string(list_sort({tokens(m, x)}), ',')" for m in ("positional", "named")]
    return " || '|' || ".join(sides)  # compared only with itself


def sequence(x: str) -> str:
    return f"array_to_string(regexp_extract_all({x}, {quoted(ANY_TOKEN)}), ',')"


def estimate(x: str) -> str:
    return f"cast(ceil(length({x}) / 4.0) as bigint)"


def bucket(n: str, *cols: str) -> str:
    text = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in cols)
    return f"(cast('0x' || substr(md5(concat_ws(chr(1), {text})), 1, 8) as bigint) % ({n}))"


def parts(rows: str, most: int) -> str:
    return f"cast(pow(2, ceil(log2(ceil({rows} / {float(most)})))) as bigint)"



def count_of(x: str, needle: str, size: int) -> str:
    return f"((length({x}) - length(replace({x}, {needle}, ''))) // {size})"


def stray(x: str) -> str:
    rest = f"regexp_replace({x}, {quoted(RICH_TEXT + '|' + ENTITY)}, '', 'g')"
    return f"(length({rest}) - length(translate({rest}, '<>&', '')))"


def has_control(x: str) -> str:
    return f"regexp_matches({x}, {quoted(CONTROL)})"


def surplus_messages(mechanism: str, have: str, other: str, verb: str, tail: str) -> str:
    _, before, after, _ = MECHANISMS[mechanism]
    counted = (
        f"list_transform(list_sort(list_distinct({have})), lambda t: {{'t': t, 'n': "
        f"len(list_filter({have}, lambda x: x = t)) - len(list_filter({other}, lambda y: y = t))}})"
    )
    return (
        f"list_transform(list_filter({counted}, lambda s: s.n > 0), lambda s: "
        f"{quoted(mechanism + ' token ' + before)} || s.t || {quoted(after + ' ' + verb + ' ')} "
        f"|| s.n || {quoted('x ' + tail)})"
    )


def messages(mechanism: str, src: str, out: str) -> str:
    a, b = tokens(mechanism, src), tokens(mechanism, out)
    missing = surplus_messages(mechanism, a, b, "missing", "in translation")
    extra = surplus_messages(mechanism, b, a, "appears", "extra in translation")
    return f"list_concat({missing}, {extra})"


def escape_messages(src: str, out: str) -> str:
    one, nl, two = "'\\n'", "chr(10)", "'\\\\n'"
    lost = f"({count_of(src, one, 2)} - {count_of(out, one, 2)})"
    return (
        f"list_filter([case when {lost} <> 0 then 'escape count differs by ' || (-{lost}) end, "
        f"case when {count_of(out, nl, 1)} > {count_of(src, nl, 1)} then "
        f"'escape expanded to a newline' end, "
        f"case when {count_of(out, two, 3)} > {count_of(src, two, 3)} then 'escape doubled' end], "
        f"lambda m: m is not null)"
    )


def xml_messages(src: str, out: str) -> str:
    return (
        f"list_filter([case when {stray(out)} > {stray(src)} then 'xml stray markup added' end, "
        f"case when {has_control(out)} then 'xml illegal control character' end], "
        f"lambda m: m is not null)"
    )


def all_messages(src: str, out: str) -> str:
    lists = [messages(m, src, out) for m in ("positional", "named", "rulepack", "richtext")]
    lists += [escape_messages(src, out), xml_messages(src, out)]
    return "flatten([" + ", ".join(lists) + "])"


SEMANTIC = """case when domain = 'Keyed' and regexp_matches(key_path, '^Letter.*') then 'letter_message'
 when domain = 'Keyed' and regexp_matches(key_path, '^Quest.*') then 'quest_text'
 when def_type = 'ThingDef' then 'thing_label' when def_type = 'HediffDef' then 'medical_condition'
 when def_type = 'TraitDef' then 'trait' when def_type = 'GeneDef' then 'gene' end"""

DIFFICULTY = f"""list_filter([case when {estimate('source_text')} > 400 then 'long_text' end,
 case when len({tokens('positional', 'source_text')}) + len({tokens('named', 'source_text')}) >= 4
 then 'token_heavy' end,
 case when len({tokens('rulepack', 'source_text')}) >= 1 then 'rule_heavy' end],
 lambda f: f is not null)"""

VIEWS: dict[str, str] = {}

VIEWS["v_s"] = r"""select source as mod_id, doc_id,
 case doc_id % 3 when 0 then 'DefInjected' when 1 then 'Keyed' else 'Strings' end as domain,
 case when doc_id % 3 = 0 then case doc_id % 4 when 0 then 'ThingDef' when 1 then 'HediffDef'
   when 2 then 'TraitDef' else 'GeneDef' end end as def_type,
 case doc_id % 3 when 0 then concat('Def', doc_id, '.label')
   when 1 then concat(case doc_id % 5 when 0 then 'Letter' when 1 then 'Quest' else 'Msg' end, doc_id)
   else concat('pool', doc_id % 4, '.txt#', doc_id) end as key_path,
 case doc_id % 3 when 0 then concat('Defs_', lang) when 1 then concat('Texts_', lang)
   else concat('pool', doc_id % 4) end as file,
 concat(text, ' {0} {1} {PAWN_nameDef}',
   case when doc_id % 4 = 0 then ' <b>[pawn_nameFull]</b>' else '' end,
   case when doc_id % 6 = 1 then '\n' else '' end) as source_text, lang
from documents"""

VIEWS["v_t"] = f"select *, {SEMANTIC} as semantic_type from v_s"

VIEWS["v_lab"] = (
    "select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id"
)

VIEWS["v_tm0"] = """select v_t.doc_id as id, mod_id, domain, def_type,
 case when quality = 0 then key_path || '_old' else key_path end as key_path, semantic_type,
 case when toxic = 1 then source_text || ' reworded' else source_text end as source_text
from v_t join v_lab on v_t.doc_id = v_lab.doc_id"""

_STORED = (
    f"{normalized('source_text')} as normalized_source, "
    f"sha256({normalized('source_text')}) as source_hash, sha256(source_text) as value_hash"
)

VIEWS["v_tm"] = f"""select id, mod_id, domain, def_type, key_path, semantic_type, source_text, {_STORED},
 '[RU] ' || case when id % 11 = 0 then replace(source_text, '{{0}}', '') else source_text end as translation,
 'p' || (id % 2) as provider, 'v1' as prompt_version, '1.0' as mod_version, 'passed' as validation_status,
 case when id % 5 = 0 then 'unreviewed' else 'human_accepted' end as review_status,
 timestamp '2024-01-01' + to_seconds(id) as updated_at from v_tm0"""

VIEWS["v_upd"] = f"""select doc_id + 1000000000 as id, mod_id, domain, def_type, key_path, semantic_type,
 source_text, {_STORED}, '[RU2] ' || source_text as translation, 'p2' as provider, 'v2' as prompt_version,
 '1.1' as mod_version, 'passed' as validation_status, 'unreviewed' as review_status,
 timestamp '2025-01-01' + to_seconds(doc_id) as updated_at from v_t"""

VIEWS["v_h"] = "select * from v_tm union all select * from v_upd"

VIEWS["v_c"] = r"""select *, 'p' || (doc_id % 2) as provider_id, 'v1' as prompt_version,
 '[RU] ' || case doc_id % 9 when 0 then replace(source_text, '{0}', '')
 when 1 then replace(source_text, '{PAWN_nameDef}', '{pawn_namedef}')
 when 2 then concat(source_text, ' {0} {0}') when 3 then replace(source_text, '<b>', '')
 when 4 then replace(source_text, '[pawn_nameFull]', '') when 5 then concat(source_text, '\n')
 when 6 then concat(source_text, ' <3') else source_text end as translated_text from v_t"""

VIEWS["v_v"] = f"""select *, len(failures) = 0 as passed,
 case when len(failures) = 0 then 'passed' else 'failed' end as validation_status
from (select *, {all_messages('source_text', 'translated_text')} as failures from v_c)"""

VIEWS["v_c2"] = """select v_c.* exclude (provider_id, translated_text), p as provider_id,
 case when p = 'p1' and doc_id % 2 = 0 then '[RU] ' || source_text else translated_text end as translated_text
from v_c, (values ('p0'), ('p1')) t(p)"""

VIEWS["v_v2"] = f"""select *, len(failures) = 0 as passed
from (select *, {all_messages('source_text', 'translated_text')} as failures from v_c2)"""

VIEWS["v_e"] = """select source as mod_id, concat('f', doc_id % 3, '_', doc_id // 6000, '.xml') as file, doc_id as pos,
 concat('K', doc_id // 120) as key, text as value from documents"""

VIEWS["v_r"] = r"""select event_id, ts, concat('u', user_id) as key, event_type as provider,
 value as latency, cast(regexp_extract(props, '"k": *(\d+)', 1) as int) as tokens,
 cast(regexp_extract(props, '"k": *(\d+)', 1) as int) < 20 as failed from events"""

VIEWS["v_gm"] = f"""select scope, case when scope = 'mod' then mod_id when scope = 'semantic_type'
 then semantic_type end as scope_value, term, 'RU:' || key_path || ' {{0}} {{1}} {{PAWN_nameDef}}' as preferred
from (select v_t.*, {template_key('source_text')} as term, case when toxic = 1 then 'mod'
 when quality = 0 and semantic_type is not null then 'semantic_type' else 'global' end as scope
 from v_t join v_lab on v_t.doc_id = v_lab.doc_id)"""

# One row per (scope, scope value, term).
VIEWS["v_gl"] = """select scope, coalesce(scope_value, '') as scope_value, term as term_key,
 min(preferred) as preferred from v_gm group by all"""

VIEWS["v_gw"] = """select * from (values
 ('global', '', 'the', 'G-the', ['teh', '[RU] the']), ('global', '', 'of the', 'G-of-the', ['of that']),
 ('global', '', 'that', 'G-that', []), ('global', '', 'la', 'G-la', ['le']),
 ('global', '', 'der', 'G-der', ['die']), ('mod', 'src1', 'the', 'M1-the', ['and']),
 ('mod', 'src2', 'that', 'M2-that', []), ('semantic_type', 'thing_label', 'the', 'T-the', ['of']),
 ('semantic_type', 'quest_text', 'que', 'Q-que', ['de la']))
 t(scope, scope_value, term_key, preferred, forbidden)"""

VIEWS["v_prov"] = """select * from (values ('view', 'local', 'model-a', 120.0, 2, 16),
 ('click', 'local', 'model-b', 60.0, 1, 32), ('purchase', 'remote', 'model-c', 60.0, 1, 64),
 ('signup', 'remote', 'model-d', 30.0, 0, 8), ('p0', 'local', 'model-e', 60.0, 2, 7),
 ('p1', 'remote', 'model-f', 60.0, 2, 11)) t(id, kind, model, timeout_seconds, max_retries, max_batch_size)"""

VIEWS["v_mods"] = r"""select 'mod.' || lpad(cast(page_id as varchar), 9, '0') as mod_id,
 regexp_extract(url, '^https?://([^/]+)', 1) || ' & <friends>' as name from pages"""

VIEWS["v_pairs"] = r"""select doc_id, source, lang, text as reference,
 array_to_string(list_filter(regexp_split_to_array(text, '[ \n]+'), lambda x, i: (i - 1) % 5 <> 4), ' ') as hypothesis
from documents"""

# Memory rows that may be reused, one per own-mod and one per any-mod lookup key.
VIEWS["v_own"] = f"""select mod_id, source_hash, semantic_type, sig, arg_max(translation, (updated_at, id)) as translation
from (select *, {signature('translation')} as sig from v_tm
 where validation_status = 'passed' and review_status in ('auto_accepted', 'human_accepted'))
group by all"""

VIEWS["v_any"] = """select source_hash, semantic_type, sig, arg_min(translation, mod_id) as translation
from v_own group by all"""

VIEWS["v_look"] = f"""select s.mod_id, s.doc_id, s.domain, s.def_type, s.key_path, s.semantic_type,
 s.source_text, s.h as source_hash, coalesce(o.translation, a.translation) as tm_translation,
 case when o.translation is not null then 'same_mod' when a.translation is not null then 'cross_mod' end as tm_scope
from (select *, sha256({normalized('source_text')}) as h, {signature('source_text')} as g from v_t) s
left join v_own o on o.mod_id = s.mod_id and o.source_hash = s.h and o.sig = s.g
 and o.semantic_type is not distinct from s.semantic_type
left join v_any a on a.source_hash = s.h and a.sig = s.g
 and a.semantic_type is not distinct from s.semantic_type"""

VIEWS["v_route0"] = f"""select l.*, {estimate('source_text')} as tokens, {DIFFICULTY} as difficulty,
 coalesce(m.preferred, y.preferred, g.preferred) as preferred,
 case when m.preferred is not null then 'mod' when y.preferred is not null then 'semantic_type'
  when g.preferred is not null then 'global' end as layer, l.template,
 {signature('source_text')} as sig
from (select *, {template_key('source_text')} as template from v_look) l
left join v_gl m on m.scope = 'mod' and m.scope_value = l.mod_id and m.term_key = l.template
left join v_gl y on y.scope = 'semantic_type' and y.scope_value = l.semantic_type and y.term_key = l.template
left join v_gl g on g.scope = 'global' and g.term_key = l.template"""

VIEWS["v_route"] = f"""select *, case when tier = 'tm' then 'tm:' || tm_scope
 when tier = 'glossary' then 'glossary:' || layer
 when tier = 'remote' then array_to_string(list_concat(
  case when semantic_type is not distinct from 'quest_text' then ['always_escalate'] else [] end, difficulty), '+')
 else '' end as reason,
 case when tier = 'tm' then tm_translation when tier = 'glossary' then preferred end as reused
from (select *, case when tm_scope is not null then 'tm'
 when template <> '' and sig = {signature('preferred')} then 'glossary'
 when semantic_type is not distinct from 'quest_text' or len(difficulty) > 0 then 'remote'
 else 'local' end as tier from v_route0)"""

VIEWS["v_apart"] = """select doc_id, round(len(list_intersect(a, b)) /
 greatest(len(a) + len(b) - len(list_intersect(a, b)), 1), 6) as similarity from (
select doc_id, list_distinct(list_filter(regexp_split_to_array(x, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) as a,
 list_distinct(list_filter(regexp_split_to_array(y, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) as b
from (select doc_id, max(case when provider_id = 'p0' then translated_text end) as x,
 max(case when provider_id = 'p1' then translated_text end) as y from v_c2 group by doc_id) where x <> y)"""

VIEWS["v_route1"] = """select r.* replace (case when a.similarity < 0.95 then list_append(difficulty, 'disagreement')
 else difficulty end as difficulty) from v_route0 r left join v_apart a on a.doc_id = r.doc_id"""

VIEWS["v_route2"] = VIEWS["v_route"].replace("v_route0", "v_route1")
