"""Queries for scalar functions, filters, checks and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.functions import keys, text, tokens
from parlance.operators import gates, merging, providers, quality, reports, routing
from parlance.plans import oracle_views as o
from parlance.plans import views as v
from parlance.plans.registry import query
from parlance.sources.workdir import new_dir


def joined(column, sep: str = "|"):
    return F.array_join(column, sep)


# ---- token functions -------------------------------------------------------------------------


def _token_query(name: str, mechanism: str, fn, base: str, column: str, ident: str):
    sql = (
        f"select {ident}, array_to_string(list_sort({o.tokens(mechanism, column)}), '|') as tokens,"
        f" len({o.tokens(mechanism, column)}) as n from {base}"
    )

    def run(spark, folder):
        df = v.candidates(spark, folder) if base == "v_c" else v.table(spark, folder, base)
        found = df.select(ident, fn(column).alias("t"))
        return found.select(
            ident, joined(F.sort_array("t")).alias("tokens"), F.size("t").cast("bigint").alias("n")
        )

    query(name, sql)(run)


_token_query("positional_tokens", "positional", tokens.positional_tokens, "v_c", "translated_text", "doc_id")
_token_query("named_tokens", "named", tokens.named_tokens, "v_c", "translated_text", "doc_id")
_token_query("rulepack_symbols", "rulepack", tokens.rulepack_symbols, "v_c", "translated_text", "doc_id")
_token_query("rich_text_tags", "richtext", tokens.rich_text_tags, "pages", "html", "page_id")


@query(
    "escape_sequence_check",
    f"select doc_id, array_to_string({o.escape_messages('source_text', 'translated_text')}, '|')"
    " as failures from v_c",
)
def _(spark, folder):
    check = tokens.escape_sequence_check("source_text", "translated_text")
    return v.candidates(spark, folder).select("doc_id", joined(check).alias("failures"))


@query(
    "xml_safe_check",
    f"select page_id, {o.stray('html')} as stray,"
    f" {o.stray('html')} = 0 and not {o.has_control('html')} as safe from pages"
    f" union all select -1 - doc_id, {o.stray('translated_text')},"
    f" {o.stray('translated_text')} = 0 and not {o.has_control('translated_text')} from v_c",
)
def _(spark, folder):
    def checked(df, ident, column):
        return df.select(
            ident.alias("page_id"),
            tokens.stray_markup(column).cast("bigint").alias("stray"),
            tokens.xml_safe_check(column).alias("safe"),
        )

    pages = checked(v.table(spark, folder, "pages"), F.col("page_id"), "html")
    return pages.unionAll(
        checked(v.candidates(spark, folder), -1 - F.col("doc_id"), "translated_text")
    )


@query(
    "failure_messages",
    "select doc_id, array_to_string(list_concat("
    f"{o.messages('positional', 'source_text', 'translated_text')},"
    f" {o.messages('named', 'source_text', 'translated_text')}), '|') as failures from v_c",
)
def _(spark, folder):
    found = tokens.failure_messages("source_text", "translated_text")
    return v.candidates(spark, folder).select("doc_id", joined(found).alias("failures"))


# ---- text functions --------------------------------------------------------------------------


@query(
    "xml_escape",
    "select page_id, md5(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))"
    " as escaped from pages",
)
def _(spark, folder):
    return v.table(spark, folder, "pages").select(
        "page_id", F.md5(text.xml_escape("html")).alias("escaped")
    )


@query(
    "xml_unescape",
    "select page_id, md5(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'),"
    " '&quot;', '\"'), '&apos;', ''''), '&amp;', '&')) as plain,"
    " true as round_trip from pages",
)
def _(spark, folder):
    return v.table(spark, folder, "pages").select(
        "page_id",
        F.md5(text.xml_unescape("html")).alias("plain"),
        (text.xml_unescape(text.xml_escape("html")) == F.col("html")).alias("round_trip"),
    )


@query(
    "comment_safe",
    "select page_id, md5(' EN: ' || rtrim(replace(html || '--x---', '--', '––'), '-') || ' ')"
    " as comment from pages",
)
def _(spark, folder):
    dashed = F.concat("html", F.lit("--x---"))
    return v.table(spark, folder, "pages").select(
        "page_id", F.md5(text.comment_safe(dashed)).alias("comment")
    )


@query("mask_placeholders", f"select doc_id, {o.mask('translated_text')} as masked from v_c")
def _(spark, folder):
    return v.candidates(spark, folder).select(
        "doc_id", text.mask_placeholders("translated_text").alias("masked")
    )


@query("normalize_source", f"select doc_id, {o.normalized('source_text')} as normalized from v_s")
def _(spark, folder):
    return v.strings(spark, folder).select(
        "doc_id", text.normalize_source("source_text").alias("normalized")
    )


@query(
    "source_hash",
    f"select doc_id, sha256({o.normalized('source_text')}) as source_hash from v_s",
)
def _(spark, folder):
    return v.strings(spark, folder).select(
        "doc_id", text.source_hash("source_text").alias("source_hash")
    )


@query("value_hash", "select doc_id, sha256(source_text) as value_hash from v_s")
def _(spark, folder):
    return v.strings(spark, folder).select(
        "doc_id", text.value_hash("source_text").alias("value_hash")
    )


_PADDED = "chr(9) || ' ' || chr(160) || text || chr(8195) || chr(13) || chr(10)"


@query("strip", f"select doc_id, md5({o.strip(_PADDED)}) as stripped from documents")
def _(spark, folder):
    padded = F.concat(F.lit("\t  "), F.col("text"), F.lit(" \r\n"))
    return v.table(spark, folder, "documents").select(
        "doc_id", F.md5(text.strip(padded)).alias("stripped")
    )


@query("estimate_tokens", f"select doc_id, {o.estimate('source_text')} as tokens from v_s")
def _(spark, folder):
    return v.strings(spark, folder).select(
        "doc_id", text.estimate_tokens("source_text").alias("tokens")
    )


# ---- keys and paths --------------------------------------------------------------------------

_DEF_KEY = (
    "case doc_id % 4 when 0 then concat('Def', doc_id, '.stages.', doc_id % 7, '.label')"
    " when 1 then concat('Def', doc_id, '.labelFemale') when 2 then concat('Def', doc_id,"
    " '.comps.', doc_id % 3, '.parts.', doc_id % 5, '.labelMale') else key_path end"
)


@query(
    "parse_def_key",
    f"""select doc_id, p[1] as def_name, array_to_string(p[2:], '.') as field_path,
 array_to_string(list_filter(p[2:], lambda x: not regexp_matches(x, '^[0-9]+$')), '.') as field_pattern,
 array_to_string(list_filter(p[2:], lambda x: regexp_matches(x, '^[0-9]+$')), ',') as list_indices,
 regexp_extract(k, '(Female|Male)$', 1) as gender
from (select doc_id, k, string_split(k, '.') as p from (select doc_id, {_DEF_KEY} as k from v_s))""",
)
def _(spark, folder):
    parsed = keys.parse_def_key(F.expr(_DEF_KEY))
    return v.strings(spark, folder).select("doc_id", parsed.alias("p")).select("doc_id", "p.*")


_PATH = (
    "concat('/data/mods/', mod_id, case when doc_id % 5 = 0 then '/1.6' when doc_id % 5 = 1"
    " then '/1.5' else '' end, case when doc_id % 7 = 6 then '/Textures/' else '/Languages/English/' end,"
    " domain, case when domain = 'DefInjected' then '/' || def_type else '' end, '/', file,"
    " case when domain = 'Strings' then '.txt' else '.xml' end)"
)


@query(
    "parse_resource_path",
    f"""select doc_id, case when ok then mod_id end as mod_dir,
 case when ok then case doc_id % 5 when 0 then '1.6' when 1 then '1.5' end end as version,
 case when ok then 'English' end as language, case when ok then domain end as domain,
 case when ok then def_type end as def_type, case when ok then file end as file_stem
from (select *, doc_id % 7 <> 6 as ok, {_PATH} as path from v_s)""",
)
def _(spark, folder):
    parsed = keys.parse_resource_path(F.expr(_PATH))
    return v.strings(spark, folder).select("doc_id", parsed.alias("p")).select("doc_id", "p.*")


@query(
    "output_path",
    """select doc_id, concat('Languages/Russian/', domain, '/',
 case when domain = 'DefInjected' then def_type || '/' else '' end, mod_id, '__', file,
 case when domain = 'Strings' then '.txt' else '.xml' end) as path from v_s""",
)
def _(spark, folder):
    path = keys.output_path("mod_id", "domain", "def_type", "file")
    return v.strings(spark, folder).select("doc_id", path.alias("path"))


@query(
    "parse_provider_id",
    """select doc_id, 'local' as kind, mod_id as backend,
 case when doc_id % 3 = 0 then 'm:' || lang when doc_id % 3 = 1 then lang end as model from v_s""",
)
def _(spark, folder):
    raw = F.expr(
        "concat('local:', mod_id, case doc_id % 3 when 0 then concat(':m:', lang)"
        " when 1 then concat(':', lang) else '' end)"
    )
    parsed = keys.parse_provider_id(raw)
    return v.strings(spark, folder).select("doc_id", parsed.alias("p")).select("doc_id", "p.*")


@query(
    "classify_domain_by_key",
    "select doc_id, case when contains(key_path, '.') then 'DefInjected' else 'Keyed' end"
    " as inferred from v_s",
)
def _(spark, folder):
    return v.strings(spark, folder).select(
        "doc_id", keys.classify_domain_by_key("key_path").alias("inferred")
    )


@query(
    "difficulty_flags",
    f"select doc_id, array_to_string({o.DIFFICULTY}, '|') as difficulty from v_t",
)
def _(spark, folder):
    return routing.difficulty_flags(v.typed_strings(spark, folder)).select(
        "doc_id", joined("difficulty").alias("difficulty")
    )


# ---- filters and checks ----------------------------------------------------------------------


@query(
    "filter_emittable",
    "select doc_id, mod_id, key_path from v_v where validation_status = 'passed'",
)
def _(spark, folder):
    checked = gates.validate(v.candidates(spark, folder))
    return quality.filter_emittable(checked).select("doc_id", "mod_id", "key_path")


@query(
    "quarantine",
    """select pos, mod_id, file, case when contains(value, '&') then 'unescaped ampersand' end as error,
 not contains(value, '&') as good from v_e""",
)
def _(spark, folder):
    bad = F.when(F.contains("value", F.lit("&")), "unescaped ampersand")
    good, failed = quality.quarantine(v.entries(spark, folder).withColumn("error", bad))
    cols = ["pos", "mod_id", "file"]
    return (
        good.select(*cols, F.lit(None).cast("string").alias("error"), F.lit(True).alias("good"))
        .unionAll(failed.select(*cols, "error", F.lit(False)))
    )


_RAW_NAME = "case page_id % 6 when 0 then ' ' || chr(9) when 1 then '' when 2 then null else url end"
_RAW_ID = "case page_id % 5 when 0 then chr(160) else url end"


@query(
    "check_required_fields",
    f"""select page_id, 'missing mod_id' as rule from pages where {o.strip(f"coalesce({_RAW_ID}, '')")} = ''
 union all select page_id, 'missing name' from pages where {o.strip(f"coalesce({_RAW_NAME}, '')")} = ''""",
)
def _(spark, folder):
    raw = v.table(spark, folder, "pages").select(
        "page_id",
        F.expr(_RAW_ID.replace("chr(160)", "unhex('C2A0')::string")).alias("mod_id"),
        F.expr(_RAW_NAME).alias("name"),
    )
    return quality.check_required_fields(raw, ["mod_id", "name"], ["page_id"])


@query(
    "clean_versions",
    """select page_id, concat('1.', page_id % 7, case when page_id % 3 = 0 then '' else '|1.6' end)
 as versions from pages""",
)
def _(spark, folder):
    raw = v.table(spark, folder, "pages").select(
        "page_id",
        F.expr(
            "array(concat('\\t1.', page_id % 7, ' '), '  ', "
            "case when page_id % 3 = 0 then '\\n' else '1.6\\r' end, '')"
        ).alias("supported_versions"),
    )
    return quality.clean_versions(raw).select(
        "page_id", joined("supported_versions").alias("versions")
    )


@query(
    "check_unique_ids",
    "select md5(text) as id, count(*) as occurrences from documents group by 1 having count(*) > 1",
)
def _(spark, folder):
    ids = v.table(spark, folder, "documents").select(F.md5("text").alias("id"))
    return quality.check_unique_ids(ids, "id")


@query(
    "check_exactly_one",
    """select doc_id, case when def_type is not null then 'both' else 'neither' end as rule
from (select *, case when doc_id % 2 = 0 then key_path when doc_id % 5 = 0 then '' end as pattern from v_s)
where (coalesce(def_type, '') <> '') = (coalesce(pattern, '') <> '')""",
)
def _(spark, folder):
    pattern = F.expr("case when doc_id % 2 = 0 then key_path when doc_id % 5 = 0 then '' end")
    rules = v.strings(spark, folder).withColumn("pattern", pattern)
    return quality.check_exactly_one(rules, "def_type", "pattern", ["doc_id"])


@query(
    "check_ranges",
    """select event_id, 'timeout_seconds > 0' as rule from v_r where not (latency - 1 > 0)
 union all select event_id, 'max_retries >= 0' from v_r where not (tokens - 10 >= 0)""",
)
def _(spark, folder):
    rules = [
        ("timeout_seconds > 0", F.col("timeout_seconds") > 0),
        ("max_retries >= 0", F.col("max_retries") >= 0),
    ]
    config = v.runs(spark, folder).select(
        "event_id",
        (F.col("latency") - 1).alias("timeout_seconds"),
        (F.col("tokens") - 10).alias("max_retries"),
    )
    return quality.check_ranges(config, rules, ["event_id"])


@query(
    "check_enums",
    """select doc_id, 'unknown domain' as rule from v_c where doc_id % 4 = 1
 union all select doc_id, 'unknown validation_status' from v_c where doc_id % 9 = 5
 union all select doc_id, 'unknown review_status' from v_c where doc_id % 8 = 3""",
)
def _(spark, folder):
    damaged = v.candidates(spark, folder).select(
        "doc_id",
        F.expr("case when doc_id % 4 = 1 then lower(domain) else domain end").alias("domain"),
        F.expr("case when doc_id % 9 = 5 then null else 'passed' end").alias("validation_status"),
        F.expr("case when doc_id % 8 = 3 then 'maybe' else 'rejected' end").alias("review_status"),
    )
    return quality.check_enums(damaged, ["doc_id"])


@query(
    "flatten_result",
    """select mod_id, domain, key_path, source_text, def_type, semantic_type, md5(translated_text)
 as translated, provider_id, prompt_version from v_c""",
)
def _(spark, folder):
    nested = quality.nest_result(v.candidates(spark, folder))
    return quality.flatten_result(nested).select(
        "mod_id",
        "domain",
        "key_path",
        "source_text",
        "def_type",
        "semantic_type",
        F.md5("translated_text").alias("translated"),
        "provider_id",
        "prompt_version",
    )


# ---- set operations and ordering ---------------------------------------------------------------


@query(
    "union_domains",
    """select domain, def_type, file, count(*) as strings, count(def_type) as typed,
 count(case when domain = 'Strings' then file end) as pooled from v_s group by all""",
)
def _(spark, folder):
    s = v.strings(spark, folder)
    keyed = s.filter("domain = 'Keyed'").drop("def_type")
    defs = s.filter("domain = 'DefInjected'")
    pools = s.filter("domain = 'Strings'").drop("def_type")
    return (
        merging.union_domains(keyed, defs, pools)
        .groupBy("domain", "def_type", "file")
        .agg(
            F.count(F.lit(1)).alias("strings"),
            F.count("def_type").alias("typed"),
            F.count(F.when(F.col("domain") == "Strings", F.col("file"))).alias("pooled"),
        )
    )


@query(
    "token_multiset_diff",
    f"""with a as (select doc_id, unnest({o.tokens('positional', 'translated_text')}) as token, 1 as d from v_c
 union all select doc_id, unnest({o.tokens('positional', 'source_text')}), -1 from v_c)
select doc_id, token, case when sum(d) < 0 then 'missing' else 'extra' end as kind, abs(sum(d))::bigint as n
from a group by doc_id, token having sum(d) <> 0""".replace("with a as", "select * from (with a as") + ")",
)
def _(spark, folder):
    return merging.token_multiset_diff(v.candidates(spark, folder), "positional", ["doc_id"])


_OUT_KEY = "case when doc_id % 13 = 0 then key_path || 'X' else key_path end"


@query(
    "key_set_integrity",
    f"""select mod_id, domain, def_type, key_path, 'lost' as status from (
 select mod_id, domain, def_type, key_path from v_s except
 select mod_id, domain, def_type, {_OUT_KEY} from v_s)
union all select mod_id, domain, def_type, key_path, 'invented' from (
 select mod_id, domain, def_type, {_OUT_KEY} as key_path from v_s except
 select mod_id, domain, def_type, key_path from v_s)""",
)
def _(spark, folder):
    s = v.strings(spark, folder)
    return merging.key_set_integrity(s, s.withColumn("key_path", F.expr(_OUT_KEY)))


_LINES = "select source as mod_id, 'pool' || doc_id || '.txt' as file, generate_subscripts(p, 1) - 1 as idx, unnest(p) as line from (select *, string_split(regexp_replace(text, '\\r?\\n$', ''), chr(10)) as p from documents)"
_OLD_LINE = "case when idx = 2 and length(line) % 3 = 0 then line || '!' else line end"


_REDIFF = f"""select mod_id, file, idx, line from ({_LINES}) where (mod_id, file) in (
 select (mod_id, file) from ({_LINES}) where {_OLD_LINE} <> line)"""


@query("rediff_changed_files", _REDIFF)
def _(spark, folder):
    from parlance.sources.resources import number_pool_lines

    lines = number_pool_lines(v.pool_lines(spark, folder), ["mod_id", "file"])
    old = lines.withColumn("line", F.expr(_OLD_LINE))
    return merging.rediff_changed_files(lines, old).select(
        "mod_id", "file", F.col("idx").cast("bigint").alias("idx"), "line"
    )


@query("stream_changed_files", _REDIFF)
def _(spark, folder):
    from parlance.sources.resources import number_pool_lines
    from parlance.streaming.files import changed_lines, stream_changed_files

    lines = number_pool_lines(v.pool_lines(spark, folder), ["mod_id", "file"])
    arriving, path, checkpoint = (new_dir(spark, n) for n in ("deliveries", "changed", "changed-checkpoint"))
    for version, text in enumerate((_OLD_LINE, "line")):
        delivered = lines.withColumns({"line": F.expr(text), "version": F.lit(version).cast("bigint")})
        delivered.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(delivered.schema).parquet(arriving)
        stream_changed_files(stream, path, checkpoint)
    return changed_lines(spark, path).select("mod_id", "file", F.col("idx").cast("bigint").alias("idx"), "line")


@query(
    "number_pool_lines",
    f"select mod_id, file, idx, md5(line) as line from ({_LINES})",
)
def _(spark, folder):
    from parlance.sources.resources import number_pool_lines

    return number_pool_lines(v.pool_lines(spark, folder), ["mod_id", "file"]).select(
        "mod_id", "file", F.col("idx").cast("bigint").alias("idx"), F.md5("line").alias("line")
    )


@query(
    "order_pack",
    """select mod_id, domain, def_type, key_path, row_number() over (partition by mod_id, domain, def_type,
 case when domain <> 'Keyed' then file end order by case when domain = 'Strings' then doc_id end, key_path) as position
from v_v where validation_status = 'passed'""",
)
def _(spark, folder):
    accepted = quality.filter_emittable(gates.validate(v.candidates(spark, folder)))
    return merging.order_pack(accepted.withColumn("idx", F.col("doc_id"))).select(
        "mod_id", "domain", "def_type", "key_path", "position"
    )


@query(
    "token_counts",
    f"""select doc_id, token, count(*) as n from (
 select doc_id, unnest({o.tokens('named', 'translated_text')}) as token from v_c) group by all""",
)
def _(spark, folder):
    return reports.token_counts(v.candidates(spark, folder), "named", ["doc_id"], "translated_text")


# ---- providers as expressions ------------------------------------------------------------------


@query(
    "passthrough_provider",
    """select mod_id, key_path, '[RU] ' || source_text as translated_text,
 'skeleton:passthrough' as provider_id, 'passthrough-v1' as prompt_version,
 'pending' as validation_status from v_t""",
)
def _(spark, folder):
    return providers.passthrough_provider(v.typed_strings(spark, folder)).select(
        "mod_id", "key_path", "translated_text", "provider_id", "prompt_version", "validation_status"
    )


@query(
    "echo_provider",
    "select mod_id, key_path, source_text as translated_text, 'test:echo' as provider_id from v_t",
)
def _(spark, folder):
    return providers.echo_provider(v.typed_strings(spark, folder)).select(
        "mod_id", "key_path", "translated_text", "provider_id"
    )
