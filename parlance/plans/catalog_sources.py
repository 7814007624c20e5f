"""Queries for readers, writers and stored tables. Files are written by Spark, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance import schemas
from parlance.functions.text import xml_escape
from parlance.operators import gates
from parlance.plans import oracle_views as o
from parlance.plans import views as v
from parlance.plans.registry import query
from parlance.schemas import KEY
from parlance.sources import datasets, packs, resources
from parlance.sources.pack_sink import write_tree
from parlance.sources.workdir import new_dir



def _bigint(name: str):
    return F.col(name).cast("bigint").alias(name)


# ---- trees of resource files ---------------------------------------------------------------------


def _shipped(spark, folder):
    """Every current string as an accepted entry whose text is the English one."""
    return v.strings(spark, folder).withColumns(
        {
            "idx": F.col("doc_id"),
            "translated_text": F.col("source_text"),
            "validation_status": F.lit("passed"),
        }
    )


def _write_tree(spark, strings, kinds: tuple[str, ...], language: str) -> str:
    """A tree of mods: every mod's packs below its own folder, published domain by domain."""
    base = new_dir(spark, "tree")
    lines = {"Keyed": packs.keyed_lines, "DefInjected": packs.definjected_lines, "Strings": packs.string_lines}
    for kind in kinds:
        rows = lines[kind](strings, language).withColumn("path", F.concat_ws("/", F.lit(kind), "mod_id", "path"))
        order, frame = (["idx"], packs.POOL) if kind == "Strings" else (["key_path"], packs.XML)
        write_tree(rows, order, f"{base}/domains", kind, **frame)
    if "Keyed" in kinds:
        # One malformed file per mod, which readers must set aside without losing the others.
        bad = strings.select("mod_id").distinct().select(
            F.concat(F.lit("Keyed/"), "mod_id", F.lit(f"/Languages/{language}/Keyed/Bad.xml")).alias("path"),
            F.lit("<LanguageData><Open></LanguageData>").alias("text"),
        )
        packs.write_files(bad, f"{base}/domains")
    return f"{base}/domains/*"


@query(
    "read_keyed",
    """select mod_id as mod_dir, mod_id || '.xml' as file, row_number() over (
 partition by mod_id order by key_path) - 1 as pos, key_path as key, md5(source_text) as value, false as bad
from v_s where domain = 'Keyed'
union all select mod_id, 'Bad.xml', -1, null, null, true from v_s where domain = 'Keyed' or true group by mod_id""",
)
def _(spark, folder):
    base = _write_tree(spark, _shipped(spark, folder), ("Keyed",), "English")
    return resources.read_keyed(spark, base).select(
        "mod_dir",
        "file",
        F.coalesce("pos", F.lit(-1)).alias("pos"),
        "key",
        F.md5("value").alias("value"),
        F.col("error").isNotNull().alias("bad"),
    )


@query(
    "parse_language_xml",
    r"""select page_id, count(*) as elements, min(v) as first_value, false as bad from (
 select page_id, md5(unnest(['a ', '', html, ' padded '])) as v from pages where page_id % 7 <> 3) group by page_id
union all select page_id, 0, null, true from pages where page_id % 7 = 3""",
)
def _(spark, folder):
    body = F.concat(
        F.lit("<LanguageData><!-- EN: x --><A>a <b>bold</b> tail</A><B/><C>"),
        xml_escape("html"),
        F.lit("</C><D> padded </D>"),
        F.when(F.col("page_id") % 7 == 3, "<Open>").otherwise(""),
        F.lit("</LanguageData>"),
    )
    files = v.table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("path"), F.encode(body, "UTF-8").alias("content")
    )
    parsed = resources.parse_language_xml(files)
    return parsed.groupBy(F.col("path").cast("bigint").alias("page_id")).agg(
        F.count("key").alias("elements"),
        F.min(F.md5("value")).alias("first_value"),
        F.max(F.col("error").isNotNull()).alias("bad"),
    )


@query(
    "read_definjected",
    """select mod_id as mod_dir, def_type, mod_id || '__' || file || '.xml' as file,
 key_path as key, md5(source_text) as value from v_s where domain = 'DefInjected'""",
)
def _(spark, folder):
    base = _write_tree(spark, _shipped(spark, folder), ("DefInjected",), "English")
    return resources.read_definjected(spark, base).select(
        "mod_dir", "def_type", "file", "key", F.md5("value").alias("value")
    )


_POOL = "(select *, replace(source_text, chr(10), '\\n') as line from v_s where domain = 'Strings')"


@query(
    "read_string_pools",
    f"""select mod_id as mod_dir, mod_id || '__' || file || '.txt' as file, row_number() over (
 partition by mod_id, file order by doc_id) - 1 as idx, md5(line) as line from {_POOL}""",
)
def _(spark, folder):
    base = _write_tree(spark, _shipped(spark, folder), ("Strings",), "English")
    return resources.read_string_pools(spark, base).select(
        "mod_dir", "file", _bigint("idx"), F.md5("line").alias("line")
    )


@query(
    "read_existing_translations",
    f"""select 'id.' || mod_id as mod_id, domain, def_type, key_path, md5(source_text) as translation from v_s
 where domain <> 'Strings' union all select 'id.' || mod_id, 'Strings', null, mod_id || '__' || file || '.txt#' || (row_number() over (
 partition by mod_id, file order by doc_id) - 1), md5(line) from {_POOL}""",
)
def _(spark, folder):
    kinds = ("Keyed", "DefInjected", "Strings")
    shipped = _shipped(spark, folder)
    base = _write_tree(spark, shipped, kinds, "Russian")
    # Ids differ from folder names.
    about = shipped.select("mod_id").distinct().select(
        F.concat("mod_id", F.lit("/About/About.xml")).alias("path"),
        F.concat(
            F.lit("<ModMetaData><packageId>id."), "mod_id", F.lit("</packageId><name>N</name></ModMetaData>")
        ).alias("text"),
    )
    packs.write_files(about.withColumn("path", F.concat(F.lit("Keyed/"), "path")), base.removesuffix("/*"))
    return resources.read_existing_translations(spark, base).withColumn(
        "translation", F.md5("translation")
    )


@query(
    "read_mods",
    r"""select 'd' || page_id as mod_dir, case when page_id % 9 = 4 then null else 'page.' || page_id end as mod_id,
 case when page_id % 9 = 4 then null when page_id % 9 = 5 then '' else url end as name,
 case when page_id % 9 = 4 then '' else '1.5|1.6' end as versions,
 case page_id % 9 when 4 then 'malformed manifest' when 5 then 'missing name' end as error from pages""",
)
def _(spark, folder):
    text = F.concat(
        F.lit("<?xml version='1.0' encoding='utf-8'?>\n<ModMetaData>\n  <packageId>\n page."),
        F.col("page_id").cast("string"),
        F.lit("\t</packageId><name> "),
        F.when(F.col("page_id") % 9 == 5, " ").otherwise(xml_escape("url")),
        F.lit("</name><supportedVersions><li>1.5</li><li> </li><li/><li>1.6 </li>"),
        F.when(F.col("page_id") % 9 == 4, "<li>").otherwise(""),
        F.lit("</supportedVersions></ModMetaData>"),
    )
    path = F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit("/About/About.xml"))
    base = new_dir(spark, "mods")
    files = v.table(spark, folder, "pages").select(path.alias("path"), text.alias("text"))
    packs.write_files(files, base)
    return resources.read_mods(spark, base).select(
        "mod_dir",
        "mod_id",
        "name",
        F.array_join("supported_versions", "|").alias("versions"),
        F.substring_index("error", ":", 1).alias("error"),
    )


_TREE_PATH = """concat('/mods/m', page_id // 3, case page_id % 4 when 0 then '/1.6/Languages/English/Keyed/a.xml'
 when 1 then '/Languages/English/Keyed/b.xml' when 2 then '/Textures/c.png' else '/1.4/Languages/x/Keyed/d.xml' end)"""


@query(
    "resolve_content_root",
    f"""select mod_dir, r as content_root, case when r is null then 'no Languages folder' end as error from (
 select 'm' || (page_id // 3) as mod_dir, max(case when page_id % 4 = 0 then '1.6' when page_id % 4 = 1 then '' end) as r
 from pages group by 1)""",
)
def _(spark, folder):
    paths = v.table(spark, folder, "pages").select(
        F.expr("concat('m', page_id div 3)").alias("mod_dir"),
        F.expr(_TREE_PATH.replace("//", "div")).alias("path"),
    )
    return resources.resolve_content_root(paths)


def _tag(name: str, *parts):
    return F.concat(F.lit(f"<{name}>"), *parts, F.lit(f"</{name}>"))


def _defs_tree(spark, folder) -> str:
    """Every document as a Defs file with nested lists; every third mod ships English, too.

    One file in seventeen is malformed. Mods of odd numbers keep their Defs in the version folder,
    next to a file that it hides.
    """
    base = new_dir(spark, "mods")
    docs = v.documents(spark, folder, "source", "text").withColumn("n", F.col("doc_id").cast("string"))
    text, label = xml_escape("text"), F.concat(F.lit("part "), "n")
    stage = lambda k: _tag("li", _tag("label", label, F.lit(f" {k}")), _tag("minor", _tag("li", F.lit("x")), _tag("li", label)))
    kind = F.expr("case doc_id % 3 when 0 then 'ThingDef' when 1 then 'GeneDef' else 'Own.TraitDef' end")
    fields = F.concat(
        _tag("label", text), _tag("defName", F.lit(" Def"), "n"), F.lit("<description/><stats><x>1</x></stats>"),
        _tag("stages", stage(0), stage(1)), _tag("comps", F.lit("<li Class='C'/>"), _tag("li", _tag("text", label))),
    )
    body = F.concat(
        F.lit("<Defs><!-- c --><ThingDef Abstract='True'><defName>Base</defName><label>no</label></ThingDef><"),
        kind, F.lit(">"), fields, F.lit("</"), kind, F.lit("><ThingDef><label>nameless</label></ThingDef>"),
        F.when(F.col("doc_id") % 17 == 5, "<Open>").otherwise(""), F.lit("</Defs>"),
    )
    number = F.regexp_extract("source", r"([0-9]+)$", 1).cast("int")
    root = F.when(number % 2 == 1, "/1.6/Defs/sub/d").otherwise("/Defs/sub/d")
    packs.write_files(docs.select(F.concat("source", root, "n", F.lit(".xml")).alias("path"), body.alias("text")), base)
    hidden = docs.filter(number % 2 == 1).select("source").distinct().select(
        F.concat("source", F.lit("/Defs/hidden.xml")).alias("path"),
        F.lit("<Defs><ThingDef><defName>Hidden</defName><label>h</label></ThingDef></Defs>").alias("text"),
    )
    packs.write_files(hidden, base)
    mods = docs.select("source", number.alias("k")).distinct()
    about = _tag("ModMetaData", _tag("packageId", F.lit("id."), "source"), _tag("name", "source"))
    packs.write_files(mods.select(F.concat("source", F.lit("/About/About.xml")).alias("path"), about.alias("text")), base)
    english = mods.filter("k % 3 = 0")
    shipped = {
        "Keyed/K.xml": _tag("LanguageData", _tag("Greeting", "source"), F.lit("<Greeting>again</Greeting>")),
        "DefInjected/ThingDef/D.xml": _tag("LanguageData", _tag("Sword.label", "source")),
        "Strings/Names.txt": F.concat(F.lit("one\n"), "source", F.lit("\n")),
    }
    for path, content in shipped.items():
        text = content if path.endswith("xml") else F.concat(content, F.lit(""))
        files = english.select(F.concat("source", F.lit(f"/Languages/English/{path}")).alias("path"), text.alias("text"))
        packs.write_files(files, base)
    return base


_KIND = "case doc_id % 3 when 0 then 'ThingDef' when 1 then 'GeneDef' else 'Own.TraitDef' end"
_GOOD = "documents where doc_id % 17 <> 5"
_FIELDS = f"""select source, doc_id, {_KIND} as def_type, 'Def' || doc_id || '.' || f.k as key_path,
 case when f.k = 'label' then text else f.t end as value, f.k from (select *, unnest([
 {{'k': 'label', 't': ''}}, {{'k': 'stats.x', 't': '1'}},
 {{'k': 'stages.0.label', 't': 'part ' || doc_id || ' 0'}}, {{'k': 'stages.0.minor.0', 't': 'x'}},
 {{'k': 'stages.0.minor.1', 't': 'part ' || doc_id}}, {{'k': 'stages.1.label', 't': 'part ' || doc_id || ' 1'}},
 {{'k': 'stages.1.minor.0', 't': 'x'}}, {{'k': 'stages.1.minor.1', 't': 'part ' || doc_id}},
 {{'k': 'comps.1.text', 't': 'part ' || doc_id}}]) as f from {_GOOD}) where f.k <> 'label' or trim(text, chr(32) || chr(10) || chr(9) || chr(13)) <> ''"""
_KEPT = f"""(select * from ({_FIELDS}) where regexp_extract(source, '([0-9]+)$', 1)::int % 3 <> 0
 and (k in ('label', 'stages.0.label', 'stages.1.label') or (def_type = 'GeneDef' and k = 'comps.1.text')))"""


def _own_fields(spark):
    return spark.createDataFrame([("GeneDef", "comps.N.text")], "def_type string, field_pattern string")


@query(
    "read_defs",
    f"""select source as mod_dir, 'sub_d' || doc_id as file, def_type, key_path, md5(value) as value, false as bad from ({_FIELDS})
union all select source, 'sub_d' || doc_id, null, null, null, true from documents where doc_id % 17 = 5
union all select distinct source, 'hidden', 'ThingDef', 'Hidden.label', md5('h'), false from documents
 where regexp_extract(source, '([0-9]+)$', 1)::int % 2 = 1""",
)
def _(spark, folder):
    rows = resources.read_defs(spark, _defs_tree(spark, folder))
    bad = F.col("error").isNotNull().alias("bad")
    return rows.select("mod_dir", "file", "def_type", "key_path", F.md5("value").alias("value"), bad)


@query("infer_from_defs", f"select 'id.' || source as mod_id, def_type, key_path, md5(value) as source_text from {_KEPT}")
def _(spark, folder):
    found = resources.inferred_strings(spark, _defs_tree(spark, folder), field_table=_own_fields(spark))
    return found.select("mod_id", "def_type", "key_path", F.md5("source_text").alias("source_text"))


@query(
    "extract_all_domains",
    f"""with m as (select distinct 'id.' || source as mod_id, source from documents where regexp_extract(source, '([0-9]+)$', 1)::int % 3 = 0)
select mod_id, 'Keyed' as domain, null as def_type, 'Greeting' as key_path, md5('again') as source_text, null as file, -1 as idx from m
union all select mod_id, 'DefInjected', 'ThingDef', 'Sword.label', md5(source), 'D', -1 from m
union all select mod_id, 'Strings', null, 'Names.txt#0', md5('one'), 'Names', 0 from m
union all select mod_id, 'Strings', null, 'Names.txt#1', md5(source), 'Names', 1 from m
union all select 'id.' || source, 'DefInjected', def_type, key_path, md5(value), 'sub_d' || doc_id, -1 from {_KEPT}""",
)
def _(spark, folder):
    found = resources.merged_strings(spark, _defs_tree(spark, folder), field_table=_own_fields(spark))
    return found.withColumns({"source_text": F.md5("source_text"), "idx": F.coalesce("idx", F.lit(-1))})


@query(
    "merged_strings",
    """select source as mod_id, 'K' || (doc_id // 120) as key_path, arg_min(md5(text), (doc_id % 3, -doc_id)) as source_text
 from documents group by 1, 2""",
)
def _(spark, folder):
    base = new_dir(spark, "mods")
    entries = v.entries(spark, folder)
    # Files with repeated keys, as an author may write them.
    path = F.concat("mod_id", F.lit("/Languages/English/Keyed/"), "file")
    lines = entries.select(F.concat(F.lit("mods/"), path).alias("path"), "pos", packs.element(F.col("key"), F.col("value")).alias("line"))
    write_tree(lines, ["pos"], base, "mods", **packs.XML)
    about = entries.select("mod_id").distinct().select(
        F.concat("mod_id", F.lit("/About/About.xml")).alias("path"),
        _tag("ModMetaData", _tag("packageId", "mod_id"), _tag("name", F.lit("N"))).alias("text"),
    )
    packs.write_files(about, f"{base}/mods")
    return resources.merged_strings(spark, f"{base}/mods").select(
        "mod_id", "key_path", F.md5("source_text").alias("source_text")
    )


# ---- packs -----------------------------------------------------------------------------------------


def _entry(key: str = "key_path") -> str:
    esc = "replace(replace(replace(translated_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    comment = "' EN: ' || rtrim(replace(source_text, '--', '––'), '-') || ' '"
    return f"'  <!--' || {comment} || '-->' || chr(10) || '  <' || {key} || '>' || {esc} || '</' || {key} || '>'"


_HEAD = "'<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10)"


def _pack_text() -> str:
    return (
        f"md5({_HEAD} || '<LanguageData>' || chr(10) || string_agg({_entry()}, chr(10) order by key_path) filter (passed)"
        " || chr(10) || '</LanguageData>' || chr(10))"
    )


_EMPTY = f"md5({_HEAD} || '<LanguageData />' || chr(10))"


def _published(spark, folder, write, **columns):
    """Write a pack over an older, larger one, and read the published tree back."""
    out = new_dir(spark, "pack")
    checked = gates.validate(v.candidates(spark, folder)).withColumns(columns)
    earlier = checked.withColumns({"mod_id": F.concat(F.lit("gone."), "mod_id"), "validation_status": F.lit("passed")})
    write(earlier, out)
    entries = write(checked, out).select(F.col("path").alias("_path"), _bigint("entries"))
    tree = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out)
    path = F.regexp_extract("path", r"(Languages/.*)$", 1)
    files = tree.select(path.alias("path"), F.md5("content").alias("text"))
    return files.join(entries, F.col("path") == F.col("_path"), "full").select("path", "entries", "text")


def _xml_pack_sql(domain: str, group: str, path: str) -> str:
    where = f"from v_v where domain = '{domain}'"
    return f"""select {path} as path, count(*) filter (passed) as entries, case when count(*) filter (passed) = 0 then {_EMPTY}
 else {_pack_text()} end as text {where} group by {group}"""


@query("write_keyed_pack", _xml_pack_sql("Keyed", "mod_id", "'Languages/Russian/Keyed/' || mod_id || '.xml'"))
def _(spark, folder):
    return _published(spark, folder, packs.write_keyed_pack)


@query(
    "write_definjected_pack",
    _xml_pack_sql(
        "DefInjected",
        "mod_id, def_type, file",
        "'Languages/Russian/DefInjected/' || def_type || '/' || mod_id || '__' || file || '.xml'",
    ),
)
def _(spark, folder):
    return _published(spark, folder, packs.write_definjected_pack)


@query(
    "write_strings_pack",
    """select 'Languages/Russian/Strings/' || mod_id || '__' || file || '.txt' as path, count(*) as entries,
 md5(string_agg(replace(translated_text, chr(10), '\\n'), chr(10) order by doc_id) || chr(10)) as text
from v_v where domain = 'Strings' and passed group by mod_id, file""",
)
def _(spark, folder):
    return _published(spark, folder, packs.write_strings_pack, idx=F.col("doc_id"))


@query(
    "join_mod_names",
    """select mod_id, case when mod_id = (select min(mod_id) from v_mods) then '' else ', ' end || name as piece
from v_mods""",
)
def _(spark, folder):
    return packs.join_mod_names(v.mods(spark, folder))


def _esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_NL = "chr(10)"


@query(
    "render_manifest",
    f"""with e as (select mod_id, name, mod_id = min(mod_id) over () as a, mod_id = max(mod_id) over () as z from v_mods)
select 0 as section, '' as mod_id, {_HEAD} || '<ModMetaData>' || {_NL} || '  <name>Translation Pack [RU]</name>' || {_NL}
 || '  <author>parlance</author>' || {_NL} || '  <packageId>parlance.translationpack.ru</packageId>' || {_NL}
 || '  <description>Russian translation for: ' as text
union all select 1, mod_id, case when a then '' else ', ' end || {_esc('name')} from e
union all select 2, '', '.</description>' || {_NL} || '  <supportedVersions>' || {_NL} || '    <li>1.6</li>' || {_NL}
 || '  </supportedVersions>' || {_NL}
union all select 3, mod_id, case when a then '  <modDependencies>' || {_NL} else '' end || '    <li>' || {_NL}
 || '      <packageId>' || mod_id || '</packageId>' || {_NL} || '      <displayName>' || {_esc('name')} || '</displayName>'
 || {_NL} || '    </li>' || {_NL} || case when z then '  </modDependencies>' || {_NL} else '' end from e
union all select 4, mod_id, case when a then '  <loadAfter>' || {_NL} else '' end || '    <li>' || mod_id || '</li>' || {_NL}
 || case when z then '  </loadAfter>' || {_NL} else '' end from e
union all select 5, '', '</ModMetaData>' || {_NL}""".replace("with e as (", "select * from (with e as (", 1)
    + ")",
)
def _(spark, folder):
    return packs.render_manifest(v.mods(spark, folder))


# ---- stored tables -----------------------------------------------------------------------------------


@query(
    "read_tm",
    "select id, mod_id, domain, def_type, key_path, target_lang, value_hash, updated_at::varchar as updated_at"
    " from (select *, 'ru' as target_lang from v_tm)",
)
def _(spark, folder):
    path = new_dir(spark, "memory")
    datasets.write_tm(v.memory(spark, folder), path, version=1)
    return datasets.read_tm(spark, path).select(
        "id",
        *KEY,
        "target_lang",
        "value_hash",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


@query(
    "write_state",
    f"""select {schemas.STATE_SCHEMA_VERSION} as schema_version, mod_id, domain, key_path, def_type, semantic_type, md5(source_text) as source,
 md5(translated_text) as translated, provider_id, validation_status, 'unreviewed' as review_status from v_v""",
)
def _(spark, folder):
    path = new_dir(spark, "state")
    datasets.write_state(gates.validate(v.candidates(spark, folder)), path)
    return datasets.read_state(spark, path).select(
        "schema_version",
        "mod_id",
        "domain",
        "key_path",
        "def_type",
        "semantic_type",
        F.md5("source_text").alias("source"),
        F.md5("translated_text").alias("translated"),
        "provider_id",
        "validation_status",
        "review_status",
    )


@query("read_glossary", "select scope, scope_value, md5(term) as term, preferred from v_gm")
def _(spark, folder):
    path = new_dir(spark, "glossary")
    datasets.write_glossary(v.glossary_from_memory(spark, folder), path)
    return datasets.read_glossary(spark, [path]).select(
        "scope", "scope_value", F.md5("term").alias("term"), "preferred"
    )


def _issues(spark, folder):
    return v.runs(spark, folder).select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(F.col("failed"), "WARNING").otherwise("INFO").alias("level"),
        F.lit("parlance.provider").alias("logger"),
        F.concat(F.lit("run "), F.col("event_id").cast("string")).alias("message"),
        F.when(F.col("failed"), F.col("key")).alias("key"),
        "provider",
    )


@query(
    "write_issues",
    """select '{"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","level":"' || case when failed then 'WARNING'
 else 'INFO' end || '","logger":"parlance.provider","message":"run ' || event_id || '"' || case when failed then
 ',"key":"' || key || '"' else '' end || ',"provider":"' || provider || '"}' as value from v_r""",
)
def _(spark, folder):
    return datasets.issue_lines(_issues(spark, folder))


@query(
    "read_issues",
    """select strftime(ts, '%Y-%m-%dT%H:%M:%S') as timestamp, case when failed then 'WARNING' else 'INFO' end as level,
 'run ' || event_id as message, case when failed then key end as key, provider from v_r""",
)
def _(spark, folder):
    path = new_dir(spark, "issues")
    datasets.write_issues(_issues(spark, folder), path)
    return datasets.read_issues(spark, path).select("timestamp", "level", "message", "key", "provider")


