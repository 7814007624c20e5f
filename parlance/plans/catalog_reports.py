"""Queries for aggregates, windows, top-k, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.functions.text import each
from parlance.operators import gates, reports, routing, scoring
from parlance.plans import oracle_views as o
from parlance.plans import views as v
from parlance.plans.catalog_joins import POLICY
from parlance.plans.registry import query


def _routed(spark, folder):
    return routing.route(
        v.typed_strings(spark, folder),
        v.memory(spark, folder),
        v.glossary_from_memory(spark, folder),
        POLICY,
    )


@query(
    "run_summary",
    "select mod_id, count(*) as total, count_if(passed)::bigint as passed from v_v group by mod_id",
)
def _(spark, folder):
    return reports.run_summary(gates.validate(v.candidates(spark, folder)))


_COVERED = """(select s.*, exists (select 1 from v_tm m where s.mod_id = m.mod_id and s.domain = m.domain
 and s.def_type is not distinct from m.def_type and s.key_path = m.key_path
 and sha256(s.source_text) = m.value_hash) as covered from v_t s)"""


@query(
    "coverage_report",
    f"""select domain, mod_id, grouping_id(domain, mod_id)::bigint as level, count(*) as strings,
 count_if(covered)::bigint as covered from {_COVERED} group by rollup (domain, mod_id)""",
)
def _(spark, folder):
    return reports.coverage_report(v.typed_strings(spark, folder), v.memory(spark, folder))


@query(
    "coverage_cube",
    """select domain, mod_id, semantic_type, grouping_id(domain, mod_id, semantic_type)::bigint as level,
 count(*) as strings from v_t group by cube (domain, mod_id, semantic_type)""",
)
def _(spark, folder):
    return reports.coverage_cube(v.typed_strings(spark, folder))


@query(
    "coverage_grouping_sets",
    """select domain, mod_id, semantic_type, grouping_id(domain, mod_id, semantic_type)::bigint as level,
 count(*) as strings from v_t group by grouping sets ((domain), (mod_id), (semantic_type))""",
)
def _(spark, folder):
    return reports.coverage_grouping_sets(v.typed_strings(spark, folder))


@query(
    "dry_run_report",
    "select tier, reason, count(*) as strings, sum(tokens)::bigint as tokens from v_route group by all",
)
def _(spark, folder):
    return reports.dry_run_report(_routed(spark, folder))


# Published price classes, money per 1M tokens in and out.
PRICES = [
    ("class-1", 2.0, 10.0),
    ("class-2", 5.0, 25.0),
    ("class-3", 1.0, 5.0),
    ("class-4", 2.0, 10.0),
    ("class-5", 0.75, 3.75),
]


@query(
    "estimate_cost",
    """select semantic_type, model, strings, tokens_in, tokens_out,
 round((tokens_in * p_in + tokens_out * p_out) / 1000000, 6) as cost from (
 select semantic_type, count(*) as strings, sum(tokens)::bigint as tokens_in,
 ceil(sum(tokens) * 1.25)::bigint as tokens_out from v_route where tier = 'remote' group by 1),
 (values ('class-1', 2.0::double, 10.0::double), ('class-2', 5.0, 25.0), ('class-3', 1.0, 5.0),
 ('class-4', 2.0, 10.0), ('class-5', 0.75, 3.75)) p(model, p_in, p_out)""",
)
def _(spark, folder):
    return reports.estimate_cost(_routed(spark, folder), PRICES, output_ratio=1.25)


@query(
    "gate_failure_report",
    """select mod_id, provider_id, string_split(m, ' ')[1] as gate, count(*) as failures from (
 select mod_id, provider_id, unnest(failures) as m from v_v) group by all""",
)
def _(spark, folder):
    return reports.gate_failure_report(gates.validate(v.candidates(spark, folder)))


_STATS = """select {by}, count(*) as runs, round(avg(latency), 4) as mean_latency,
 quantile_cont(latency, 0.5) as p50_latency, quantile_cont(latency, 0.95) as p95_latency,
 round(count(*) / greatest((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 1.0), 9) as runs_per_second,
 round(count_if(failed) / count(*), 6) as failure_rate, sum(tokens)::bigint as tokens,
 round(sum(tokens) * case provider when 'view' then 2.0 when 'click' then 5.0 when 'purchase' then 0.75 end / 1000000, 6)::double as cost
 from v_r group by {by}"""
TOKEN_PRICES = {"view": 2.0, "click": 5.0, "purchase": 0.75}


@query("provider_stats", _STATS.replace("{by}", "provider"))
def _(spark, folder):
    return reports.provider_stats(v.runs(spark, folder), prices=TOKEN_PRICES)


@query(
    "placeholder_pass_rate",
    "select provider_id, count(*) as candidates, round(count_if(passed) / count(*), 6) as pass_rate"
    " from v_v2 group by provider_id",
)
def _(spark, folder):
    return reports.placeholder_pass_rate(gates.validate(v.two_passes(spark, folder)))


@query(
    "rank_providers",
    f"""select provider, semantic_type, failure_rate, rank() over w as rank, dense_rank() over w as dense_rank
from ({_STATS.replace('{by}', 'provider, semantic_type').replace('from v_r', "from (select *, 'hour' || (extract(hour from ts) % 4) as semantic_type from v_r)")})
window w as (partition by semantic_type order by failure_rate)""",
)
def _(spark, folder):
    hour = F.concat(F.lit("hour"), (F.hour("ts") % 4).cast("string"))
    runs = v.runs(spark, folder).withColumn("semantic_type", hour)
    stats = reports.provider_stats(runs, ("provider", "semantic_type"))
    return reports.rank_providers(stats, "failure_rate", "semantic_type").select(
        "provider",
        "semantic_type",
        "failure_rate",
        F.col("rank").cast("bigint").alias("rank"),
        F.col("dense_rank").cast("bigint").alias("dense_rank"),
    )


# ---- scoring -----------------------------------------------------------------------------------

# n-gram counts of both sides by unnesting; characters without whitespace, then words.
_CHARS = r"regexp_replace({x}, '[ \t\n\x0B\f\r]+', '', 'g')"
_WORDS = r"list_filter(regexp_split_to_array({x}, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')"


def _items(kind: str, longest: int) -> str:
    """Items of both sides by position, each with the ones that follow it (n0, n1, ...)."""
    split = f"string_split({_CHARS}, '')" if kind == "c" else _WORDS
    sides = " union all ".join(
        f"select doc_id, {h} as h, generate_subscripts(t, 1) as i, unnest(t) as n0 from"
        f" (select doc_id, {split.replace('{x}', column)} as t from v_pairs)"
        for h, column in ((0, "reference"), (1, "hypothesis"))
    )
    next_items = "".join(f", lead(n0, {k}) over w as n{k}" for k in range(1, longest))
    return (
        f"select doc_id, h, n0{next_items} from ({sides}) where n0 <> ''"
        " window w as (partition by doc_id, h order by i)"
    )


def _stats(orders: dict[str, int]) -> str:
    """Matches and totals per document and order: characters 1.., words 11.. ."""
    views, rows = [], []
    for kind, longest in orders.items():
        views.append(f"items_{kind} as materialized ({_items(kind, longest)})")
        for n in range(1, longest + 1):
            gram = ", ".join(f"n{k}" for k in range(n))
            rows.append(
                f"select doc_id, {n + (10 if kind == 'w' else 0)} as o, hash({gram}) as g,"
                f" (1 - h)::int as r, h::int as h from items_{kind} where n{n - 1} is not null"
            )
    return (
        f"(with {', '.join(views)} select doc_id, o, sum(least(r, h)) as m, sum(r) as r, sum(h) as h"
        f" from (select doc_id, o, g, sum(r) as r, sum(h) as h from ({' union all '.join(rows)})"
        " group by all) group by doc_id, o)"
    )


_CHRF_ORDERS = {"c": 6, "w": 2}
_F = (
    "coalesce(round(100 * 5 * avg(m / h) * avg(m / r) / nullif(4 * avg(m / h) + avg(m / r), 0), 6), 0)"
)


@query(
    "chrf_scores",
    f"""select p.doc_id, coalesce(chrf, 0) as chrf from documents p left join (
 select doc_id, {_F} as chrf from {_stats(_CHRF_ORDERS)} where r > 0 and h > 0 group by doc_id) s
 on p.doc_id = s.doc_id""",
)
def _(spark, folder):
    return scoring.chrf_scores(v.pairs(spark, folder)).select("doc_id", "chrf")


@query(
    "chrf_corpus",
    f"""select lang, max(pairs) as pairs, {_F} as chrf from (
 select lang, o, sum(m) as m, sum(r) as r, sum(h) as h from {_stats(_CHRF_ORDERS)} join (
 select doc_id, lang from documents) using (doc_id) group by lang, o) join (
 select lang, count(*) as pairs from documents group by lang) using (lang) where r > 0 and h > 0 group by lang""",
)
def _(spark, folder):
    return scoring.chrf_corpus(v.pairs(spark, folder), ["lang"])


@query(
    "bleu_corpus",
    f"""select lang, pairs, round(100 * exp(least(0, 1 - r1 / h1) + lg / 4), 6) as bleu from (
 select lang, sum(ln(m / h)) as lg, max(case when o = 11 then r end) as r1,
 max(case when o = 11 then h end) as h1 from (
 select lang, o, sum(m) as m, sum(r) as r, sum(h) as h from {_stats({'w': 4})}
 join (select doc_id, lang from documents) using (doc_id) group by lang, o) group by lang) join (
 select lang, count(*) as pairs from documents group by lang) using (lang)""",
)
def _(spark, folder):
    return scoring.bleu_corpus(v.pairs(spark, folder), ["lang"])


_OWNER = "case source when 'src0' then 'view' when 'src1' then 'click' else 'other' end"


def _compare_sql() -> str:
    return f"""select provider, coalesce(runs, 0) as runs, coalesce(p95_latency, -1) as p95_latency, coalesce(cost, -1) as cost,
 coalesce(candidates, 0) as candidates, coalesce(pass_rate, -1) as pass_rate, coalesce(chrf, -1) as chrf
from (select coalesce(s.provider, p.provider) as provider, runs, p95_latency, cost, candidates, pass_rate
 from ({_STATS.replace('{by}', 'provider')}) s full join (
 select case provider_id when 'p0' then 'view' else 'signup' end as provider, count(*) as candidates,
 round(count_if(passed) / count(*), 6) as pass_rate from v_v2 group by 1) p on s.provider = p.provider) a
full join (select provider, {_F} as chrf from (
 select provider, o, sum(m) as m, sum(r) as r, sum(h) as h from {_stats(_CHRF_ORDERS)} join (
 select doc_id, {_OWNER} as provider from documents) using (doc_id) group by provider, o) where r > 0 and h > 0 group by provider) b
 using (provider)"""


@query("provider_comparison", _compare_sql())
def _(spark, folder):
    stats = reports.provider_stats(v.runs(spark, folder), prices=TOKEN_PRICES).select(
        "provider", "runs", "p95_latency", "cost"
    )
    named = F.when(F.col("provider_id") == "p0", "view").otherwise("signup")
    rates = reports.placeholder_pass_rate(gates.validate(v.two_passes(spark, folder))).select(
        named.alias("provider"), "candidates", "pass_rate"
    )
    pairs = v.pairs(spark, folder).withColumn("provider", F.expr(_OWNER))
    scores = scoring.chrf_corpus(pairs, ["provider"]).select("provider", "chrf")
    zero, none = F.lit(0), F.lit(-1.0)
    return reports.provider_comparison(stats, rates, scores).select(
        "provider",
        F.coalesce("runs", zero).alias("runs"),
        F.coalesce("p95_latency", none).alias("p95_latency"),
        F.coalesce("cost", none).alias("cost"),
        F.coalesce("candidates", zero).alias("candidates"),
        F.coalesce("pass_rate", none).alias("pass_rate"),
        F.coalesce("chrf", none).alias("chrf"),
    )


WEIGHTS = {"critical": 25.0, "major": 5.0, "minor": 1.0}


@query(
    "mqm_scores",
    """select provider_id, segments, coalesce(errors, 0) as errors, round(coalesce(penalty, 0) / segments, 6) as mqm
from (select provider_id, count(*) as segments from v_v2 group by 1) left join (
 select provider_id, count(*) as errors, sum(case when g in ('positional', 'named') then 25.0
 when g = 'rulepack' then 5.0 else 1.0 end)::double as penalty from (
 select provider_id, string_split(unnest(failures), ' ')[1] as g from v_v2) group by 1) using (provider_id)""",
)
def _(spark, folder):
    checked = gates.validate(v.two_passes(spark, folder))
    gate = F.substring_index("message", " ", 1)
    severity = (
        F.when(gate.isin("positional", "named"), "critical")
        .when(gate == "rulepack", "major")
        .otherwise("minor")
    )
    notes = checked.select("provider_id", each(F.col("failures")).alias("message"))
    notes = notes.filter("message is not null").select(
        "provider_id", severity.alias("severity")
    )
    segments = checked.groupBy("provider_id").agg(F.count(F.lit(1)).alias("segments"))
    return scoring.mqm_scores(notes, segments, WEIGHTS)


_SCORED = "(select *, round(length(source_text) / length(translated_text), 6) as score from v_c2)"


def _scored(spark, folder):
    ratio = F.length("source_text") / F.length("translated_text")
    return v.two_passes(spark, folder).withColumn("score", F.round(ratio, 6))


@query(
    "hard_cases",
    f"""select provider_id, doc_id, score, rank from (select *, row_number() over (
 partition by provider_id order by score, doc_id) as rank from {_SCORED}) where rank <= 25""",
)
def _(spark, folder):
    return scoring.hard_cases(_scored(spark, folder), 25, ["doc_id"]).select(
        "provider_id", "doc_id", "score", F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "review_sample",
    f"""select provider_id, semantic_type, doc_id from {_SCORED} qualify row_number() over (
 partition by provider_id, semantic_type order by md5(concat_ws(chr(1), coalesce(provider_id, ''), coalesce(semantic_type, ''),
 doc_id::varchar)), doc_id) <= 15""",
)
def _(spark, folder):
    return scoring.review_sample(
        _scored(spark, folder), 15, ["doc_id"], ["provider_id", "semantic_type"]
    ).select("provider_id", "semantic_type", "doc_id")
