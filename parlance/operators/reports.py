"""Counts, coverage, cost and provider figures. Every aggregate combines before its exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import each, value_hash
from parlance.functions.tokens import tokens_of
from parlance.operators.skew import key_join, segment_rows
from parlance.schemas import KEY
from parlance.sources.workdir import stored


def run_summary(candidates: DataFrame) -> DataFrame:
    return candidates.groupBy("mod_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("validation_status") == "passed").alias("passed"),
    )


def with_coverage(strings: DataFrame, tm: DataFrame) -> DataFrame:
    """Add ``covered``: the memory holds a current row for the string."""
    m = tm.groupBy(*KEY, "value_hash").agg(F.lit(True).alias("known"))
    s = strings.select(*KEY, "semantic_type", value_hash("source_text").alias("value_hash"))
    return key_join(s, m, (*KEY, "value_hash"), "left").select(
        *KEY, "semantic_type", F.coalesce("known", F.lit(False)).alias("covered")
    )


def _coverage_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("strings"),
        F.count_if("covered").alias("covered"),
    ]


def coverage_report(strings: DataFrame, tm: DataFrame) -> DataFrame:
    """Strings and covered strings per domain and mod, with subtotals."""
    return (
        with_coverage(strings, tm)
        .groupBy("domain", "mod_id")
        .agg(*_coverage_counts())
        .rollup("domain", "mod_id")
        .agg(
            F.grouping_id().alias("level"),
            F.sum("strings").alias("strings"),
            F.sum("covered").alias("covered"),
        )
    )


def coverage_cube(strings: DataFrame) -> DataFrame:
    """All combinations of the three breakdowns, from one pre-aggregated pass."""
    base = strings.groupBy("domain", "mod_id", "semantic_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    return base.cube("domain", "mod_id", "semantic_type").agg(
        F.grouping_id().alias("level"), F.sum("n").alias("strings")
    )


def coverage_grouping_sets(strings: DataFrame) -> DataFrame:
    """Exactly the three single breakdowns in one pass."""
    d, m, s = F.col("domain"), F.col("mod_id"), F.col("semantic_type")
    base = strings.groupBy("domain", "mod_id", "semantic_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    return base.groupingSets([[d], [m], [s]], d, m, s).agg(
        F.grouping_id().alias("level"), F.sum("n").alias("strings")
    )


def dry_run_report(routed: DataFrame) -> DataFrame:
    return routed.groupBy("tier", "reason").agg(
        F.count(F.lit(1)).alias("strings"), F.sum("tokens").alias("tokens")
    )


def estimate_cost(
    routed: DataFrame, prices: list[tuple[str, float, float]], output_ratio: float = 1.0
) -> DataFrame:
    """Tokens and money of the remote part for each (name, price in, price out) per 1M tokens.

    The price list is configuration; it meets the data only after aggregation.
    """
    by_type = (
        routed.filter("tier = 'remote'")
        .groupBy("semantic_type")
        .agg(F.count(F.lit(1)).alias("strings"), F.sum("tokens").alias("tokens_in"))
    )
    offers = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"), F.lit(p_in).alias("p_in"), F.lit(p_out).alias("p_out")
            )
            for name, p_in, p_out in prices
        ]
    )
    out = F.ceil(F.col("tokens_in") * output_ratio).cast("bigint")
    return by_type.select("*", out.alias("tokens_out"), F.explode(offers).alias("o")).select(
        "semantic_type",
        F.col("o.model").alias("model"),
        "strings",
        "tokens_in",
        "tokens_out",
        F.round(
            (F.col("tokens_in") * F.col("o.p_in") + F.col("tokens_out") * F.col("o.p_out"))
            / 1_000_000,
            6,
        ).alias("cost"),
    )


def token_counts(df: DataFrame, mechanism: str, identity: list[str], text: str) -> DataFrame:
    return (
        df.select(*identity, each(tokens_of(mechanism, text)).alias("token"))
        .filter("token is not null")
        .groupBy(*identity, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def gate_failure_report(validated: DataFrame) -> DataFrame:
    """Failure messages per gate, mod and provider."""
    return (
        validated.select("mod_id", "provider_id", each(F.col("failures")).alias("message"))
        .filter("message is not null")
        .groupBy("mod_id", "provider_id", F.substring_index("message", " ", 1).alias("gate"))
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def exact_quantiles(df: DataFrame, by: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of ``value`` per group, exact, one column for each name of ``wanted``.

    Equal values are counted before any exchange, then dealt by ranges of (group, value). A row's rank
    is its running count inside its range plus the counts of the group's earlier ranges, and the rows
    that hold a wanted rank are picked out. So no state grows with a group: a task sorts its own range
    (and spills), whatever number of different values a group has. Nulls and NaN are left out.
    """
    values = df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    counted = values.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    dealt = stored(counted.repartitionByRange(*by, "_v").withColumn("_range", F.spark_partition_id()), "quantiles")
    ranked = segment_rows(dealt, by, ["_v"], F.col("_range"), {"_upto": F.col("_n")})
    totals = dealt.groupBy(*by).agg(F.sum("_n").alias("_total"))
    placed = key_join(ranked, totals, by, "inner")
    picks, out = [], []
    for name, p in wanted.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(holds, F.col("_v"))).alias(f"_{name}_{end}"))
        picks.append(F.max(at - F.floor(at)).alias(f"_{name}_part"))
        lo, hi, part = (F.col(f"_{name}_{x}") for x in ("lo", "hi", "part"))
        out.append((lo + (hi - lo) * part).alias(name))
    return placed.groupBy(*by).agg(*picks).select(*by, *out)


def provider_stats(
    runs: DataFrame, by: tuple[str, ...] = ("provider",), prices: dict[str, float] | None = None
) -> DataFrame:
    """Latency mean and quantiles, throughput, failure rate and cost per provider.

    ``prices`` gives what a provider takes per million tokens; without a price the cost is null.
    """
    quantiles = exact_quantiles(runs, list(by), "latency", {"p50_latency": 0.5, "p95_latency": 0.95})
    seconds = F.greatest((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6, F.lit(1.0))
    figures = runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.avg("latency"), 4).alias("mean_latency"),
        F.round(F.count(F.lit(1)) / seconds, 9).alias("runs_per_second"),
        F.round(F.count_if("failed") / F.count(F.lit(1)), 6).alias("failure_rate"),
        F.sum("tokens").alias("tokens"),
    )
    price = F.lit(None).cast("double")
    for provider, each_million in (prices or {}).items():
        price = F.when(F.col("provider") == provider, F.lit(float(each_million))).otherwise(price)
    cost = F.round(F.col("tokens") * price / 1_000_000, 6).alias("cost")
    return key_join(figures, quantiles, list(by), "left").select(
        *by, "runs", "mean_latency", "p50_latency", "p95_latency", "runs_per_second", "failure_rate", "tokens", cost
    )


def placeholder_pass_rate(validated: DataFrame) -> DataFrame:
    """Share of candidates per provider that pass the hard gate."""
    return validated.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.round(F.count_if("passed") / F.count(F.lit(1)), 6).alias("pass_rate"),
    )


def provider_comparison(stats: DataFrame, pass_rates: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per provider with all figures; nothing is ranked and no winner is named."""
    return stats.join(pass_rates, "provider", "full").join(scores, "provider", "full")


def rank_providers(stats: DataFrame, metric: str, within: str, ascending: bool = True) -> DataFrame:
    """Rank and dense rank of already aggregated figures inside each semantic type."""
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    w = Window.partitionBy(within).orderBy(order)
    return stats.withColumns({"rank": F.rank().over(w), "dense_rank": F.dense_rank().over(w)})
