"""Translator and scorer slots: the only places where user Python runs over strings."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions.text import as_col, words
from parlance.operators.skew import split_groups
from parlance.schemas import KEY, PROVIDER_KINDS


@dataclass(frozen=True)
class Provider:
    """A translator: either a column expression or a callable over one batch.

    The callable gets (texts, semantic type, context hint, glossary rules) and returns as many
    texts, in the same order.
    """

    id: str
    kind: str
    prompt_version: str
    max_batch_size: int = 256
    structured_output: bool = False
    expression: Callable[[Column], Column] | None = None
    translate: Callable[[Sequence[str], str | None, str | None, dict], Sequence[str]] | None = None
    # Errors that fail a batch; any other stops the job, as a mistake in the code should.
    recoverable: tuple[type[BaseException], ...] = (OSError, TimeoutError, ValueError)

    def __post_init__(self):
        if self.kind not in PROVIDER_KINDS:
            raise ValueError(f"unknown provider kind: {self.kind}")
        if self.max_batch_size < 1:
            raise ValueError("max_batch_size must be positive")
        if (self.expression is None) == (self.translate is None):
            raise ValueError("exactly one of expression / translate must be set")


# The pass-through translator's prefix, id, prompt version and batch size.
PASSTHROUGH = Provider(
    id="skeleton:passthrough",
    kind="local",
    prompt_version="passthrough-v1",
    max_batch_size=256,
    expression=lambda text: F.concat(F.lit("[RU] "), text),
)

ECHO = Provider(
    id="test:echo", kind="local", prompt_version="v1", expression=lambda text: text
)


def passthrough_provider(strings: DataFrame) -> DataFrame:
    return translate_with(strings, PASSTHROUGH)


def echo_provider(strings: DataFrame) -> DataFrame:
    return translate_with(strings, ECHO)


def translate_with(strings: DataFrame, provider: Provider, rules: dict | None = None) -> DataFrame:
    """One candidate per string. A failing batch becomes rows with ``error``, not a failed job.

    Batches are cut inside each task from the Arrow stream, per semantic type and context hint and
    at most ``max_batch_size`` long, so batching needs no exchange and no task depends on a group's
    size. A batch gets ``rules`` and, from an input column ``glossary_rules`` (map of term to
    preferred text), those of its own strings. Only the provider's ``recoverable`` errors are rows.
    """
    stamped = {
        "provider_id": F.lit(provider.id),
        "prompt_version": F.lit(provider.prompt_version),
        "validation_status": F.lit("pending"),
        "review_status": F.lit("unreviewed"),
    }
    if provider.expression is not None:
        return strings.withColumns(
            {
                "translated_text": provider.expression(F.col("source_text")),
                "error": F.lit(None).cast("string"),
                **stamped,
            }
        )

    call, limit, glossary = provider.translate, provider.max_batch_size, rules or {}
    recoverable = provider.recoverable
    has_hint, has_rules = "context_hint" in strings.columns, "glossary_rules" in strings.columns
    by = ["semantic_type", "context_hint"] if has_hint else ["semantic_type"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for key, group in frame.groupby(by, dropna=False, sort=False):
                kind, *hints = (None if pd.isna(k) else k for k in key)
                hint = hints[0] if hints else None
                for start in range(0, len(group), limit):
                    batch = group.iloc[start : start + limit].copy()
                    own = dict(glossary)
                    for found in batch["glossary_rules"].dropna() if has_rules else ():
                        own |= dict(found)
                    batch["translated_text"], batch["error"] = None, None
                    try:
                        texts = list(call(batch["source_text"].tolist(), kind, hint, own))
                        if len(texts) != len(batch):
                            raise ValueError(f"{len(texts)} results for {len(batch)} strings")
                        batch["translated_text"] = texts
                    except recoverable as exc:
                        batch["error"] = f"{type(exc).__name__}: {exc}"
                    yield batch

    schema = T.StructType(
        strings.schema.fields
        + [T.StructField("translated_text", T.StringType()), T.StructField("error", T.StringType())]
    )
    return strings.mapInPandas(run, schema).withColumns(stamped)


def contract_violations(strings: DataFrame, results: DataFrame) -> DataFrame:
    """Keys without exactly one result, and results without a key."""
    sides = strings.select(*KEY, F.lit(1).alias("asked"), F.lit(0).alias("given")).unionAll(
        results.select(*KEY, F.lit(0), F.lit(1))
    )
    return (
        sides.groupBy(*KEY)
        .agg(F.sum("asked").alias("asked"), F.sum("given").alias("given"))
        .filter("asked <> given")
    )


def assign_batches(
    strings: DataFrame, providers: DataFrame, rows_per_task: int = 200_000
) -> DataFrame:
    """Number batches of at most max_batch_size per provider and semantic type.

    Groups are first split into bounded parts by a stable hash of the key, then numbered inside a
    part; a batch is (provider, semantic type, part, batch).
    """
    sized = strings.join(
        providers.select(F.col("id").alias("provider_id"), "max_batch_size"), "provider_id"
    )
    group = ["provider_id", "semantic_type"]
    parted = split_groups(sized, group, list(KEY), rows_per_task)
    w = Window.partitionBy(*group, "part").orderBy(*KEY)
    number = F.row_number().over(w) - 1
    return parted.withColumn("batch", F.floor(number / F.col("max_batch_size")))


def attach_provider(runs: DataFrame, providers: DataFrame) -> DataFrame:
    """Kind, model and retry policy by provider id; unknown ids stay, with nulls."""
    p = providers.select(
        F.col("id").alias("provider"),
        "kind",
        "model",
        "max_retries",
        "timeout_seconds",
        "max_batch_size",
    )
    return runs.join(p, "provider", "left")


def provider_disagreement(
    candidates: DataFrame, first: str, second: str, identity: list[str]
) -> DataFrame:
    """Keys on which two passes differ, with the share of words they have in common.

    Both passes of a key are folded into one row by a single combining aggregate; no self-join.
    """

    def text(provider: str) -> Column:
        return F.max(F.when(F.col("provider_id") == provider, F.col("translated_text")))

    both = (
        candidates.filter(F.col("provider_id").isin(first, second))
        .groupBy(*identity)
        .agg(text(first).alias("a"), text(second).alias("b"))
        .filter("a <> b")
    )
    a, b = F.array_distinct(words("a")), F.array_distinct(words("b"))
    tokens = both.select(*identity, a.alias("wa"), b.alias("wb"))
    common = F.size(F.array_intersect("wa", "wb"))
    return tokens.select(
        *identity,
        F.lit(first).alias("first_provider"),
        F.lit(second).alias("second_provider"),
        F.round(
            common / F.greatest(F.size("wa") + F.size("wb") - common, F.lit(1)), 6
        ).alias("similarity"),
    )


def score_with(pairs: DataFrame, scorer: Callable[[pd.Series, pd.Series], pd.Series]) -> DataFrame:
    """Add ``score`` from a user-supplied vectorised scorer (source, translation)."""
    udf = F.pandas_udf(scorer, returnType=T.DoubleType())
    return pairs.withColumn("score", udf(as_col("source_text"), as_col("translated_text")))

