"""Filters, splits and constraint checks. Every check returns its violations as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import strip
from parlance.schemas import (
    ACCEPTED_REVIEWS,
    DOMAINS,
    PROVIDER_KINDS,
    REVIEW_STATUSES,
    STATE_COLUMNS,
    VALIDATION_STATUSES,
)

MEMBERSHIP = {
    "domain": DOMAINS,
    "kind": PROVIDER_KINDS,
    "validation_status": VALIDATION_STATUSES,
    "review_status": REVIEW_STATUSES,
}


class RunAborted(RuntimeError):
    """A run-level failure: the rows that cause it make going on useless."""


def filter_emittable(candidates: DataFrame, require_review: bool = False) -> DataFrame:
    """Only passed rows are ever written; on request only reviewed ones."""
    keep = F.col("validation_status") == "passed"
    if require_review:
        keep = keep & F.col("review_status").isin(*ACCEPTED_REVIEWS)
    return candidates.filter(keep)


def quarantine(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and the failing rows with it."""
    return df.filter(F.col(error_col).isNull()).drop(error_col), df.filter(
        F.col(error_col).isNotNull()
    )


def fail_if_any(df: DataFrame, predicate: Column, message: str) -> None:
    """Abort when a row matches; at most one row reaches the driver."""
    if df.filter(predicate).limit(1).count():
        raise RunAborted(message)


def _violations(df: DataFrame, identity: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """One row per broken rule, from a single pass over the input."""
    broken = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda r: r.isNotNull()
    )
    return df.select(*identity, F.explode(broken).alias("rule"))


def check_required_fields(df: DataFrame, cols: list[str], identity: list[str]) -> DataFrame:
    return _violations(
        df,
        identity,
        [(f"missing {c}", strip(F.coalesce(F.col(c), F.lit(""))) == "") for c in cols],
    )


def clean_versions(df: DataFrame, column: str = "supported_versions") -> DataFrame:
    stripped = F.transform(F.coalesce(F.col(column), F.array().cast("array<string>")), strip)
    return df.withColumn(column, F.filter(stripped, lambda v: v != ""))


def check_unique_ids(df: DataFrame, column: str) -> DataFrame:
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")
    )


def check_exactly_one(df: DataFrame, a: str, b: str, identity: list[str]) -> DataFrame:
    """Rows in which both or neither selector is set; an empty string counts as unset."""
    is_set = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    return df.filter(is_set(a) == is_set(b)).select(
        *identity, F.when(is_set(a), "both").otherwise("neither").alias("rule")
    )


def check_ranges(
    df: DataFrame, rules: list[tuple[str, Column]], identity: list[str]
) -> DataFrame:
    """``rules`` are (name, condition that must hold); a null value is not a violation."""
    return _violations(df, identity, [(name, ~cond) for name, cond in rules])


def check_enums(df: DataFrame, identity: list[str], columns=None) -> DataFrame:
    present = [c for c in (columns or MEMBERSHIP) if c in df.columns]
    return _violations(
        df,
        identity,
        [
            (f"unknown {c}", ~F.coalesce(F.col(c).isin(*MEMBERSHIP[c]), F.lit(False)))
            for c in present
        ],
    )


def flatten_result(df: DataFrame, struct: str = "source") -> DataFrame:
    """Nested candidate to the flat state columns."""
    return df.select(f"{struct}.*", *[c for c in df.columns if c != struct])


def nest_result(df: DataFrame) -> DataFrame:
    """Flat state columns back to the nested candidate."""
    source = STATE_COLUMNS[:6]
    return df.select(
        F.struct(*source).alias("source"), *[c for c in df.columns if c not in source]
    )
