"""Bounded groups: helpers that keep one hot key from becoming one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import hash_bucket


# Key columns that are never null by schema; the others are compared with null equal to null.
# Computed keys (hashes, token sequences) stay out on purpose: plain equality makes the optimizer
# filter on "is not null" below the join and so compute them a second time.
NEVER_NULL = frozenset({"mod_id", "domain", "key_path", "tier", "_segment"})


def key_join(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join on equally named keys, null equal to null, keeping the left side's key columns.

    The right side's keys are renamed first, so both sides may come from the same table.
    """
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        l, r = F.col(k), F.col(f"_r_{k}")
        condition = condition & (l == r if k in NEVER_NULL else l.eqNullSafe(r))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition an input that was read in fewer splits than there are cores.

    One small file with one row group is one task, however many cores are free. Large inputs have
    more splits than cores and are returned as they are, without an exchange.
    """
    context = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() >= context.defaultParallelism:
        return df
    return df.repartition(context.defaultParallelism, *keys)


def split_groups(
    df: DataFrame, group: list[str], identity: list[str], max_rows: int, part: str = "part"
) -> DataFrame:
    """Add ``part`` so that (group, part) holds about ``max_rows`` rows or fewer.

    A group's part count is the power of two that covers its size, so small groups keep one part
    and a growing group doubles its parts instead of reshuffling all of them. Sizes come from a
    map-side combined count; the join side is one row per group, and its broadcast is left to the
    planner's runtime size check, with skew splitting of the large side otherwise.
    """
    needed = F.ceil(F.col("_rows") / max_rows).cast("bigint")
    sizes = (
        df.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            *group,
            F.pow(F.lit(2), F.when(needed > 1, F.length(F.bin(needed - 1))).otherwise(0))
            .cast("bigint")
            .alias("_parts"),
        )
    )
    return key_join(df, sizes, group, "inner").select(
        *df.columns, hash_bucket(F.col("_parts"), *identity).alias(part)
    )


def segment_rows(
    df: DataFrame, keys: list[str], order: list[str], segment: Column, carry: dict[str, Column]
) -> DataFrame:
    """Row numbers and carried sums over ``keys`` computed in two levels.

    ``segment`` must grow with ``order`` (a day, an id block). Rows are windowed inside
    (keys, segment) only; a table with one row per segment then passes on what came before it, so
    no task ever holds a whole hot key. Adds ``_rn`` (1-based number within the key) and, for each
    ``carry`` entry, the running sum up to and including the row.
    """
    cut = df.withColumn("_segment", segment).withColumns(
        {f"_c_{name}": expr for name, expr in carry.items()}
    )
    inner = Window.partitionBy(*keys, "_segment").orderBy(*order)
    running = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns(
        {"_rn": F.row_number().over(inner).cast("bigint")}
        | {name: F.sum(f"_c_{name}").over(running) for name in carry}
    )
    totals = cut.groupBy(*keys, "_segment").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(f"_c_{name}").alias(f"_s_{name}") for name in carry]
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy("_segment")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *keys,
        "_segment",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        *[
            F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0)).alias(f"_b_{name}")
            for name in carry
        ],
    )
    return key_join(local, offsets, [*keys, "_segment"], "inner").select(
        *df.columns,
        (F.col("_rn") + F.col("_n_before")).alias("_rn"),
        *[(F.col(name) + F.col(f"_b_{name}")).alias(name) for name in carry],
    )


def segment_lag(
    df: DataFrame, keys: list[str], order: list[str], segment: Column, lags: dict[str, str]
) -> DataFrame:
    """Previous row's values per key in two levels (see ``segment_rows``).

    ``lags`` maps output name to input column. Only the last row of each segment crosses segments.
    """
    cut = df.withColumn("_segment", segment)
    inner = Window.partitionBy(*keys, "_segment").orderBy(*order)
    local = cut.withColumn("_rn", F.row_number().over(inner)).withColumns(
        {name: F.lag(source).over(inner) for name, source in lags.items()}
    )
    last = cut.groupBy(*keys, "_segment").agg(
        F.max_by(
            F.struct(*[F.col(source).alias(name) for name, source in lags.items()]),
            F.struct(*order),
        ).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy("_segment")
    previous = last.select(*keys, "_segment", F.lag("_last").over(across).alias("_prev"))
    first = F.col("_rn") == 1
    return key_join(local, previous, [*keys, "_segment"], "inner").select(
        *df.columns,
        *[
            F.when(first, F.col(f"_prev.{name}")).otherwise(F.col(name)).alias(name)
            for name in lags
        ],
    )
