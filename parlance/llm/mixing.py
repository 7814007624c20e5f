"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

Every source has a weight and a size (its words). Targets share the total by weight; a source above
``max_epochs`` times its size is clamped there and the excess goes to the others by weight, again and
again until none is above. A source's target is a number of whole repetitions of all its documents
and a fraction. The fraction is a seeded choice: documents stand in the order of a hash, the first of
them that stay within the fractional target are taken once more. The document that does not fit is passed
over, and the choice goes on behind it with documents of at most half of what is left open, until that
is at most ``NEAR_ENOUGH`` of the target; one document that best fills the rest ends it. Every such
level is a cut in the hash range for each source. It is found in two steps: sums over slices of the
range show the slice that holds the cut, and only that slice is summed row by row, so a source with
most of all rows is spread over many tasks.

Defined cases: null and empty texts and null sources are sources and documents like others (size 0 is
taken with 0 words); null sources come last; rows that repeat one document share its hash and are
taken alike; an empty table gives no rows; other columns are kept by ``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import Stored, text_or_empty

WORD = "[^\\x20\\x09-\\x0D]+"
SLICE_BITS = 12
END = (1 << 63) - 1
NEAR_ENOUGH = 0.001


def word_count(text: Column) -> Column:
    """Runs of characters other than space and the ASCII controls from tab to carriage return."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """From one row for each source (source, source_size): adds weight and target.

    Weights repeat over the sources in code point order. Each pass is one aggregate over the sources;
    a pass that clamps no further source ends the filling, so there are at most as many as sources.
    """
    spark = sizes.sparkSession
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(order) - 1) % len(weights) + 1
    rows = sizes.select(
        "source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), number).alias("weight")
    )
    rows = Stored(rows, "mix-sources").df
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:  # words for each unit of weight that sources below their cap receive
        full = F.col("weight") * F.lit(level) >= cap if clamped >= 0 else F.lit(False)
        total, n, used, weight = rows.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.count(F.when(full, 1)),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == clamped or not weight:
            break
        clamped, level = n, max(level, (total - used) / weight)
    target = F.least(F.col("weight") * F.lit(level), cap) if total else F.lit(0.0)
    return rows.withColumn("target", target.cast("double"))


def draw(seed: int) -> Column:
    """A document's place in the seeded order: 63 bits from doc_id and text."""
    text = F.md5(F.encode(text_or_empty(), "UTF-8"))
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"), text), 1)


def prefix(rows: DataFrame, rests: DataFrame) -> DataFrame:
    """For each source s with a rest, the documents in draw order that stay within it: (c, cut, gap).

    ``rows`` has (source, size, draw). All documents up to ``cut`` fit and leave ``gap`` words; if every
    document fits, the cut is the end of the range.
    """
    slice_of = F.shiftrightunsigned("draw", 63 - SLICE_BITS)
    sums = rows.groupBy("source", slice_of.alias("slice")).agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("slice")
    sums = sums.withColumn("base", F.sum("n").over(before) - F.col("n"))
    sums = Stored(sums.join(rests.select("s", "rest"), F.col("source").eqNullSafe(F.col("s"))), "mix-slices").df
    edge = sums.where((F.col("base") < F.col("rest")) & (F.col("rest") <= F.col("base") + F.col("n")))
    edge = edge.select("s", "slice", "base", "rest")
    inside = rows.withColumn("own", slice_of).join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("own") == F.col("slice")))
    order = Window.partitionBy("s").orderBy("draw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("base") + F.sum("size").over(order)
    below = F.shiftleft(F.col("slice"), 63 - SLICE_BITS) - 1
    fits = F.col("upto") <= F.col("rest")
    cut = (
        inside.withColumn("upto", upto)
        .groupBy(F.col("s").alias("c"))
        .agg(
            F.coalesce(F.max(F.when(fits, F.col("draw"))), F.min(below)).alias("cut"),
            (F.min("rest") - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.min("base"))).alias("gap"),
        )
    )
    whole = sums.groupBy(F.col("s").alias("c")).agg(F.sum("n").alias("n"), F.min("rest").alias("rest")).where("n < rest")
    return cut.unionByName(whole.select("c", F.lit(END).alias("cut"), (F.col("rest") - F.col("n")).alias("gap")))


def taken_once_more(size: Column) -> Column:
    """True for the documents of a source's levels: in the level's part of the range and small enough.

    ``size`` is looked at only behind the first level, so texts before it need no counting.
    """
    small = lambda x: (x["limit"] == F.lit(END)) | (size <= x["limit"])
    return F.exists("levels", lambda x: (F.col("draw") > x["after"]) & (F.col("draw") <= x["upto"]) & small(x))


def cuts(rows: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """From (source, size, draw), one row for each source: s, source_size, target, whole, levels, fill.

    A document is taken ``whole`` times, and once more if it is in one of the levels or is ``fill``.
    """
    sized = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sized = sized.withColumn("whole", whole.cast("bigint"))
    sized = sized.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).drop("weight")
    sized = Stored(sized.withColumnRenamed("source", "s"), "mix-targets").df

    def level(after: Column, limit: Column) -> Column:
        return F.array(F.struct(after.alias("after"), F.col("cut").alias("upto"), limit.alias("limit")))

    first = prefix(rows, sized).withColumn("levels", level(F.lit(-1).cast("bigint"), F.lit(END)))
    none = F.array().cast("array<struct<after:bigint,upto:bigint,limit:bigint>>")
    state = sized.join(first, F.col("s").eqNullSafe(F.col("c")), "left").drop("c", "rest")
    state = Stored(
        state.withColumns({"cut": F.coalesce("cut", F.lit(END)), "gap": F.coalesce("gap", F.lit(0.0)), "levels": F.coalesce("levels", none)}),
        "mix-levels",
    ).df
    while True:  # a level at least halves what is left open, so there are about 15 at most
        limit = F.floor(F.col("gap") / 2).cast("bigint")
        waiting = state.where((F.col("gap") > F.col("target") * NEAR_ENOUGH) & (F.col("cut") < END) & (limit > 0))
        waiting = waiting.select("s", F.col("gap").alias("rest"), F.col("cut").alias("after"), limit.alias("limit"))
        if waiting.isEmpty():
            break
        small = rows.join(waiting, F.col("source").eqNullSafe(F.col("s")))
        small = small.where((F.col("draw") > F.col("after")) & (F.col("size") <= F.col("limit"))).select("source", "size", "draw")
        found = waiting.join(prefix(small, waiting), F.col("s").eqNullSafe(F.col("c")), "left")
        found = found.select(
            F.col("s").alias("f"), F.coalesce("cut", F.lit(END)).alias("new_cut"), F.coalesce("gap", "rest").alias("new_gap"),
            F.when(F.col("cut").isNotNull(), level(F.col("after"), F.col("limit"))).otherwise(none).alias("more"), F.lit(True).alias("went"),
        )
        state = state.join(found, F.col("s").eqNullSafe(F.col("f")), "left").select(
            "s", "source_size", "target", "whole",
            F.when(F.col("went"), F.col("new_cut")).otherwise(F.col("cut")).alias("cut"),
            F.when(F.col("went"), F.col("new_gap")).otherwise(F.col("gap")).alias("gap"),
            F.concat("levels", F.coalesce("more", none)).alias("levels"),
        )
        state = Stored(state, "mix-levels").df
    # One more document that best fills what the levels leave open.
    open_ = state.where(F.size("levels") > 0).select(F.col("s").alias("c"), "gap", "levels")
    beyond = rows.join(open_, F.col("source").eqNullSafe(F.col("c"))).where(~taken_once_more(F.col("size")) & (F.col("size") <= F.col("gap")))
    fill = beyond.groupBy(F.col("source").alias("f")).agg(F.max(F.struct("size", "draw"))["draw"].alias("fill"))
    return state.join(fill, F.col("s").eqNullSafe(F.col("f")), "left").select(
        "s", "source_size", "target", "whole", "levels", F.coalesce("fill", F.lit(-1)).alias("fill")
    )


def copies(max_epochs: float, size: Column) -> Column:
    once_more = taken_once_more(size) | (F.col("draw") == F.col("fill"))
    return F.least(F.col("whole") + F.when(once_more, 1).otherwise(0), F.lit(int(max_epochs))).cast("bigint")


def plan(docs: DataFrame, weights: Sequence[float], max_epochs: float, seed: int) -> DataFrame:
    """doc_id, source, size, source_size, target and copies for each document."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", word_count(text_or_empty()).alias("size"), draw(seed).alias("draw")
    )
    rows = Stored(rows, "mix-rows").df
    found = Stored(cuts(rows, weights, max_epochs), "mix-cuts").df
    return rows.join(found, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", copies(max_epochs, F.col("size")).alias("copies")
    )


def mix(docs: DataFrame, weights: Sequence[float], max_epochs: float, seed: int) -> DataFrame:
    """The documents as the mix holds them: each repeated as often as it is taken, all columns kept."""
    kept = docs.columns
    rows = docs.select("source", word_count(text_or_empty()).alias("size"), draw(seed).alias("draw"))
    found = Stored(cuts(Stored(rows, "mix-rows").df, weights, max_epochs), "mix-cuts").df
    held = docs.select(
        draw(seed).alias("draw"), F.col("source").alias("held_source"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("document")
    )
    words = word_count(F.coalesce(F.col("document")["text"], F.lit("")))
    taken = held.join(found, F.col("held_source").eqNullSafe(F.col("s"))).select("document", copies(max_epochs, words).cast("int").alias("n"))
    rows = taken.where(F.col("n") > 0).select("document", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return rows.select("document.*")
