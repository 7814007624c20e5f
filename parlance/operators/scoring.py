"""Translation quality figures: n-gram overlap, severity weights, review picks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published metrics: chrF++ n-gram orders and beta, BLEU orders.
CHAR_ORDERS = 6
CHRF_WORD_ORDERS = 2
BLEU_ORDERS = 4
BETA = 2.0

# Symbols that are ranked together; a longer text is a slice of its own.
SLICE = 1 << 16

_NAMES = ("matched", "in_reference", "in_hypothesis")
_STATS = T.StructType([T.StructField(name, T.ArrayType(T.LongType())) for name in _NAMES])
# Whether a code point is white space; the last entry stands for all above.
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])


def _overlaps(symbols: np.ndarray, text: np.ndarray, rows: int, longest: int) -> list[list[np.ndarray]]:
    """Per order 1..longest: clipped matches, n-grams of the reference and of the hypothesis, for each row.

    Texts 0..rows-1 are the references, the next ``rows`` the hypotheses; ``symbols`` are dense numbers in
    the order of ``text``. An n-gram's number is (number of its first n-1 symbols, last symbol) in bits;
    numbers are made dense again only when they would not fit 63 bits with their row, so counting is
    exact for any alphabet. All rows are counted by one sort for each order.
    """
    sizes = np.bincount(text, minlength=2 * rows)
    side, row = text >= rows, text % rows
    width, row_width = int(symbols.max(initial=1)).bit_length(), max(rows - 1, 1).bit_length()
    gram, bits = symbols.astype(np.int64), width
    out = []
    for n in range(1, longest + 1):
        m = max(len(text) - n + 1, 0)
        if n > 1:
            if row_width + bits + width + 1 > 63:
                gram = np.unique(gram, return_inverse=True)[1]
                bits = max(int(gram.max(initial=1)).bit_length(), 1)
            gram, bits = (gram[:m] << width) | symbols[n - 1 :], bits + width
        key = (((row[:m] << bits) | gram) << 1) | side[:m]
        key = key[text[:m] == text[n - 1 :]]
        key.sort()
        same = key >> 1
        heads = np.flatnonzero(np.r_[True, same[1:] != same[:-1]]) if len(key) else np.zeros(0, np.int64)
        theirs = np.add.reduceat(key & 1, heads) if len(key) else heads
        shared = np.minimum(theirs, np.diff(heads, append=len(key)) - theirs)
        matched = np.bincount(same[heads] >> bits, weights=shared, minlength=rows).astype(np.int64)
        left = np.maximum(sizes - n + 1, 0)
        out.append([matched, left[:rows], left[rows:]])
    return out


def _slice_stats(texts: pa.Array, rows: int, chars: int, words: int) -> np.ndarray:
    """(3, rows, orders) counts of references and hypotheses that stand one after the other in ``texts``."""
    joined = " ".join(texts.to_pylist())
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(2 * rows), pc.utf8_length(texts).to_numpy() + 1)[: len(codes)]
    solid = ~_SPACE[np.minimum(codes, len(_SPACE) - 1)]
    found = []
    if chars:
        number = np.cumsum(np.bincount(codes[solid], minlength=1) > 0) - 1
        found += _overlaps(number[codes[solid]], owner[solid], rows, chars)
    if words:
        begins = solid & ~np.r_[False, solid[:-1]]
        found += _overlaps(pd.factorize(np.array(joined.split(), dtype=object))[0], owner[begins], rows, words)
    return np.array(found).transpose(1, 2, 0)


def ngram_stats(chars: int, words: int):
    """Overlap counts of (reference, hypothesis): character orders 1..chars, then word orders 1..words.

    Pairs stay in their rows, and all pairs of an Arrow batch are counted together in slices of about
    ``SLICE`` symbols. Exploding n-grams instead would exchange about six rows per character. A null
    text counts as an empty one.
    """

    @F.arrow_udf(_STATS)
    def stats(reference: pa.Array, hypothesis: pa.Array) -> pa.Array:
        sides = [pc.fill_null(x, "") for x in (reference, hypothesis)]
        total = np.cumsum(sum(pc.utf8_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in sides))
        made, begin = [np.zeros((3, 0, chars + words), np.int64)], 0
        while begin < len(total):
            before = total[begin - 1] if begin else 0
            end = max(int(np.searchsorted(total, before + SLICE, side="right")), begin + 1)
            both = pa.concat_arrays([x.slice(begin, end - begin) for x in sides])
            made.append(_slice_stats(both, end - begin, chars, words))
            begin = end
        counts = np.concatenate(made, axis=1)
        offsets = pa.array(np.arange(len(total) + 1) * (chars + words), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c.ravel(), pa.int64())) for c in counts]
        return pa.StructArray.from_arrays(lists, list(_NAMES))

    return stats("reference", "hypothesis")


def _chrf(matched: list[Column], ref: list[Column], hyp: list[Column]) -> Column:
    """F-score of the mean precision and mean recall over the orders both sides have."""
    orders = [*range(CHAR_ORDERS), *range(CHAR_ORDERS, CHAR_ORDERS + CHRF_WORD_ORDERS)]
    total, n = F.lit(0.0), F.lit(0)
    recall = F.lit(0.0)
    for i in orders:
        usable = (ref[i] > 0) & (hyp[i] > 0)
        total = total + F.when(usable, matched[i] / hyp[i]).otherwise(0.0)
        recall = recall + F.when(usable, matched[i] / ref[i]).otherwise(0.0)
        n = n + F.when(usable, 1).otherwise(0)
    p, r = total / F.greatest(n, F.lit(1)), recall / F.greatest(n, F.lit(1))
    weighted = BETA * BETA * p + r
    return F.when(weighted > 0, 100.0 * (1 + BETA * BETA) * p * r / F.nullif(weighted, F.lit(0.0))).otherwise(0.0)


def chrf_scores(pairs: DataFrame) -> DataFrame:
    """chrF++ of every pair."""
    item = lambda name: [F.get(f"stats.{name}", F.lit(i)) for i in range(CHAR_ORDERS + CHRF_WORD_ORDERS)]
    return (
        pairs.withColumn("stats", ngram_stats(CHAR_ORDERS, CHRF_WORD_ORDERS))
        .withColumn("chrf", F.round(_chrf(*[item(name) for name in _NAMES]), 6))
        .drop("stats", "reference", "hypothesis")
    )


def _corpus(pairs: DataFrame, by: list[str], chars: int, words: int) -> tuple[DataFrame, list[list[Column]]]:
    """Counts of all pairs in a group, summed, and their columns: matched, reference, hypothesis by order."""
    names = [[f"{name}_{i}" for i in range(chars + words)] for name in _NAMES]
    sums = [
        F.sum(F.get(f"stats.{name}", F.lit(i))).alias(alias)
        for name, aliases in zip(_NAMES, names, strict=True)
        for i, alias in enumerate(aliases)
    ]
    stats = pairs.select(*by, ngram_stats(chars, words).alias("stats"))
    summed = stats.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), *sums)
    return summed, [[F.col(a) for a in aliases] for aliases in names]


def chrf_corpus(pairs: DataFrame, by: list[str]) -> DataFrame:
    """chrF++ over the summed counts of all pairs in a group."""
    summed, counts = _corpus(pairs, by, CHAR_ORDERS, CHRF_WORD_ORDERS)
    return summed.select(*by, "pairs", F.round(_chrf(*counts), 6).alias("chrf"))


def bleu_corpus(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Geometric mean of word n-gram precisions 1-4 with brevity penalty."""
    summed, (m, r, h) = _corpus(pairs, by, 0, BLEU_ORDERS)
    zero = F.lit(False)
    logs = F.lit(0.0)
    for i in range(BLEU_ORDERS):
        zero = zero | (m[i] == 0)
        logs = logs + F.ln(F.nullif(m[i], F.lit(0)) / F.nullif(h[i], F.lit(0)))
    brevity = F.least(F.lit(0.0), 1.0 - r[0] / F.nullif(h[0], F.lit(0)))
    score = F.when(zero, 0.0).otherwise(100.0 * F.exp(brevity + logs / BLEU_ORDERS))
    return summed.select(*by, "pairs", F.round(score, 6).alias("bleu"))


def mqm_scores(annotations: DataFrame, segments: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Severity-weighted errors per segment and provider; weights are a parameter."""
    weight = F.coalesce(*[F.when(F.col("severity") == s, F.lit(w)) for s, w in weights.items()])
    errors = annotations.groupBy("provider_id").agg(
        F.sum(weight).alias("penalty"), F.count(F.lit(1)).alias("errors")
    )
    return segments.join(errors, "provider_id", "left").select(
        "provider_id",
        "segments",
        F.coalesce("errors", F.lit(0)).alias("errors"),
        F.round(F.coalesce("penalty", F.lit(0.0)) / F.col("segments"), 6).alias("mqm"),
    )


def hard_cases(scored: DataFrame, k: int, identity: list[str]) -> DataFrame:
    """The k lowest scores per provider; cut to k rows per partition before the exchange."""
    w = Window.partitionBy("provider_id").orderBy("score", *identity)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def review_sample(scored: DataFrame, k: int, identity: list[str], strata: list[str]) -> DataFrame:
    """Exactly ``k`` rows of every stratum (all of a smaller one): those with the least hashes.

    The k least of a part are the k least of the whole cut to it, so every partition keeps only its
    own k before the exchange, and the sample is the same however the rows are dealt.
    """
    mark = F.md5(F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*strata, *identity)]))
    w = Window.partitionBy(*strata).orderBy("_mark", *identity)
    ranked = scored.withColumn("_mark", mark).withColumn("_rank", F.row_number().over(w))
    return ranked.filter(F.col("_rank") <= k).drop("_mark", "_rank")
