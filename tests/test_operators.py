"""Operator behaviour that the table checks do not reach: skew, contracts, scoring, aborts."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from parlance.operators import memory, providers, quality, routing, rules, scoring, skew
from parlance.sources import workdir
from parlance.sources.workdir import shared_dir


def hot_rows(spark, n=3000):
    """A third of all rows share one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
        F.col("id"),
        (F.col("id") % 5 == 0).alias("failed"),
    )


def test_two_level_numbers_equal_the_plain_window(spark):
    df = hot_rows(spark)
    got = skew.segment_rows(
        df, ["key"], ["id"], F.floor(F.col("id") / 100), {"bad": F.col("failed").cast("bigint")}
    )
    w = Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.count("*").over(w).alias("_rn"), F.sum(F.col("failed").cast("bigint")).over(w).alias("bad"))
    assert got.exceptAll(want).count() == 0 and got.count() == df.count()


def test_two_level_lag_equals_the_plain_lag(spark):
    df = hot_rows(spark)
    got = skew.segment_lag(df, ["key"], ["id"], F.floor(F.col("id") / 7), {"before": "id"})
    want = df.withColumn("before", F.lag("id").over(Window.partitionBy("key").orderBy("id")))
    assert got.exceptAll(want).count() == 0 and got.count() == df.count()


def test_hot_groups_are_split_and_small_ones_are_not(spark):
    parted = skew.split_groups(hot_rows(spark), ["key"], ["id"], 100)
    sizes = parted.groupBy("key", "part").count()
    assert parted.count() == 3000
    assert sizes.filter("key = 'hot'").agg(F.max("count")).first()[0] < 200
    assert sizes.filter("key <> 'hot' and part <> 0").count() == 0


def test_change_classes_partition_the_keys(spark):
    cols = "mod_id string, domain string, def_type string, key_path string, source_text string"
    now = spark.createDataFrame([("m", "Keyed", None, k, t) for k, t in (("a", "1"), ("b", "2 {0}"), ("c", "3"))], cols)
    old = spark.createDataFrame([("m", "Keyed", None, k, t) for k, t in (("b", "2 {1}"), ("c", "3"), ("d", "4"))], cols)
    got = {r["key_path"]: (r["change"], r["same_normalized"]) for r in memory.detect_changes(now, old).collect()}
    assert got == {"a": ("new", False), "b": ("stale", True), "c": ("unchanged", True), "d": ("orphaned", False)}


def test_first_rule_wins_and_rules_are_checked(spark):
    df = spark.createDataFrame(
        [("Keyed", None, "LetterX"), ("DefInjected", "ThingDef", "A.label"), ("Strings", None, "LetterY")],
        "domain string, def_type string, key_path string",
    )
    override = rules.SemanticRule("mine", "hint", def_type="ThingDef")
    got = [r["semantic_type"] for r in rules.classify_semantic_type(df, (override,)).collect()]
    assert got == ["letter_message", "mine", None]
    with pytest.raises(ValueError):
        rules.SemanticRule("x", "y")
    with pytest.raises(ValueError):
        rules.SemanticRule("x", "y", def_type="A", keyed_key_pattern="B")


def some_strings(spark, n=10):
    return spark.range(n).select(
        F.lit("m").alias("mod_id"),
        F.lit("Keyed").alias("domain"),
        F.lit(None).cast("string").alias("def_type"),
        F.concat(F.lit("K"), F.col("id")).alias("key_path"),
        F.concat(F.lit("text "), F.col("id")).alias("source_text"),
        F.when(F.col("id") % 2 == 0, "even").alias("semantic_type"),
    )


def test_provider_batches_errors_and_contract(spark):
    def translate(texts, semantic, hint, glossary):
        assert len(texts) <= 2
        if semantic is None:
            raise RuntimeError("refused")
        return [t.upper() for t in texts]

    p = providers.Provider("t", "local", "v1", max_batch_size=2, translate=translate, recoverable=(RuntimeError,))
    s = some_strings(spark)
    out = providers.translate_with(s, p)
    good, bad = quality.quarantine(out)
    assert {r["translated_text"] for r in good.collect()} == {f"TEXT {i}" for i in range(0, 10, 2)}
    assert {r["error"] for r in bad.collect()} == {"RuntimeError: refused"}
    assert providers.contract_violations(s, out).count() == 0
    assert providers.contract_violations(s, out.filter("key_path <> 'K3'")).count() == 1


def test_provider_with_a_wrong_number_of_results(spark):
    p = providers.Provider("t", "local", "v1", translate=lambda texts, *_: texts[:-1])
    errors = providers.translate_with(some_strings(spark, 4), p).select("error").collect()
    assert all("results for" in e["error"] for e in errors)


def test_provider_arguments_are_checked():
    with pytest.raises(ValueError):
        providers.Provider("t", "nearby", "v1", expression=lambda c: c)
    with pytest.raises(ValueError):
        providers.Provider("t", "local", "v1")


def test_abort_on_a_matching_row(spark):
    df = some_strings(spark)
    quality.fail_if_any(df, F.col("key_path") == "none", "never")
    with pytest.raises(quality.RunAborted, match="found"):
        quality.fail_if_any(df, F.col("key_path") == "K1", "found")


def test_always_escalate_needs_no_flag(spark):
    from parlance.schemas import GLOSSARY, MEMORY

    policy = routing.RouterPolicy(always_escalate=("even",))
    routed = routing.route(
        some_strings(spark), spark.createDataFrame([], MEMORY), spark.createDataFrame([], GLOSSARY), policy
    )
    got = Counter((r["tier"], r["reason"]) for r in routed.collect())
    assert got == {("remote", "always_escalate"): 5, ("local", ""): 5}


def brute_chrf(ref: str, hyp: str) -> float:
    r, h = "".join(ref.split()), "".join(hyp.split())
    sides = [([r[i : i + n] for i in range(len(r) - n + 1)], [h[i : i + n] for i in range(len(h) - n + 1)]) for n in range(1, 7)]
    rw, hw = ref.split(), hyp.split()
    sides += [([tuple(rw[i : i + n]) for i in range(len(rw) - n + 1)], [tuple(hw[i : i + n]) for i in range(len(hw) - n + 1)]) for n in (1, 2)]
    usable = [(a, b) for a, b in sides if a and b]
    if not usable:
        return 0.0
    match = [sum((Counter(a) & Counter(b)).values()) for a, b in usable]
    p = sum(m / len(b) for m, (_, b) in zip(match, usable)) / len(usable)
    q = sum(m / len(a) for m, (a, _) in zip(match, usable)) / len(usable)
    return 100 * 5 * p * q / (4 * p + q) if p + q else 0.0


def test_chrf_against_brute_force(spark):
    pairs = [
        ("the cat sat on the mat", "the cat on the mat"),
        ("", "x"),
        ("abc", "xyz"),
        ("ключ 🗝 ключ", "ключ 🗝"),
        ("same same", "same same"),
        ("aaaa aaaa aaaa", "aaaa"),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, reference string, hypothesis string")
    got = {r["i"]: r["chrf"] for r in scoring.chrf_scores(df).collect()}
    for i, pair in enumerate(pairs):
        assert got[i] == pytest.approx(brute_chrf(*pair), abs=1e-5)


def test_ngrams_of_a_batch_against_brute_force():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    small = [chr(c) for c in (97, 98, 32, 10, 0x3000, 0x1F600)]
    texts = ["".join(rng.choice(small, size=n)) for n in rng.integers(0, 40, 120)] + ["", "  "]
    texts += ["".join(map(chr, rng.integers(0x4E00, 0x9000, 2000))) for _ in range(2)]  # does not fit 63 bits
    refs, hyps = texts[::2], texts[1::2]
    got = scoring._slice_stats(pa.array(refs + hyps), len(refs), 6, 4)
    for k, (ref, hyp) in enumerate(zip(refs, hyps, strict=True)):
        sides = [("".join(ref.split()), "".join(hyp.split()), n, n - 1) for n in range(1, 7)]
        for a, b, n, place in sides + [(ref.split(), hyp.split(), n, n + 5) for n in range(1, 5)]:
            x, y = (Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1)) for t in (a, b))
            assert got[:, k, place].tolist() == [(x & y).total(), x.total(), y.total()]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_quantiles_are_exact_for_any_number_of_values(spark):
    from parlance.operators.reports import exact_quantiles

    rng = np.random.default_rng(4)
    groups = {"wide": rng.normal(size=20_000), "tied": rng.integers(0, 3, 5000) * 1.5, "one": np.array([7.0]), "two": np.array([1.0, 2.0])}
    rows = [(g, float(x)) for g, values in groups.items() for x in values]
    rows += [("one", None), ("one", float("nan")), ("none", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    wanted = {"low": 0.0, "half": 0.5, "most": 0.95, "high": 1.0}
    got = {r["g"]: tuple(r)[1:] for r in exact_quantiles(df, ["g"], "x", wanted).collect()}
    groups[None] = np.array([3.0])
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g] == pytest.approx([np.quantile(values, p) for p in wanted.values()], rel=1e-15)


def test_review_sample_has_an_exact_size_and_does_not_depend_on_partitions(spark):
    from parlance.operators.scoring import review_sample

    df = spark.range(1000).select("id", (F.col("id") % 7 == 0).alias("rare"), F.when(F.col("id") < 4, "few").alias("kind"))
    samples = [review_sample(df.repartition(n), 20, ["id"], ["rare", "kind"]).collect() for n in (1, 7)]
    assert sorted(samples[0]) == sorted(samples[1])
    sizes = {(r["rare"], r["kind"]): 0 for r in samples[0]}
    for r in samples[0]:
        sizes[r["rare"], r["kind"]] += 1
    assert sizes == {(True, None): 20, (False, None): 20, (True, "few"): 1, (False, "few"): 3}


def test_candidates_of_terms_do_not_grow_with_terms_times_texts(spark, monkeypatch):
    # Every word stands in every text, as in a language; only runs of words tell texts apart.
    draw = random.Random(5)
    words = [f"w{k}" for k in range(60)]
    texts = [(k, " ".join(draw.choices(words, k=draw.choice([8, 18, 19, 20, 60, 300])))) for k in range(120)]
    texts += [(500, None), (501, ""), (502, "w1 " * 50), (503, "w1 w2 " * 40)]
    known = [t.split() for _, t in texts if t]
    keys = [" ".join(t) for t in known[::2]]
    for t in known:
        for n in (1, 2, 3, 5, 18, 19, 20, 35):
            at = draw.randrange(max(len(t) - n, 0) + 1)
            keys.append(" ".join(t[at : at + n]))
    keys += ["w1 w1", "w2 w1 " * 11 + "w2", "absent", "w1 absent", ""]
    kept = {}
    monkeypatch.setattr(rules, "stored", lambda df, name: kept.setdefault(name, workdir.stored(df, name)) if name == "term-candidates" else workdir.stored(df, name))
    given = spark.createDataFrame(texts, "id int, text string")
    found = rules.find_terms(given, spark.createDataFrame([(k,) for k in keys], "term_key string"), ["id"], "text")
    expected = set()
    for k, t in texts:
        w = (t or "").split()
        for key in {k.strip() for k in keys} - {""}:
            run = key.split()
            n = sum(w[i : i + len(run)] == run for i in range(len(w) - len(run) + 1))
            if n:
                expected.add((k, key, n))
    assert {tuple(r) for r in found.collect()} == expected
    long = kept["term-candidates"].filter("_n >= 19").count()
    assert long <= 2 * sum(n for _, key, n in expected if len(key.split()) >= 19)
