"""Gate cases, one table each."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parlance.functions import tokens
from parlance.operators import gates

TOKENS = ("{0}", "{1}", "{12}", "{QUEST_label}", "{quest_label}", "{MAP_size}")


def generated_pairs(count: int, seed: int = 17) -> list[tuple[str, str, int]]:
    """Texts from two token multisets; the failures to expect are the tokens whose counts differ."""
    rng = random.Random(seed)
    pairs = []
    for _ in range(count):
        ours = rng.choices(TOKENS, k=rng.randrange(5))
        theirs = list(ours)
        for _ in range(rng.randrange(3)):
            theirs = theirs[1:] if theirs and rng.random() < 0.5 else [*theirs, rng.choice(TOKENS)]
        rng.shuffle(theirs)
        source, other = (" ".join(f"{w} {t}" for t in s) for w, s in (("word", ours), ("слово", theirs)))
        a, b = Counter(ours), Counter(theirs)
        pairs.append((source, other, sum(a[t] != b[t] for t in TOKENS)))
    return pairs


PLACEHOLDER_CASES = [
    *generated_pairs(120),
    ("{0:F2} is no token", "none", 0),
    ("{٣} digits of any script", "none", 1),
]


def test_placeholder_cases(spark):
    df = spark.createDataFrame(PLACEHOLDER_CASES, "source_text string, translated_text string, n int")
    out = gates.check_placeholders(df)
    assert out.filter(F.size("failures") != F.col("n")).count() == 0
    assert out.filter(F.col("passed") != (F.col("n") == 0)).count() == 0
    by_function = df.filter(F.size(tokens.failure_messages("source_text", "translated_text")) != F.col("n"))
    assert by_function.count() == 0


def test_rows_without_a_translation_fail(spark):
    rows = [("plain", None, "OSError: down"), ("plain", None, None), ("plain", "", None), ("", "", None)]
    df = spark.createDataFrame(rows, "source_text string, translated_text string, error string")
    got = gates.require_filled(gates.validate(df)).collect()
    assert [r["failures"] for r in got] == [["error OSError: down"], ["missing translation"], ["empty translation"], []]
    assert [r["passed"] for r in got] == [False, False, False, True]
    assert [r["validation_status"] for r in got] == ["failed", "failed", "failed", "passed"]


def test_message_order_and_text(spark):
    df = spark.createDataFrame(
        [("{2} {10} {B} {A} {A}", "{10} {10} {C}")], "source_text string, translated_text string"
    )
    assert gates.check_placeholders(df).first()["failures"] == [
        "positional token {2} missing 1x in translation",
        "positional token {10} appears 1x extra in translation",
        "named token {A} missing 2x in translation",
        "named token {B} missing 1x in translation",
        "named token {C} appears 1x extra in translation",
    ]


@pytest.mark.parametrize(
    ("source", "translation", "gate"),
    [
        ("[pawn_nameFull] x", "x", "rulepack"),
        ("<b>x</b>", "<b>x", "richtext"),
        ("<color=red>x</color>", "<color=blue>x</color>", "richtext"),
        ("a\\nb", "a b", "escape"),
        ("a\\nb", "a\nb", "escape"),
        ("a\\nb", "a\\\\nb", "escape"),
        ("a", "a < b", "xml"),
        ("a", "a & b", "xml"),
        ("a", "a\x07", "xml"),
    ],
)
def test_one_gate_each(spark, source, translation, gate):
    df = spark.createDataFrame([(source, translation)], "source_text string, translated_text string")
    row = gates.validate(df).first()
    assert not row["passed"] and row["validation_status"] == "failed"
    assert {f.split(" ")[0] for f in row["failures"]} == {gate}


def test_identical_texts_pass_every_gate(spark):
    texts = ["", "{0} [a_b] <b>x</b> a\\nb & c < d", "plain", "line\nline", "&amp; <i>t</i>"]
    df = spark.createDataFrame([(t, t) for t in texts], "source_text string, translated_text string")
    assert gates.validate(df).filter("not passed or size(failures) > 0").count() == 0


def test_known_markup_is_safe(spark):
    df = spark.createDataFrame([("<b>x</b> &amp;", True), ("x > y", False)], "t string, ok boolean")
    assert df.filter(tokens.xml_safe_check("t") != F.col("ok")).count() == 0


def test_the_review_queue_searches_every_text_once(spark, tmp_path):
    from parlance.plans.catalog import QUERIES

    rows = [(k, f"text {k} " * (1 + 200 * (k % 2)), "en", f"src{k % 3}", 9) for k in range(40)]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "documents.parquet"))
    queue = QUERIES["review_queue"](spark, str(tmp_path))
    # What is sorted (and sampled for that) is read; nothing of the gates is left in the plan.
    assert "regexp" not in queue._jdf.queryExecution().executedPlan().toString()
    found = dict(map(tuple, queue.collect()))
    assert set(found.values()) == {"failed", "always_review", "difficult"} and found[0] == "failed"
