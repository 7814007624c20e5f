"""The run's first half with a translator that fails and one that counts its calls."""

from __future__ import annotations

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from parlance.operators.providers import Provider, translate_with
from parlance.operators.routing import RouterPolicy
from parlance.plans import flows
from parlance.schemas import GLOSSARY, MEMORY


def strings(spark):
    rows = [("m", "Keyed", None, f"K{i}", f"text number {i % 4}", ("good", "bad")[i % 2]) for i in range(12)]
    columns = "mod_id string, domain string, def_type string, key_path string, source_text string, semantic_type string"
    return spark.createDataFrame(rows, columns).withColumn("context_hint", F.concat(F.lit("hint "), "semantic_type"))


def provider(folder, kind: str) -> Provider:
    def translate(texts, semantic, hint, rules):
        assert hint == f"hint {semantic}"
        for text in texts:
            with open(os.path.join(folder, f"{kind}.log"), "a") as log:
                log.write(f"{text}|{sorted(rules.items())}\n")
        if semantic == "bad":
            raise OSError("down")
        return [f"{kind}: {t}" for t in texts]

    return Provider(id=kind, kind=kind, prompt_version="1", max_batch_size=2, translate=translate)


def test_failed_items_stay_failed_and_calls_are_not_repeated(spark, tmp_path):
    glossary = spark.createDataFrame([("global", None, "number", "номер", [])], GLOSSARY)
    folder = str(tmp_path)
    made = flows.translate_flow(
        strings(spark), spark.createDataFrame([], MEMORY), glossary, RouterPolicy(max_local_retries=1),
        provider(folder, "local"), provider(folder, "remote"),
    )
    for _ in range(2):  # using the result again calls nobody
        rows = made.collect()
    good = [r for r in rows if r["semantic_type"] == "good"]
    bad = [r for r in rows if r["semantic_type"] == "bad"]
    assert len(good) == len(bad) == 6
    assert all(r["translated_text"] == f"local: {r['source_text']}" and r["validation_status"] == "passed" for r in good)
    assert all(r["translated_text"] is None and r["validation_status"] == "failed" for r in bad)
    assert all(r["error"] == "OSError: down" and r["review_status"] == "unreviewed" for r in bad)
    assert {r["provider_id"] for r in bad} == {"remote"}
    calls = {k: (tmp_path / f"{k}.log").read_text().splitlines() for k in ("local", "remote")}
    rule = "[('number', 'номер')]"
    assert sorted(calls["local"]) == sorted(f"text number {i}|{rule}" for i in (0, 1, 1, 2, 3, 3))
    assert sorted(calls["remote"]) == sorted(f"text number {i}|{rule}" for i in (1, 3))


def test_a_flow_leaves_its_candidates_only(spark, tmp_path):
    glossary = spark.createDataFrame([("global", None, "number", "номер", []), ("global", None, "text number 0", "ноль", [])], GLOSSARY)
    shared = spark.conf.get("spark.checkpoint.dir")
    tables = set(os.listdir(shared))
    made = flows.translate_flow(
        strings(spark), spark.createDataFrame([], MEMORY), glossary, RouterPolicy(max_local_retries=1),
        provider(str(tmp_path), "local"), provider(str(tmp_path), "remote"),
    )
    assert [t.rpartition("-")[0] for t in set(os.listdir(shared)) - tables] == ["candidates"]
    rows = made.collect()
    reused = [r for r in rows if r.tier == "glossary"]
    assert len(rows) == 12 and len(reused) == 3
    assert all((r.translated_text, r.provider_id, r.prompt_version, r.error) == ("ноль", "reuse:glossary", "none", None) for r in reused)


def test_a_stored_table_leaves_no_exchanged_files(spark):
    from parlance.sources.workdir import stored

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def exchanged():
        files = disk.getAllFiles()
        return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}

    before = exchanged()
    rows = stored(spark.range(1000).repartition(3, "id"), "exchanged")
    until = time.time() + 20
    while exchanged() - before and time.time() < until:
        time.sleep(0.2)
    assert not exchanged() - before and rows.count() == 1000


def find(spark, texts, terms):
    from parlance.operators.rules import find_terms

    rows = spark.createDataFrame(texts, "id int, source_text string").repartition(3)
    wanted = spark.createDataFrame([(t,) for t in terms], "term_key string")
    found = find_terms(rows, wanted, ["id"], "source_text")
    return sorted(((r["id"] if r["id"] is not None else -1, r["term_key"], r["occurrences"]) for r in found.collect())), found


def occurrences(texts, terms):
    out = {}
    for i, text in texts:
        words = re.findall(r"\w+", (text or "").lower())
        for term in set(terms) - {""}:
            t = term.split(" ")
            n = sum(words[k : k + len(t)] == t for k in range(len(words) - len(t) + 1))
            key = (-1 if i is None else i, term)
            out[key] = out.get(key, 0) + n
    return sorted((*k, n) for k, n in out.items() if n)


def test_terms_of_one_word_to_thousands_of_words(spark):
    long = [f"w{k % 900}" for k in range(3000)]
    texts = [
        (1, "start " + " ".join(long) + " and " + " ".join(long)),
        (2, " ".join(long[1:])),
        (3, "the the the, the cat; THE cat"),
        (3, "the cat again"),  # a second text under one identity
        (4, "the the cat"),
        (4, "the the cat"),  # a repeated row
        (5, None),
        (6, ""),
        (None, "cat of the"),
    ]
    terms = [" ".join(long), "the", "the the", "the cat", "cat", "w899 w0", "absent", "the absent", "", "of the", "the cat the"]
    found, frame = find(spark, texts, terms)
    assert found == occurrences(texts, terms)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 40_000  # no expression grows with the longest term


def test_no_terms_and_no_texts(spark):
    assert find(spark, [(1, "a b")], [])[0] == []
    assert find(spark, [], ["a", "a b"])[0] == []


def test_only_recoverable_errors_become_rows(spark):
    from pyspark.errors import PythonException

    def broken(texts, *_):
        raise RuntimeError("a mistake in the code")

    rows = strings(spark)
    provider_ = Provider(id="x", kind="local", prompt_version="1", translate=broken)
    with pytest.raises(PythonException):
        translate_with(rows, provider_).collect()
    allowed = Provider(id="x", kind="local", prompt_version="1", translate=broken, recoverable=(RuntimeError,))
    assert {r["error"] for r in translate_with(rows, allowed).collect()} == {"RuntimeError: a mistake in the code"}


def test_second_pass_that_differs_sends_a_text_to_the_remote_translator(spark, tmp_path):
    def made(name, kind, answer):
        return Provider(id=name, kind=kind, prompt_version="1", translate=lambda texts, *_: [answer(t) for t in texts])

    first = made("one", "local", lambda t: f"uno due tre {t}")
    second = made("two", "local", lambda t: "" if t.endswith("3") else f"uno due tre {t}" if t.endswith("1") else f"x {t[-1]}")
    remote = made("far", "remote", lambda t: f"far {t}")
    rows = flows.translate_flow(
        strings(spark), spark.createDataFrame([], MEMORY), spark.createDataFrame([], GLOSSARY),
        RouterPolicy(), first, remote, second=second,
    ).collect()
    got = {(r["source_text"][-1], r["provider_id"], r["escalation"], r["reason"]) for r in rows}
    # An empty second text fails its gates and decides nothing.
    assert got == {("0", "far", "disagreement", ""), ("1", "one", None, ""), ("2", "far", "disagreement", ""), ("3", "one", None, "")}
    assert len(rows) == 12


def test_layers_are_found_with_one_read_of_the_glossary(spark):
    from parlance.operators.rules import apply_layers

    terms = [
        ("global", None, "a", "ga", []), ("global", "x", "a", "gx", []), ("mod", "m1", "a", "ma", []),
        ("semantic_type", "t1", "a", "ta", []), ("semantic_type", "t2", "b", "tb", ["no"]), ("mod", None, "a", "none", []),
    ]
    reads = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            reads.add(len(frame))
            yield frame

    glossary = spark.createDataFrame(terms, GLOSSARY).mapInPandas(counted, GLOSSARY)
    rows = [(m, t, k) for m in ("m1", "m2", None) for t in ("t1", "t2", None) for k in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "mod_id string, semantic_type string, term string")

    def expected(mod, kind, term, layers):
        for layer in layers:
            value = {"mod": mod, "semantic_type": kind, "global": ""}[layer]
            for scope, scope_value, name, preferred, _ in terms:
                if scope == layer and (scope_value or "") == value and name == term:
                    return layer, preferred
        return None, None

    for layers in (("mod", "semantic_type", "global"), ("global", "mod"), ("semantic_type",)):
        reads.value = 0
        out = apply_layers(df, glossary, "term", layers).collect()
        assert reads.value == len(terms)
        assert len(out) == len(rows)
        for r in out:
            assert (r["glossary_layer"], r["preferred"]) == expected(r["mod_id"], r["semantic_type"], r["term"], layers)
