"""A run that stops after the translators and is repeated."""

from __future__ import annotations

import os
from datetime import datetime

import pytest

from parlance.operators.memory import with_hashes
from parlance.operators.providers import Provider
from parlance.operators.routing import RouterPolicy
from parlance.plans import flows, resume
from parlance.schemas import GLOSSARY, MEMORY

COLUMNS = "mod_id string, domain string, def_type string, key_path string, source_text string, semantic_type string"
POLICY = RouterPolicy(max_local_retries=0)


def strings(spark, texts):
    return spark.createDataFrame([("m", "Keyed", None, k, t, "label") for k, t in texts.items()], COLUMNS)


def counted(folder, kind):
    def translate(texts, *_):
        with open(os.path.join(folder, f"{kind}.log"), "a") as log:
            log.writelines(f"{t}\n" for t in texts)
        if "broken" in texts:
            raise OSError("down")
        return [f"{kind}: {t}" for t in texts]

    return Provider(id=kind, kind=kind, prompt_version="1", max_batch_size=1, translate=translate)


def calls(folder):
    return sorted(open(os.path.join(folder, "local.log")).read().splitlines())


def test_stopped_run_goes_on_without_calls_and_the_next_takes_changes_only(spark, tmp_path, monkeypatch):
    folder, out = str(tmp_path), str(tmp_path / "runs")
    nothing, glossary = spark.createDataFrame([], MEMORY), spark.createDataFrame([], GLOSSARY)
    first = {"A": "alpha", "B": "beta", "C": "alpha", "D": "broken"}

    def run(texts, tm, day):
        return resume.incremental_run(
            strings(spark, texts), tm, glossary, out, datetime(2030, 1, day), POLICY, counted(folder, "local"), counted(folder, "remote")
        )

    def stop(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(flows, "fan_out_translations", stop)
        with pytest.raises(KeyboardInterrupt):
            run(first, nothing, 1)
    assert calls(folder) == ["alpha", "beta", "broken"]
    done = run(first, nothing, 2)
    assert calls(folder) == ["alpha", "beta", "broken"]
    memory = {r.key_path: r for r in done.memory.collect()}
    assert {k: r.translation for k, r in memory.items()} == {"A": "local: alpha", "B": "local: beta", "C": "local: alpha"}
    assert len({r.id for r in memory.values()}) == 3 and done.candidates.count() == 4
    assert [tuple(r) for r in run(first, nothing, 3).updates.select("id", "updated_at").collect()] == [
        tuple(r) for r in done.updates.select("id", "updated_at").collect()
    ]

    tm = spark.createDataFrame(done.memory.collect(), MEMORY)
    later = run({"A": "alpha", "B": "beta two", "E": "new"}, tm, 4)
    assert calls(folder) == ["alpha", "beta", "beta two", "broken", "new"]
    assert {(r.key_path, r.change) for r in later.changes.collect()} == {("A", "unchanged"), ("B", "stale"), ("C", "orphaned"), ("E", "new")}
    assert {r.key_path: (r.source_text, r.translation) for r in later.memory.collect()} == {
        "A": ("alpha", "local: alpha"), "B": ("beta two", "local: beta two"), "C": ("alpha", "local: alpha"), "E": ("new", "local: new"),
    }
    assert len({r.id for r in later.memory.collect()}) == 4


def test_a_run_keeps_what_it_returns_and_no_other_step(spark, tmp_path):
    nothing, glossary = spark.createDataFrame([], MEMORY), spark.createDataFrame([("global", None, "beta", "b", [])], GLOSSARY)

    def run():
        texts = strings(spark, {"A": "alpha", "B": "beta {0}", "C": "alpha"})
        providers = counted(str(tmp_path), "local"), counted(str(tmp_path), "remote")
        return resume.incremental_run(texts, nothing, glossary, str(tmp_path / "runs"), datetime(2030, 1, 1), POLICY, *providers)

    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    first = run()
    (folder,) = (tmp_path / "runs").iterdir()
    assert sorted(p.name for p in folder.iterdir() if not p.name.startswith(".")) == sorted(
        f"{step}{end}" for step in ("changes", "candidates", "updates") for end in ("", ".done")
    )
    assert set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) == before
    again = run()
    assert sorted(map(str, again.candidates.collect())) == sorted(map(str, first.candidates.collect()))
    assert {r.key_path: r.normalized_source for r in again.updates.collect()} == {"A": "alpha", "B": "beta {#}", "C": "alpha"}
    assert again.updates.columns == MEMORY.fieldNames()
    assert calls(str(tmp_path)) == ["alpha", "beta {0}"]


def test_a_step_without_its_marker_is_made_again(spark, tmp_path):
    steps = resume.Steps(spark, str(tmp_path))
    made = []

    def step(n):
        return lambda: (made.append(n), spark.range(n))[1]

    assert steps.keep(step(3), "x").count() == 3 and steps.keep(step(4), "x").count() == 3
    os.remove(tmp_path / "x.done")
    assert steps.keep(step(5), "x").count() == 5 and made == [3, 5]


def test_digest_of_a_table(spark):
    rows = strings(spark, {"A": "x", "B": "y"})
    same = resume.table_digest(rows)
    assert same == resume.table_digest(rows.repartition(3).orderBy("key_path", ascending=False))
    assert len({same, resume.table_digest(strings(spark, {"A": "y", "B": "x"})), resume.table_digest(rows.union(rows))}) == 3
    assert resume.table_digest(with_hashes(rows)) != same
