"""The bucketed memory against the plain joins, its plans, and builds that stop."""

from __future__ import annotations

import random
import re
from datetime import datetime

import pytest

from parlance.operators import memory
from parlance.schemas import MEMORY
from parlance.sources import datasets, memory_index

STRINGS = "mod_id string, domain string, def_type string, key_path string, source_text string, semantic_type string"
TEXTS = ["open", "open  {0}", "open {1}", "{0} of {1}", "", "шлюз", "close"]


def tables(spark, seed=1):
    """Strings and memory with null types, shared texts, tokens and rejected rows."""
    pick = random.Random(seed)
    keys = [(f"m{i % 3}", "Keyed", (None, "", "ThingDef")[i % 3 if i % 2 else 0], f"K{i % 40}.{i // 40}") for i in range(90)]
    strings = [(*k, pick.choice(TEXTS), pick.choice(["label", None])) for k in keys[:60]]
    stored = []
    for i, k in enumerate(keys[30:]):
        text = pick.choice(TEXTS)
        row = dict.fromkeys(MEMORY.fieldNames())
        row |= dict(zip(("mod_id", "domain", "def_type", "key_path"), k))
        row |= {
            "id": i, "source_lang": "en", "target_lang": "de" if i % 10 == 9 else "ru", "source_text": text,
            "translation": text.replace("open", "откр"), "semantic_type": pick.choice(["label", None]),
            "validation_status": "passed", "review_status": "rejected" if i % 7 == 0 else "auto_accepted",
            "updated_at": datetime(2030, 1, 1 + i % 5),
        }
        stored.append(tuple(row[c] for c in MEMORY.fieldNames()))
    tm = memory.with_hashes(spark.createDataFrame(stored, MEMORY)).select(*MEMORY.fieldNames())
    return spark.createDataFrame(strings, STRINGS), tm


def same(one, two):
    columns = sorted(one.columns)
    assert columns == sorted(two.columns)
    plain = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert plain(one) == plain(two)


@pytest.mark.parametrize("types", [None, (), ("label",)])
def test_index_gives_what_the_plain_joins_give(spark, tmp_path, types):
    strings, tm = tables(spark)
    datasets.write_tm(tm, str(tmp_path), 0)
    index = memory_index.open_index(spark, str(tmp_path))
    same(memory_index.indexed_changes(strings, index), memory.detect_changes(strings, tm))
    same(memory_index.indexed_lookup(strings, index, types), memory.tm_lookup(strings, tm, types))


def test_another_session_uses_the_index_and_appended_rows_make_a_new_one(spark, tmp_path):
    path = str(tmp_path)
    strings, tm = tables(spark)
    datasets.write_tm(tm, path, 0)
    first = memory_index.open_index(spark, path, buckets=5)
    for part in memory_index.TABLES:
        spark.sql(f"drop table {first.name}_{part}")  # what a new session's catalog knows
    again = memory_index.open_index(spark, path)
    assert again.name == first.name
    same(memory_index.indexed_changes(strings, again), memory.detect_changes(strings, tm))
    changed = tm.filter("id % 4 = 0").withColumns(
        {"translation": memory.F.lit("новое"), "updated_at": memory.F.lit("2031-01-01").cast("timestamp")}
    )
    datasets.append_tm(changed, path, "a")
    newer = memory_index.open_index(spark, path)
    assert newer.name != first.name
    now = datasets.read_tm(spark, path)
    same(memory_index.indexed_changes(strings, newer), memory.detect_changes(strings, now))
    same(memory_index.indexed_lookup(strings, newer, None), memory.tm_lookup(strings, now, None))


def test_only_the_strings_are_exchanged(spark, tmp_path):
    strings, tm = tables(spark)
    datasets.write_tm(tm, str(tmp_path), 0)
    index = memory_index.open_index(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, joins in ((memory_index.indexed_changes(strings, index), 1), (memory_index.indexed_lookup(strings, index, None), 3)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == joins
            assert plan.count("Exchange hashpartitioning") == joins
            assert plan.count("Bucketed: true") == joins
            scans = re.findall(r"\n([^\n]*)FileScan", plan)
            assert len(scans) == joins
            for part in plan.split("Exchange ")[1:]:  # what an exchange takes in are strings
                assert "FileScan" not in part.split("Sort [")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_memory_and_a_build_that_stopped(spark, tmp_path, monkeypatch):
    strings, tm = tables(spark)
    empty = memory_index.open_index(spark, str(tmp_path / "none"))
    assert {r["change"] for r in memory_index.indexed_changes(strings, empty).collect()} == {"new"}
    assert memory_index.indexed_lookup(strings, empty, None).filter("tm_scope is not null").count() == 0
    path = str(tmp_path / "stopped")
    datasets.write_tm(tm, path, 0)
    fill = memory_index._fill

    def stop(index, part, rows, buckets):
        if part == "own":
            raise KeyboardInterrupt
        fill(index, part, rows, buckets)

    with monkeypatch.context() as m:
        m.setattr(memory_index, "_fill", stop)
        with pytest.raises(KeyboardInterrupt):
            memory_index.open_index(spark, path)
    same(memory_index.indexed_changes(strings, memory_index.open_index(spark, path)), memory.detect_changes(strings, tm))
