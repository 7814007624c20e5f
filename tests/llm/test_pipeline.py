"""The pipeline on the smallest tables and on an empty one; the queries' shapes."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from parlance.llm.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, FOLDER), "test-stage")
        seen[name] = docs.count()
        if name != "packing":
            assert docs.columns == columns
        if name in ("quality", "near_duplicates"):
            assert docs.join(before, "doc_id", "left_anti").count() == 0 and 0 < seen[name] < before.count()
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    assert seen["quality"] <= before.sparkSession.read.parquet(f"{FOLDER}/documents.parquet").count() - labels.where("quality = 0").count() * 0.9
