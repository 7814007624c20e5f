"""Deliveries of files against a plain comparison of whole files."""

from __future__ import annotations

import random

import pytest

from parlance.streaming import files

SCHEMA = "mod_id string, file string, version bigint, idx int, line string"


def rows(contents, version):
    return [(m, f, version, i, line) for (m, f), lines in contents.items() for i, line in enumerate(lines)]


def deliver(spark, tmp_path, data, **options):
    arriving = str(tmp_path / "in")
    spark.createDataFrame(data, SCHEMA).repartition(3).write.mode("append").parquet(arriving)
    stream = spark.readStream.schema(SCHEMA).parquet(arriving)
    path = str(tmp_path / "out")
    files.stream_changed_files(stream, path, str(tmp_path / "checkpoint"), **options)
    return sorted((r.mod_id, r.file, r.version, r.idx, r.line) for r in files.changed_lines(spark, path).collect())


def test_deliveries_give_the_lines_of_changed_files(spark, tmp_path):
    pick = random.Random(3)
    contents = {(f"m{i % 2}", f"f{i}"): [pick.choice(["a", "b", "", None, "ä"]) for _ in range(6)] for i in range(6)}
    contents["m0", "f0"] = ["x", "y"]
    assert deliver(spark, tmp_path, rows(contents, 1), fold_every=2) == sorted(rows(contents, 1))
    assert deliver(spark, tmp_path, rows(contents, 2), fold_every=2) == []
    now = dict(contents)
    now["m0", "f0"] = ["y", "x"]  # the same lines in another order are another file
    now["m1", "f1"] = contents["m1", "f1"][:-1]
    now["m1", "new"] = ["one"]
    changed = {k: now[k] for k in (("m0", "f0"), ("m1", "f1"), ("m1", "new"))}
    assert deliver(spark, tmp_path, rows(now, 3), fold_every=2) == sorted(rows(changed, 3))
    late = {("m1", "f1"): ["late"]}
    assert deliver(spark, tmp_path, rows(late, 2), fold_every=2) == []  # older than what was seen
    back = {("m1", "f1"): contents["m1", "f1"]}
    both = rows(late, 4) + rows(back, 5)  # two versions at once: the newer one counts
    assert deliver(spark, tmp_path, both, fold_every=2) == sorted(rows(back, 5))


def test_a_repeated_batch_replaces_its_own_output(spark, tmp_path, monkeypatch):
    first = {("m", "a"): ["1"], ("m", "b"): ["2"]}
    deliver(spark, tmp_path, rows(first, 1))
    digests = files.file_digests

    def stop(spark, path, before):
        if before == 2:  # called when the batch has written everything and folds
            raise RuntimeError("stopped")
        return digests(spark, path, before)

    second = {("m", "a"): ["1", "more"]}
    with monkeypatch.context() as m:
        m.setattr(files, "file_digests", stop)
        with pytest.raises(Exception, match="stopped"):
            deliver(spark, tmp_path, rows(second, 2), fold_every=2)
    arriving = str(tmp_path / "in")
    stream = spark.readStream.schema(SCHEMA).parquet(arriving)
    files.stream_changed_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), fold_every=2)
    got = files.changed_lines(spark, str(tmp_path / "out")).collect()
    assert sorted((r.file, r.line) for r in got) == [("a", "1"), ("a", "more")]
    assert {(r.file, r.version) for r in digests(spark, str(tmp_path / "out"), 2).collect()} == {("a", 2), ("b", 1)}
