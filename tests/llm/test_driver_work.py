"""Work that the driver need not do: jobs and scans beyond those that the rows take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from parlance.llm import mixing, packing
from parlance.llm.common import Stored
from parlance.llm.components import components, extended


def jobs(spark, group, work):
    """The number of jobs that ``work`` runs."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_stored_tables_are_opened_without_a_job(spark):
    rows = spark.range(7).select("id", F.when(F.col("id") > 2, F.struct(F.lit("x").alias("y"), F.array("id").alias("z"))).alias("s"))
    held = Stored(rows, "held")
    assert jobs(spark, "opened", lambda: held.df) == 0
    assert held.df.schema == spark.read.parquet(held.path).schema
    assert sorted(map(str, held.df.collect())) == sorted(map(str, rows.collect()))
    assert Stored(rows.where("id < 0"), "held").df.count() == 0


def smallest(links):
    of = {}

    def top(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        of[y] = x
    return {x: top(x) for x in of}


def test_components_go_on_from_those_found_before(spark):
    rng = random.Random(5)
    # Random trees, chains, repeated links, links from both sides and of a node with itself.
    first = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(k, k + 1) for k in range(300, 340)] + [(400, 400)]
    more = [(rng.randrange(260), rng.randrange(260)) for _ in range(40)] + [(340, 301), (299, 320), (500, 501), (501, 500)]
    table = lambda links: spark.createDataFrame(links, "a bigint, b bigint")
    linked = lambda links: {x: y for x, y in smallest(links).items() if any(x in p and p[0] != p[1] for p in links)}
    found = Stored(components(table(first)), "found").df
    assert dict(map(tuple, found.collect())) == linked(first)
    after = extended(found, table(more)).collect()
    assert dict(map(tuple, after)) == linked(first + more) and len(after) == len({r.id for r in after})
    assert extended(found, table([])) is found
    none = Stored(components(table([])), "found").df
    assert none.count() == 0 and dict(map(tuple, extended(none, table(more)).collect())) == linked(more)


def test_packing_reads_all_rounds_at_once(spark):
    rng = random.Random(6)
    sizes = [rng.choice([1, 2, 30, 400, 511, 512, 513, 700, 1000, 1023, 1024]) for _ in range(600)]
    packed = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "id bigint, size bigint"), 1024)
    assert packed._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    ends, rows = {}, sorted(packed.collect(), key=lambda r: (r.sequence_id, r.offset))
    assert sorted(r.id for r in rows) == list(range(600))
    for r in rows:
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + sizes[r.id]
    assert max(ends.values()) <= 1024


def test_targets_share_all_words(spark):
    rows = spark.createDataFrame([("a", 100), ("b", 10), (None, 1)], "source string, source_size bigint")
    assert {r.source: r.target for r in mixing.targets(rows, (5, 2, 1), 3).collect()} == {"a": 78.0, "b": 30.0, None: 3.0}
    empty = mixing.targets(rows.where("source_size < 0"), (5, 2, 1), 3)
    assert empty.count() == 0 and empty.columns[-1] == "target"
