"""An incremental run that can be stopped anywhere and repeated: finished steps are read, not made again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.text import normalize_source
from parlance.operators.gates import ALL_GATES
from parlance.operators.memory import detect_changes, merge_tm, with_hashes
from parlance.operators.providers import PASSTHROUGH, Provider
from parlance.operators.quality import filter_emittable
from parlance.operators.routing import RouterPolicy
from parlance.operators.skew import key_join
from parlance.plans import flows
from parlance.schemas import KEY, MEMORY, SOURCE_LANG, TARGET_LANG
from parlance.sources.workdir import STEP_LEVEL, passing, remove, save


def table_digest(df: DataFrame) -> str:
    """A digest of the rows as a multiset, whatever their order: one aggregate that combines before it moves.

    It holds the number of rows and four sums that take in all 256 bits of every row's hash.
    """
    mark = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    lanes = [F.conv(F.substring("_mark", 1 + 16 * k, 16), 16, 10).cast("decimal(20,0)") for k in range(4)]
    sums = df.select(mark.alias("_mark")).agg(F.count(F.lit(1)), *[F.sum(x) for x in lanes]).first()
    return repr((sorted(df.dtypes), *[str(x) for x in sums]))


class Steps:
    """Steps under one folder, each committed once.

    A step's marker is written after its table is complete; a table without one is made again. Steps
    whose marker stands are not planned at all. ``drop`` is for steps that no later one reads.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _marker(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.done")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def done(self, name: str) -> bool:
        files, path = self._marker(name)
        return files.exists(path)

    def keep(self, make: Callable[[], DataFrame], name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not self.done(name):
            with passing(self.spark):
                save(make(), path, "overwrite", STEP_LEVEL)
            files, marker = self._marker(name)
            files.create(marker, True).close()
        return self.spark.read.parquet(path)

    __call__ = keep

    def drop(self, *names: str) -> None:
        for name in names:
            files, marker = self._marker(name)
            files.delete(marker, False)
            remove(self.spark, f"{self.folder}/{name}")


@dataclass(frozen=True)
class Incremental:
    """What a run found and made: a change for every key, candidates, new memory rows, the memory after it."""

    changes: DataFrame
    candidates: DataFrame
    updates: DataFrame
    memory: DataFrame


def memory_rows(candidates: DataFrame, tm: DataFrame, target_lang: str, at: datetime) -> DataFrame:
    """Passed candidates that no memory row was reused for under their own key, as memory rows.

    Ids go on after the memory's largest one; they are unique, not gapless.
    """
    last = tm.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0]
    rows = with_hashes(filter_emittable(candidates)).withColumns(
        {
            "id": F.lit(last + 1) + F.monotonically_increasing_id(),
            "source_lang": F.lit(SOURCE_LANG),
            "target_lang": F.lit(target_lang),
            "normalized_source": normalize_source("source_text"),
            "translation": F.col("translated_text"),
            "provider": F.col("provider_id"),
            "created_at": F.lit(at).cast("timestamp"),
            "updated_at": F.lit(at).cast("timestamp"),
        }
    )
    have = set(rows.columns)
    return rows.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in MEMORY.fields]
    )


def incremental_run(
    strings: DataFrame,
    tm: DataFrame,
    glossary: DataFrame,
    folder: str,
    at: datetime,
    policy: RouterPolicy = RouterPolicy(),
    local: Provider = PASSTHROUGH,
    remote: Provider = PASSTHROUGH,
    gates: tuple[str, ...] = ALL_GATES,
    second: Provider | None = None,
) -> Incremental:
    """Translate new and stale keys only, then bring the memory up to date.

    ``tm`` holds the current row of every key. Steps are committed in ``folder`` under a digest of the
    three tables, the policy, the gates and the translators' ids and prompt versions: a repeated run with
    the same inputs goes on after its last committed step and calls no translator for a committed
    attempt, and a run with other inputs starts a folder of its own. ``at`` is the time of the new memory
    rows (a repeated run keeps the first one's). Failed candidates stay out of the memory, so their keys
    are new or stale again next time. ``memory`` is the lazy union of ``tm`` and ``updates``. When a run has
    ended, its folder holds changes, candidates and updates; the other steps are dropped as soon as no
    step still to come reads them.
    """
    target_lang = policy.target_lang or TARGET_LANG
    makers = [(p.id, p.kind, p.prompt_version) for p in (local, remote, second) if p is not None]
    parts = [*(table_digest(t) for t in (strings, tm, glossary)), repr(policy), repr(makers), repr(gates)]
    name = hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]
    steps = Steps(strings.sparkSession, f"{folder.rstrip('/')}/{name}")
    changes = steps.keep(lambda: detect_changes(strings, tm, target_lang), "changes")
    wanted = changes.filter(F.col("change").isin("new", "stale")).select(*KEY)
    todo = strings
    if not any(steps.done(later) for later in ("routed", "unique-texts", "texts-and-rules", "results", "candidates")):
        todo = steps.keep(lambda: key_join(strings, wanted, KEY, "left_semi"), "todo")
    candidates = flows.translate_flow(todo, tm, glossary, policy, local, remote, gates, steps, second, given=("todo",))
    kept = steps.keep(lambda: memory_rows(candidates, tm, target_lang, at).drop("normalized_source"), "updates")
    # As long as the source text and made from it, so it is not stored.
    updates = kept.withColumn("normalized_source", normalize_source("source_text")).select(*MEMORY.fieldNames())
    return Incremental(changes, candidates, updates, merge_tm(tm, updates))
