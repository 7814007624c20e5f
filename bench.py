"""Times the headline queries, each cold and then warm, and prints one JSON line.

The reported time of a query is the warm one; the cold one (first run, with code generation) is
listed next to it. Results go to a no-op sink, so the whole result is computed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from parlance.plans.catalog import QUERIES

HEADLINE = [
    "detect_changes",
    "tm_lookup",
    "route",
    "translate_flow",
    "validate",
    "check_placeholders",
    "gate_failure_report",
    "glossary_terms_in_text",
    "forbidden_term_violations",
    "classify_semantic_type",
    "fan_out_translations",
    "cross_mod_duplicates",
    "latest_tm",
    "tm_history",
    "merge_tm",
    "merge_keyed_files",
    "rediff_changed_files",
    "coverage_report",
    "coverage_cube",
    "provider_stats",
    "collapse_attempts",
    "assign_batches",
    "chrf_corpus",
    "bleu_corpus",
    "hard_cases",
    "write_keyed_pack",
    "read_keyed",
    "render_manifest",
    "issue_counts",
]


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parlance-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    failed: dict[str, str] = {}

    def timed(name: str) -> float | None:
        """Seconds of one run; a query that fails is reported and does not cost the others' figures."""
        try:
            return round(run(spark, name, folder), 3)
        except Exception as exc:
            failed[name] = f"{type(exc).__name__}: {exc}"[:300]
            return None

    cold = {n: timed(n) for n in names}
    warm = {n: timed(n) for n in names if n not in failed}
    warm = {n: s for n, s in warm.items() if s is not None}
    total = round(sum(warm.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm",
                "value": total,
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "failed": failed,
                "sf": folder.rstrip("/").rsplit("/", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
