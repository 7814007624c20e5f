"""Windowed figures over the issue log. State is one row per open window and component."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(stream: DataFrame, frame: Column, ts: str, late: str, component: str) -> DataFrame:
    return (
        stream.withWatermark(ts, late)
        .groupBy(frame.alias("w"), component)
        .agg(F.count(F.lit(1)).alias("issues"), F.count_if("failed").alias("failures"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            component,
            "issues",
            "failures",
        )
    )


def issue_counts(
    stream: DataFrame,
    width: str,
    late: str = "1 hour",
    ts: str = "ts",
    component: str = "component",
) -> DataFrame:
    """Issues and failures per component in tumbling windows; closed windows only."""
    return _counts(stream, F.window(ts, width), ts, late, component)


def issue_counts_sliding(
    stream: DataFrame,
    width: str,
    slide: str,
    late: str = "1 hour",
    ts: str = "ts",
    component: str = "component",
) -> DataFrame:
    """The same over overlapping windows."""
    return _counts(stream, F.window(ts, width, slide), ts, late, component)


def run_sessions(
    stream: DataFrame, gap: str, late: str = "1 hour", ts: str = "ts", run: str = "run"
) -> DataFrame:
    """Log lines of one run grouped into sessions that end after ``gap`` of silence."""
    return _counts(stream, F.session_window(ts, gap), ts, late, run)
