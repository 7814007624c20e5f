"""Streaming queries and the build half. Streams run to the end of what is there, into files."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import gates
from parlance.operators.rules import classify_semantic_type
from parlance.plans import flows
from parlance.plans import views as v
from parlance.plans.registry import query
from parlance.schemas import KEY
from parlance.sources.datasets import read_tm, write_tm
from parlance.sources.workdir import new_dir
from parlance.streaming import issues, strings
from parlance.streaming.tables import run_available, stream_table


def _utc(spark):
    """A session of its own with UTC, so that windows start at the data's midnight."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(
        "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    )
    return session


def _drain(spark, session, stream, name: str):
    out = new_dir(spark, name)
    run_available(stream, out, new_dir(spark, f"{name}-checkpoint"))
    return session.read.schema(stream.schema).parquet(out)


def _issue_stream(session, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return stream_table(session, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("component"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("run"),
        (k < 20).alias("failed"),
    )


def _text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# Append mode emits a window once the watermark (newest row less one hour) has passed its end.
_CLOSED = (
    "window_end <= (select date_trunc('milliseconds', max(ts)) - interval 1 hour from v_r)"
)
_FORMAT = "strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S') as window_end"


@query(
    "issue_counts",
    f"""select {_FORMAT}, component, issues, failures from (
 select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end,
 provider as component, count(*) as issues, count_if(failed)::bigint as failures from v_r group by all) where {_CLOSED}""",
)
def _(spark, folder):
    session = _utc(spark)
    counts = issues.issue_counts(_issue_stream(session, folder), "1 day")
    return _drain(spark, session, counts, "issues").select(
        _text("window_start"), _text("window_end"), "component", "issues", "failures"
    )


@query(
    "issue_counts_sliding",
    f"""select {_FORMAT}, component, issues, failures from (
 select time_bucket(interval 6 hour, ts) - to_hours(6 * k) as window_start,
 time_bucket(interval 6 hour, ts) - to_hours(6 * k) + interval 1 day as window_end,
 provider as component, count(*) as issues, count_if(failed)::bigint as failures
 from v_r, range(4) t(k) group by all) where {_CLOSED}""",
)
def _(spark, folder):
    session = _utc(spark)
    counts = issues.issue_counts_sliding(_issue_stream(session, folder), "1 day", "6 hours")
    return _drain(spark, session, counts, "sliding").select(
        _text("window_start"), _text("window_end"), "component", "issues", "failures"
    )


@query(
    "run_sessions",
    f"""select {_FORMAT}, run, issues, failures from (
 select key as run, min(ts) as window_start, max(ts) + interval 6 hour as window_end, count(*) as issues,
 count_if(failed)::bigint as failures from (
 select *, sum(new) over (partition by key order by ts, event_id) as session from (
 select *, case when ts - lag(ts) over (partition by key order by ts, event_id) <= interval 6 hour then 0 else 1 end as new
 from v_r)) group by key, session) where {_CLOSED}""",
)
def _(spark, folder):
    session = _utc(spark)
    sessions = issues.run_sessions(_issue_stream(session, folder), "6 hours")
    return _drain(spark, session, sessions, "sessions").select(
        _text("window_start"), _text("window_end"), "run", "issues", "failures"
    )


@query(
    "stream_new_strings",
    "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_type from events",
)
def _(spark, folder):
    session = _utc(spark)
    # Every event arrives twice.
    fresh = strings.stream_new_strings(session, folder, sources=2)
    out = fresh.select("event_id", "ts", "event_type")
    return _drain(spark, session, out, "new").select("event_id", _text("ts"), "event_type")


@query(
    "stream_tm_reuse",
    "select mod_id, domain, def_type, key_path, tm_scope, md5(tm_translation) as tm_translation from v_look",
)
def _(spark, folder):
    session = _utc(spark)
    arriving = v.strings_of(stream_table(session, folder, "documents"))
    typed = classify_semantic_type(arriving, v.OVERRIDES)
    found = strings.stream_tm_reuse(typed, v.memory(session, folder), cross_mod_types=None)
    out = found.select(*KEY, "tm_scope", "tm_translation")
    return _drain(spark, session, out, "reuse").withColumn(
        "tm_translation", F.md5("tm_translation")
    )


@query(
    "stream_merge_tm",
    """select mod_id, domain, def_type, key_path, arg_max(id, (updated_at, id)) as id,
 arg_max(provider, (updated_at, id)) as provider from v_h group by all""",
)
def _(spark, folder):
    session = _utc(spark)
    path = new_dir(spark, "memory")
    write_tm(v.memory(session, folder), path, version=0)
    arriving = v.strings_of(stream_table(session, folder, "documents"))
    rows = v.updates_of(classify_semantic_type(arriving, v.OVERRIDES))
    strings.stream_merge_tm(rows, path, new_dir(spark, "merge-checkpoint"))
    return read_tm(session, path).select(*KEY, "id", "provider")


@query(
    "build_flow",
    "select mod_id, domain, count(*) as emitted from v_v where passed group by all",
)
def _(spark, folder):
    stored = new_dir(spark, "candidates")
    checked = gates.validate(v.candidates(spark, folder)).withColumn("idx", F.col("doc_id"))
    checked.drop("failures").write.parquet(stored)
    candidates = spark.read.parquet(stored)
    mods = candidates.groupBy("mod_id").agg(F.concat(F.lit("Mod "), "mod_id").alias("name"))
    return flows.build_flow(candidates, mods, new_dir(spark, "pack"))
