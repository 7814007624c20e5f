"""Registered queries of the operators, one for each, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import (
    cap_filters,
    chat,
    cover_codes,
    graph,
    line_runs,
    minhash,
    mixing,
    packing,
    private,
    quality,
    rans,
    resampling,
    sharding,
)
from parlance.llm.common import table
from parlance.sources.workdir import new_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_TOKENIZER, WORD_END = "word_bpe_49k.json", 1
BYTE_TOKENIZER, BYTE_END = "byte_bpe_50k.json", 2
CAPACITY = 1024
SHARDS = 8
SIMILARITY = 0.8
EMBEDDING_COSINE = 0.93
MIX_WEIGHTS, MIX_EPOCHS, SEED = (5, 2, 1), 3, 20


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def training_labels(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """Texts with their quality label, without the held-out third.

    Only those that training can take: the ids are drawn first, at most ``max_documents`` of them, so
    that no other text leaves its scan.
    """
    settings = quality.Settings()
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label")).where(~held_out() & F.col("label").isin(0, 1))
    held = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    drawn = labels.join(held.select("doc_id"), "doc_id", "left_semi").distinct()
    drawn = drawn.orderBy(quality.draw(settings), "doc_id", "label").limit(settings.max_documents)
    return held.join(F.broadcast(drawn), "doc_id")


def held_out(name: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query("op1_subword_quality")
def subword_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.train(training_labels(spark, folder, docs))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "document.doc_id", held_out("document.doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op2_range_coding")
def range_coding(spark: SparkSession, folder: str) -> DataFrame:
    out = new_dir(spark, "token-files")
    rans.write_tokens(table(spark, folder, "documents"), out, tokenizer_path(WORD_TOKENIZER), WORD_END)
    return rans.read_tokens(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op3_cap_filters")
def cap_filter_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, folder, "embeddings"), EMBEDDING_COSINE, SEED)


@query("op4_best_fit")
def best_fit(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, folder, "documents"), tokenizer_path(BYTE_TOKENIZER), BYTE_END, CAPACITY)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op5_byte_shards")
def byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.assign_shards(table(spark, folder, "documents"), SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op6_weighted_minhash")
def weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.duplicates(table(spark, folder, "documents"), SIMILARITY)


@query("op7_disclosure")
def disclosure(spark: SparkSession, folder: str) -> DataFrame:
    return private.report(table(spark, folder, "documents"))


QUERY_EVERY, NEIGHBOURS = 100, 10


@query("op8_pruned_graph")
def pruned_graph(spark: SparkSession, folder: str) -> DataFrame:
    return graph.nearest(table(spark, folder, "embeddings"), QUERY_EVERY, NEIGHBOURS)


CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


@query("op9_prefix_trees")
def prefix_trees(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], given.schema)
    out = new_dir(spark, "chat-trees")
    chat.write_trees(given.unionByName(tricky), out)
    return chat.read_conversations(spark, out)


@query("op10_water_filling")
def water_filling(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan(table(spark, folder, "documents"), MIX_WEIGHTS, MIX_EPOCHS, SEED)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


CODE_PARTS, CODE_ENTRIES, CODE_ROUNDS, CODE_SCALE = 4, 256, 4, 1024


def _codes_sql() -> str:
    """The Lloyd rounds as a chain of tables, every part against every entry."""
    steps = [
        f"""v as (select vec_id, label, list_transform(embedding, lambda x: floor({CODE_SCALE} * x::double)::bigint) as v
 from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"""p as (select vec_id, label, k as part, list_slice(v, k * (len(v) // {CODE_PARTS}) + 1, (k + 1) * (len(v) // {CODE_PARTS})) as x
 from v, range({CODE_PARTS}) t(k))""",
        f"""b0 as (select part, entry, x as c from (select part, x, row_number() over (partition by part order by vec_id) - 1 as entry
 from p) where entry < {CODE_ENTRIES})""",
    ]
    near = """select p.vec_id, p.label, p.part, p.x, min(struct_pack(d := list_sum(list_transform(list_zip(p.x, b.c),
 lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, entry := b.entry)) as best from p join b{k} b using (part)
 group by p.vec_id, p.label, p.part, p.x"""
    for k in range(CODE_ROUNDS):
        steps.append(f"a{k} as materialized ({near.format(k=k)})")
        steps.append(
            f"""m{k} as (select part, entry, list((s - ((s % n) + n) % n) // n order by i) as c from (
 select part, best.entry as entry, i, sum(x[i])::bigint as s, count(*) as n from a{k}, range(1, len(x) + 1) r(i) group by all)
 group by part, entry)"""
        )
        steps.append(
            f"""b{k + 1} as materialized (select b.part, b.entry, coalesce(m.c, b.c) as c from b{k} b left join m{k} m
 on m.part = b.part and m.entry = b.entry)"""
        )
    steps.append(f"z as materialized ({near.format(k=CODE_ROUNDS)})")
    return f"""with {', '.join(steps)},
e as (select vec_id, label, string_agg(lower(printf('%02x', best.entry)), '' order by part) as code, sum(best.d)::bigint as error
 from z group by vec_id, label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
 (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from b{CODE_ROUNDS}) as codebooks_sha256 from e"""


@query("op11_cover_codes", _codes_sql())
def cover_tree_codes(spark: SparkSession, folder: str) -> DataFrame:
    return cover_codes.report(
        table(spark, folder, "embeddings"), parts=CODE_PARTS, entries=CODE_ENTRIES, rounds=CODE_ROUNDS, scale=CODE_SCALE
    )


LINE_DOCUMENTS, LINE_CHARS = 10, 1

_LINE_KEY = """translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


@query(
    "op12_line_runs",
    f"""with t as (select doc_id, row_number() over () as row, string_split(coalesce(text, ''), chr(10)) as lines from documents),
k as (select doc_id, row, lines, list_transform(lines, lambda l: {_LINE_KEY}) as keys from t),
f as (select key from (select unnest(list_distinct(keys)) as key from k) where length(key) >= {LINE_CHARS}
 group by key having count(*) >= {LINE_DOCUMENTS}),
x as (select doc_id, row, unnest(lines) as line, unnest(keys) as key, generate_subscripts(keys, 1) as i from k),
y as (select x.*, f.key is not null as gone from x left join f on f.key = x.key)
select doc_id, count(*) as n_lines, count_if(gone)::bigint as n_dropped,
 sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256 from y group by doc_id, row""",
)
def line_run_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_runs.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), LINE_DOCUMENTS, LINE_CHARS)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op13_head_tail_resampling")
def head_tail_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
