"""Conversations as prefix trees: shared first turns are written once.

A conversation is a path of turns; conversations that begin alike share the path's beginning and form
a tree. A node is a turn in its context, named by a hash of its whole path. The tree is written depth
first: conversations are sorted by their paths, a node belongs to the first conversation through it,
and nodes stand in the order (owner, depth). Positions are prefix sums over that order in two levels,
range partitions first, so one tree may be spread over many tasks. Each node carries its position ids
(the text before it on its own path) and the intervals of the tree's text that it attends to: its
ancestors, with neighbouring ones merged.

Template: ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Inside roles and texts, a run of
backslashes between ``<`` and ``|`` gets one more, so no control string can occur; in roles a newline
is written as backslash n. Both are undone exactly when read. The loss mask covers the texts of
assistant turns.

Defined cases: null texts and roles are empty; null turns come first, equal turn numbers are ordered
by role and text, repeated rows are repeated turns; rows without a conversation id are one
conversation; a conversation is streamed turn by turn, whatever its length, and its path takes 16
bytes a turn; an empty table gives empty tables; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.llm.common import Stored

START, END = "<|im_start|>", "<|im_end|>\n"  # fixed values of the template
LEARNED = "assistant"
_control = re.compile(r"<(\\*)\|")
_escaped = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _control.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _escaped.sub(r"<\1|", text)


def render(role: str, text: str) -> str:
    """One turn in the template."""
    name = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
    return f"{START}{name}\n{escape(text)}{END}"


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    name, _, rest = segment[len(START) :].partition("\n")
    if not segment.startswith(START) or not rest.endswith(END):
        raise ValueError("not a turn of this template")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name)
    return unescape(role), unescape(rest[: -len(END)])


def _stream(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of one key together and in order, for functions that stream."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def paths(conversations: DataFrame) -> Stored:
    """conv, number, node, parent, depth, before (characters ahead on the path) and segment per turn."""

    def run(batches):
        conv, chain, number, before = object(), b"", 0, 0
        for batch in batches:
            rows = []
            for c, role, text in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if c != conv:
                    conv, chain, number, before = c, b"", 0, 0
                segment = render(role, text)
                node = hashlib.blake2b(chain + segment.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                rows.append((c, number, node, chain or None, before, len(segment), segment))
                chain, number, before = node, number + 1, before + len(segment)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
            names = ["conv", "number", "node", "parent", "before", "length", "segment"]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = _stream(rows, ["conv"], ["turn", "role", "text"])
    schema = "conv bigint, number bigint, node binary, parent binary, before bigint, length bigint, segment string"
    return Stored(ordered.select("conv", "role", "text").mapInArrow(run, schema), "chat-paths", "zstd")


def sorted_paths(turns: DataFrame) -> DataFrame:
    """(of, rank): distinct positions of the conversations in the order of their paths."""
    keys = turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("number", "node"))).alias("path"))
    keys = Stored(keys.select("conv", F.transform("path", lambda p: p["node"]).alias("path")), "chat-keys").df
    ranged = keys.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")
    # The number holds the partition and the place in it, so it rises in the sorted order.
    return Stored(ranged.select(F.col("conv").alias("of"), F.monotonically_increasing_id().alias("rank")), "chat-ranks").df


def layout(turns: DataFrame, ranks: DataFrame) -> DataFrame:
    """node, tree, owner, start and length: where every distinct node stands in its tree's text."""
    owned = turns.select("conv", "number", "node", "length").join(ranks, F.col("conv").eqNullSafe(F.col("of"))).select(
        "node", "rank", "number", "length"
    )
    nodes = owned.groupBy("node").agg(F.min("rank").alias("owner"), F.min("number").alias("depth"), F.min("length").alias("length"))
    ranged = nodes.repartitionByRange("owner", "depth").sortWithinPartitions("owner", "depth").select("node", "owner", "depth", "length")

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            lengths = batch.column(3).to_numpy()
            ends = at + np.cumsum(lengths)
            extra = [pa.array(np.full(len(lengths), part, np.int32)), pa.array(ends - lengths)]
            at = int(ends[-1]) if len(ends) else at
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["node", "owner", "depth", "length", "part", "inner"])

    schema = "node binary, owner bigint, depth bigint, length bigint, part int, inner bigint"
    local = Stored(ranged.mapInArrow(run, schema), "chat-nodes").df
    # One row for each partition bounds the window and the broadcast.
    sums = local.groupBy("part").agg(F.sum("length").alias("n"))
    sums = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return local.join(F.broadcast(sums), "part").select("node", "owner", "depth", "length", (F.col("base") + F.col("inner")).alias("at"))


def write_trees(conversations: DataFrame, folder: str) -> None:
    """Write the folder's tables: ``nodes`` in depth-first order and ``paths`` (conv, number, node).

    Nodes: tree (the root's node), at (start in the whole text of all trees, which follow each other),
    start (in its tree), length, position (its first position id), loss_start and loss_length (inside
    the segment), attends (intervals of the tree, ancestors only), segment.
    """
    made = paths(conversations)
    turns = made.df
    ranks = sorted_paths(turns.select("conv", "number", "node"))
    placed = Stored(layout(turns, ranks), "chat-layout").df
    narrow = turns.select("conv", "number", "node", "before").join(placed, "node")
    # Along every path, intervals grow turn by turn; a node is described by the conversation that owns it.
    owners = narrow.join(ranks, F.col("conv").eqNullSafe(F.col("of"))).select(
        "rank", "number", "node", "before", "owner", "at", "length"
    )

    def run(batches):
        path, root, intervals = object(), None, []
        for batch in batches:
            rows = []
            for rank, number, node, before, owner, at, length in zip(*[batch.column(k).to_pylist() for k in range(7)], strict=True):
                if rank != path:
                    path, root, intervals = rank, (node, at), []
                if owner == rank:
                    inside = [(b - root[1], e - root[1]) for b, e in intervals]
                    rows.append((node, root[0], at, at - root[1], length, before, [{"begin": b, "end": e} for b, e in inside]))
                if intervals and intervals[-1][1] == at:
                    intervals[-1] = (intervals[-1][0], at + length)
                else:
                    intervals.append((at, at + length))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4, span]
            names = ["node", "tree", "at", "start", "length", "position", "attends"]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    schema = "node binary, tree binary, at bigint, start bigint, length bigint, position bigint, attends array<struct<begin:bigint,end:bigint>>"
    described = _stream(owners, ["rank"], ["number"]).mapInArrow(run, schema)
    keepers = ranks.select(F.col("of").alias("keeper"), F.col("rank").alias("owner"))
    owned = placed.join(keepers, "owner").select(F.col("node").alias("n"), "keeper", "depth")
    same = F.col("conv").eqNullSafe(F.col("keeper")) & (F.col("number") == F.col("depth")) & (F.col("node") == F.col("n"))
    texts = turns.join(owned, same).select("node", "segment")
    opening = F.instr("segment", "\n")  # characters up to the newline after the role
    learned = F.col("segment").startswith(f"{START}{LEARNED}\n")
    loss = F.when(learned, F.length("segment") - opening - len(END)).otherwise(0)
    nodes = described.join(texts, "node").withColumns({"loss_start": opening, "loss_length": loss})
    nodes.repartitionByRange("at").sortWithinPartitions("at").write.option("compression", "zstd").parquet(f"{folder}/nodes")
    turns.select("conv", "number", "node").write.parquet(f"{folder}/paths")
    made.drop()


def read_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each conversation, from the written tables alone (see the query's contract)."""
    nodes = spark.read.parquet(f"{folder}/nodes").select("node", "segment", "loss_start", "loss_length")
    turns = _stream(spark.read.parquet(f"{folder}/paths").join(nodes, "node"), ["conv"], ["number"])

    def run(batches):
        state = None
        for batch in batches:
            out = []
            for conv, segment, begin, size in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                if state is None or state[0] != conv:
                    out += [finished(state)] if state else []
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if size:
                    learned = unescape(segment[begin : begin + size])
                    state[3] += len(learned)
                    state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(segment)
            yield from rows(out)
        yield from rows([finished(state)] if state else [])

    def finished(state):
        return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])

    def rows(out) -> Iterator[pa.RecordBatch]:
        if out:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return turns.select("conv", "segment", "loss_start", "loss_length").mapInArrow(run, schema)
