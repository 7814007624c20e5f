"""Personal data: patterns, and terms that give protected values away. DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Every distinct base value is a
protected entity. All words of a document co-occur with every entity that it mentions, however far
apart. Over all documents, the information a word gives about an entity is their pointwise mutual
information log(p(entity | word) / p(entity)); the entity's own information is -log p(entity). A word
whose share of that information reaches ``DISCLOSES`` gives the entity away and is generalised to a
class mark in the documents that mention the entity, wherever it stands in them; from ``REMOVED`` on it
is removed. Estimates need ``SUPPORT`` documents with two different texts at least. A word and an entity
are only paired if the numbers of their documents allow that share at all: a word of many more documents
than the entity's never reaches it, so frequent words make no pairs with rare entities.

The patterns are written so that no start is tried twice in a run of equal characters and no loop
backtracks: long runs of digits or letters take linear time and no stack.

Defined cases: null and empty texts have no spans; repeated rows and equal texts give equal spans,
except that every row counts as a document; overlapping base spans are all reported, and in the
cleaned text they are one mark, named by the first; positions are code points; an empty table gives
no rows; ``clean`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import Stored, text_or_empty

# The four kinds, in their order. Each pattern finds what the plain form in the comment
# finds from left to right; it only starts where a run of characters starts.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 12 to 19 digits: the whole chain or nothing
    "card": r"[0-9](?<![0-9][\x20-]?[0-9])(?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
TERM = "term"
GUARDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

# Spans and matches are walked in blocks of that many.
BLOCK = 256
SUPPORT = 3
DISCLOSES, REMOVED = 0.9, 0.97
WORD = r"\p{L}{3,}"
SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    backwards = F.reverse(_digits(value))

    def add(total: Column, k: Column) -> Column:
        d = F.substr(backwards, k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(backwards)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def in_blocks(items: Column, measure, combine, work) -> Column:
    """The arrays that ``work(block, before)`` makes of the blocks of a non-empty array, in a row.

    ``before`` combines the ``measure`` (an int) of all earlier blocks, 0 for the first. A walk that
    appends to its state copies the state at each step; inside short blocks that stays cheap, so the
    work grows with the array and not with its square.
    """

    def cut(all_items: Column) -> Column:
        last = F.floor((F.size(all_items) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_items, k * BLOCK + 1, BLOCK))

    def befores(measures: Column) -> Column:
        step = lambda done, m: F.concat(done, F.array(combine(F.element_at(done, -1), m)))
        return F.slice(F.aggregate(measures, F.array(F.lit(0)), step), 1, F.size(measures))

    made = lambda blocks: F.flatten(F.zip_with(blocks, befores(F.transform(blocks, measure)), work))
    return bound(items, lambda all_items: bound(cut(all_items), made))


def positions(text: Column, pattern: str, hits: Column, keep, kind: str, rank: int) -> Column:
    """Spans of the matches that ``keep`` accepts; gaps and matches in turn make up the text."""
    steps = F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    none = F.array().cast(f"array<{SPAN}>")
    ends = lambda at, step: at + F.length(step["gap"]) + F.coalesce(F.length(step["hit"]), F.lit(0))

    def add(state: Column, step: Column) -> Column:
        start, end = state["at"] + F.length(step["gap"]), ends(state["at"], step)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), step["hit"].alias("value"))
        wanted = step["hit"].isNotNull() & keep(step["hit"])
        found = F.when(wanted, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    spans = in_blocks(
        steps,
        lambda block: F.aggregate(block, F.lit(0), ends),
        lambda before, length: before + length,
        lambda block, before: F.aggregate(block, F.struct(before.alias("at"), none.alias("found")), add)["found"],
    )
    return F.when(F.size(hits) > 0, spans).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_base``, the valid base spans of the text by start and kind."""
    text = text_or_empty()
    hits = {}
    for kind, pattern in PATTERNS.items():
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        guard = text.contains(GUARDS[kind]) if GUARDS[kind] else None
        hits[f"_{kind}"] = found if guard is None else F.when(guard, found).otherwise(F.array().cast("array<string>"))
    rows = docs.withColumns(hits)
    spans = [positions(text, PATTERNS[k], F.col(f"_{k}"), lambda hit, k=k: _valid(k, hit), k, r) for r, k in enumerate(KINDS)]
    return rows.withColumn("_base", F.array_sort(F.concat(*spans))).drop(*hits)


def words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def entity(span: Column) -> Column:
    """A protected value: e-mail addresses without case, numbers without their marks."""
    plain = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
    return F.concat(span["kind"], F.lit(":"), plain)


def mentions(marked: DataFrame) -> DataFrame:
    """(row, content, entity): each entity once for a row that mentions it."""
    named = F.array_distinct(F.transform("_base", entity))
    found = marked.where(F.size("_base") > 0)
    return found.select("row", F.xxhash64("text").alias("content"), F.explode(named).alias("entity"))


def row_words(marked: DataFrame) -> DataFrame:
    """(row, term): each word once for a row that mentions any entity."""
    return marked.where(F.size("_base") > 0).select("row", F.explode(words(F.col("text"))).alias("term"))


def disclosing(marked: DataFrame, known: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, removed) for the pairs in which the term gives the entity away.

    ``marked`` has (row, text, _base) for the documents with base spans, ``known`` the mentions of entities
    with ``SUPPORT`` documents and their number, ``docs`` is the whole corpus.
    """
    used = docs.select(F.explode(words(text_or_empty())).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("term_docs"))
    used = used.where(F.col("term_docs") >= SUPPORT)
    total = F.lit(float(max(docs.count(), 1)))
    # The share is greatest if the term stands in all documents of the entity; a little more for rounding.
    most = 1.001 * F.pow(F.col("entity_docs").cast("double"), F.lit(DISCLOSES)) * F.pow(total, F.lit(1 - DISCLOSES))
    reach = known.select("row", "content", "entity", "entity_docs", most.alias("most"))
    pairs = row_words(marked).join(used, "term").join(reach, "row").where(F.col("term_docs") <= F.col("most"))
    joint = (
        pairs.groupBy("entity", "term", "entity_docs", "term_docs")
        .agg(F.count(F.lit(1)).alias("joint"), F.min("content").alias("x"), F.max("content").alias("y"))
        .where((F.col("joint") >= SUPPORT) & (F.col("x") != F.col("y")))
    )
    own = F.log(total / F.col("entity_docs"))
    gained = F.log(F.col("joint") * total / (F.col("term_docs") * F.col("entity_docs")))
    rated = joint.withColumn("share", F.when(own > 0, gained / own).otherwise(0.0))
    return rated.where(F.col("share") >= DISCLOSES).select("entity", "term", (F.col("share") >= REMOVED).alias("removed"))


def with_terms(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """``marked`` with ``_spans``: its base spans and the spans of disclosing terms.

    ``marked`` (row, text, _base, any others) is a stored table; its texts may be null without spans.
    """
    named = mentions(marked)
    entities = named.groupBy("entity").agg(F.count(F.lit(1)).alias("entity_docs")).where(F.col("entity_docs") >= SUPPORT)
    known = Stored(named.join(entities, "entity"), "private-mentions").df
    found = Stored(disclosing(marked, known, docs), "private-terms").df
    pairs = row_words(marked).join(found, "term").join(known.select("row", "entity"), ["row", "entity"])
    by_row = pairs.groupBy("row").agg(
        F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("_gone"), F.collect_set("term").alias("_terms")
    )
    rows = marked.join(by_row, "row", "left")
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("_words", F.when(F.col("_terms").isNotNull(), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).otherwise(none))
    listed = positions(text, WORD, F.col("_words"), lambda w: F.array_contains("_terms", F.lower(w)), TERM, len(KINDS))
    outside = F.filter(listed, lambda t: ~F.exists("_base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    return rows.withColumn("_spans", F.array_sort(F.concat("_base", outside))).drop("_words", "_terms")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the base spans' digest and all spans for each row."""
    found = base_spans(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    kept = F.when(F.size("_base") > 0, F.col("text"))
    marked = Stored(found.select("doc_id", kept.alias("text"), "_base", F.monotonically_increasing_id().alias("row")), "private-rows").df
    kinds = F.transform("_base", lambda s: s["kind"])
    counts = [(F.size("_base") - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in KINDS]
    digest = F.sha2(F.encode(listed(F.col("_base")), "UTF-8"), 256).alias("base_sha256")
    return with_terms(marked, docs).select("doc_id", *counts, digest, listed(F.col("_spans")).alias("spans"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced: base values and generalised terms by marks in capitals,
    removed terms by nothing. Texts without spans stay as they are, null texts too."""
    named = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    held = docs.select("text", F.struct(F.lit(0).alias("_"), *named).alias("others"))
    marked = base_spans(held).withColumn("row", F.monotonically_increasing_id())
    marked = Stored(marked, "private-documents").df
    text = F.coalesce("text", F.lit(""))

    latest = lambda at, span: F.greatest(at, span["end"])

    def pieces(block: Column, before: Column) -> Column:
        """Marks and the texts between them, from the end of the earlier spans to that of the block's."""
        length = F.aggregate(block, before, latest) - before

        def walk(part: Column) -> Column:
            def step(state: Column, span: Column) -> Column:
                gone = (span["kind"] == TERM) & F.coalesce(F.array_contains("_gone", F.lower(span["value"])), F.lit(False))
                mark = F.when(gone, "").otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
                between = F.substr(part, state["at"] - before + 1, span["start"] - state["at"])
                more = F.concat(state["out"], F.array(F.concat(between, mark)))
                out = F.when(span["start"] >= state["at"], more).otherwise(state["out"])
                return F.struct(latest(state["at"], span).alias("at"), out.alias("out"))

            empty = F.struct(before.alias("at"), F.array().cast("array<string>").alias("out"))
            return F.aggregate(block, empty, step)["out"]

        return bound(F.substr(text, before + 1, length), walk)

    ends = lambda block: F.aggregate(block, F.lit(0), latest)
    walked = F.array_join(in_blocks(F.col("_spans"), ends, lambda a, b: F.greatest(a, b), pieces), "")
    rest = F.substr(text, ends(F.col("_spans")) + 1, F.length(text))
    cleaned = F.when(F.size("_spans") > 0, F.concat(walked, rest)).otherwise(F.col("text"))
    rows = with_terms(marked, docs).withColumn("_clean", cleaned)
    return rows.select(*[(F.col("_clean") if c == "text" else F.col(f"others.`{c}`")).alias(c) for c in docs.columns])
