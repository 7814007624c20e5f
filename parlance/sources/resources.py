"""Readers for resource trees of many mods: manifests, language XML, line pools.

Layout: ``<base>/<mod dir>[/<version>]/Languages/<language>/<domain>/...`` and
``<base>/<mod dir>/About/About.xml``. Files are listed and read by Spark; a file is parsed where it
was read, and only parsed rows are exchanged.
"""

from __future__ import annotations

import codecs
import fnmatch
import re
from collections.abc import Callable, Iterable, Iterator
from io import BytesIO
from itertools import chain
from typing import BinaryIO
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from parlance import schemas
from parlance.functions.keys import parse_resource_path
from parlance.functions.text import strip
from parlance.operators.merging import last_value_in_file, merge_keyed_files, union_domains
from parlance.sources.pack_sink import file_system, qualified
from parlance.sources.workdir import stored

# Files up to this many bytes are read once; larger ones are streamed as often as they are needed.
WHOLE = 1 << 20
# What a batch of parsed rows holds at most, beyond its last row.
ROWS_AT_ONCE, CHARS_AT_ONCE = 10_000, 4_000_000


# ---- listing -------------------------------------------------------------------------------------


def _alternatives(pattern: str) -> list[str]:
    """A pattern with its braces written out."""
    found = re.search(r"\{([^{}]*)\}", pattern)
    if not found:
        return [pattern]
    head, tail = pattern[: found.start()], pattern[found.end() :]
    return [p for part in found[1].split(",") for p in _alternatives(head + part + tail)]


def _is_pattern(name: str) -> bool:
    return any(c in name for c in "*?[")


def _hidden(name: str) -> bool:
    """The names that Spark's own readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _is_file(found: fs.FileInfo) -> bool:
    """Spark's own readers see no empty files."""
    return found.type == fs.FileType.File and found.size > 0


def _children(target: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return target.get_file_info(fs.FileSelector(folder, allow_not_found=True))


def _walk(target: fs.FileSystem, path: str) -> Iterator[str]:
    """The file of that path, or all files below the folder; one folder is listed at a time."""
    found = target.get_file_info(path)
    if _is_file(found):
        yield path
    waiting = [path] if found.type == fs.FileType.Directory else []
    while waiting:
        for child in _children(target, waiting.pop()):
            if _hidden(child.base_name):
                continue
            if child.type == fs.FileType.Directory:
                waiting.append(child.path)
            elif _is_file(child):
                yield child.path


def _match(target: fs.FileSystem, folder: str, steps: list[str]) -> Iterator[fs.FileInfo]:
    """What matches ``steps``, name by name, below a folder."""
    for k, step in enumerate(steps):
        if _is_pattern(step):
            for child in _children(target, folder):
                if not fnmatch.fnmatchcase(child.base_name, step):
                    continue
                if k + 1 == len(steps):
                    yield child
                elif child.type == fs.FileType.Directory:
                    yield from _match(target, child.path, steps[k + 1 :])
            return
        folder = f"{folder.rstrip('/')}/{step}"
    yield target.get_file_info(folder)


def _tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _listed(paths: DataFrame, place: str, found: Callable[[fs.FileSystem, str], Iterable[str]]) -> DataFrame:
    """What ``found`` lists for every path below ``place``, dealt over the tasks by count."""
    names = pa.schema([("path", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = file_system(place)
        rows = ((place + p[len(root) :],) for b in batches for q in b.column("path").to_pylist() for p in found(target, root + q[len(place) :]))
        yield from _batches(rows, names)

    # The number is given: what is dealt is names, so the size of the exchange says nothing of the work.
    return paths.mapInArrow(run, "path string").repartition(_tasks(paths.sparkSession))


def _folders(spark: SparkSession, pattern: str, kinds=(fs.FileType.Directory,)) -> tuple[DataFrame, str]:
    """(path) of the folders that match a pattern without braces, and the place they all lie below.

    The tree is listed by tasks, and no name reaches the driver. The start is an RDD, whose size the
    planner does not know: it must not take what is read from the files for small.
    """
    parts = pattern.rstrip("/").split("/")
    first = next((k for k, part in enumerate(parts) if _is_pattern(part)), len(parts))
    place, steps = qualified(spark, "/".join(parts[:first]) or "/").rstrip("/"), parts[first:]
    place = place.replace("file:///", "file:/", 1)  # as Spark names files
    start = spark.createDataFrame(spark.sparkContext.parallelize([(place,)], 1), "path string")

    def found(target: fs.FileSystem, folder: str) -> Iterator[str]:
        hits = _match(target, folder, steps) if steps else [target.get_file_info(folder)]
        return (x.path for x in hits if x.type in kinds)

    return _listed(start, place, found), place


def _files(spark: SparkSession, base: str, tails: list[str], suffix: str | None = None) -> list[tuple[DataFrame, str]]:
    """(path) of the files below every mod of ``base`` that match one of ``tails``, with their place.

    With a ``suffix`` the tails name folders, and all their files of that ending are taken, at any depth.
    """

    def found(target: fs.FileSystem, mod: str) -> Iterator[str]:
        hits = chain.from_iterable(_match(target, mod, tail.split("/")) for tail in tails)
        if suffix is None:
            return (x.path for x in hits if _is_file(x) and not _hidden(x.base_name))
        return (p for x in hits for p in _walk(target, x.path) if p.endswith(f".{suffix}"))

    mods = (_folders(spark, f"{pattern}/*") for pattern in _alternatives(base))
    return [(_listed(paths, place, found), place) for paths, place in mods]


def list_resources(spark: SparkSession, base: str) -> DataFrame:
    """Paths below ``base``, from the listing alone: no file is opened."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(base)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        spark.read.format("binaryFile").load(base)  # there is no such path, as Spark will say

    def below(target: fs.FileSystem, path: str) -> Iterator[str]:
        found = target.get_file_info(path)
        hits = [found] if found.type == fs.FileType.File else _children(target, path)
        return (x.path for x in hits if not _hidden(x.base_name))

    kinds = (fs.FileType.Directory, fs.FileType.File)
    trees = (_folders(spark, pattern, kinds) for pattern in _alternatives(base))
    parts = [_listed(_listed(paths, place, below), place, _walk) for paths, place in trees]
    return _all(parts)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ---- parsing -------------------------------------------------------------------------------------


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size, whatever files they come from."""
    held, chars = [], 0

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if type(x) is str)
        if len(held) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


# Opens the bytes of one file, as often as it is called.
Source = Callable[[], BinaryIO]
# (path, source) to the rows of one file.
Parse = Callable[[str, Source], Iterator[tuple]]


def _source(target: fs.FileSystem, path: str) -> Source:
    with target.open_input_stream(path, compression=None) as stream:
        content = stream.read(WHOLE + 1)
    if len(content) <= WHOLE:
        return lambda: BytesIO(content)
    return lambda: target.open_input_stream(path, compression=None)


def _read(files: list[tuple[DataFrame, str]], parse: Parse, schema: str | StructType) -> DataFrame:
    """The rows of listed files, each parsed by one task that holds no more of it than a batch."""

    def reader(place: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            target, root = file_system(place)
            paths = (p for b in batches for p in b.column("path").to_pylist())
            yield from _batches((r for p in paths for r in parse(p, _source(target, root + p[len(place) :]))), names)

        return run

    names = _arrow(schema)
    return _all([paths.mapInArrow(reader(place), schema) for paths, place in files])


def _parsed(files: DataFrame, parse: Parse, schema: str | StructType) -> DataFrame:
    """The rows of files that come as (path, content)."""
    names = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((p.as_py(), c.as_py()) for b in batches for p, c in zip(b.column("path"), b.column("content"), strict=True))
        yield from _batches((r for path, content in pairs for r in parse(path, lambda: BytesIO(content))), names)

    return files.mapInArrow(run, schema)


def _arrow(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


class _Nothing:
    """A parser's target that keeps nothing."""


def check_xml(source: Source) -> None:
    """Read a file through once; raises what is wrong with it."""
    parser = ElementTree.XMLParser(target=_Nothing())
    with source() as stream:
        while chunk := stream.read(WHOLE):
            parser.feed(chunk)
    parser.close()


def _language_parser(keep_markup: bool) -> Parse:
    def value(node: ElementTree.Element) -> str:
        text = node.text or ""
        if keep_markup:
            text += "".join(ElementTree.tostring(child, encoding="unicode") for child in node)
        return text

    def elements(stream: BinaryIO) -> Iterator[tuple[str, str]]:
        depth, root = 0, None
        for event, node in ElementTree.iterparse(stream, events=("start", "end")):
            if event == "start":
                root = node if root is None else root
                depth += 1
                continue
            depth -= 1
            if depth == 1:
                yield node.tag, value(node)
                root.clear()

    def parse(path: str, source: Source) -> Iterator[tuple]:
        try:
            check_xml(source)
        except ElementTree.ParseError as exc:
            yield path, None, None, None, str(exc)
            return
        with source() as stream:
            for pos, (key, text) in enumerate(elements(stream)):
                yield path, pos, key, text, None

    return parse


def parse_language_xml(files: DataFrame, keep_markup: bool = False) -> DataFrame:
    """(path, content) to one row per element, or one error row for a malformed file.

    The value is the text before the first child element, untrimmed, "" when there is none;
    ``keep_markup`` keeps inner elements as text instead. A file is read through once before any of
    its rows is given, and its elements are held one at a time.
    """
    return _parsed(files, _language_parser(keep_markup), schemas.ENTRIES)


def read_mods(spark: SparkSession, base: str) -> DataFrame:
    """mod_dir, mod_id, name, supported_versions; unusable manifests keep a reason in ``error``."""

    def parse(path: str, source: Source) -> Iterator[tuple]:
        try:
            with source() as stream:
                root = ElementTree.fromstring(stream.read())
        except ElementTree.ParseError as exc:
            yield path, None, None, [], f"malformed manifest: {exc}"
            return
        texts = [root.findtext(tag, default="") for tag in ("packageId", "name")]
        versions = [li.text or "" for li in root.iterfind("supportedVersions/li")]
        yield path, *texts, versions, None

    parsed = _read(_files(spark, base, ["About/About.xml"]), parse, schemas.MANIFESTS).withColumns(
        {"mod_id": strip("mod_id"), "name": strip("name")}
    )
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("mod_id") == "", "missing package id")
        .when(F.col("name") == "", "missing name")
    )
    versions = F.filter(F.transform("supported_versions", strip), lambda v: v != "")
    return parsed.select(
        F.regexp_extract("path", r"([^/]+)/About/About\.xml$", 1).alias("mod_dir"),
        "mod_id",
        "name",
        versions.alias("supported_versions"),
        reason.alias("error"),
    )


def resolve_content_root(
    paths: DataFrame, version: str = schemas.DEFAULT_GAME_VERSION
) -> DataFrame:
    """Per mod dir: ``<version>/Languages`` beats ``Languages``; neither is an error row.

    ``paths`` has one row per listed file with ``mod_dir`` and ``path``.
    """
    below = F.concat(F.lit("/"), F.col("mod_dir"))
    at_root = F.contains("path", F.concat(below, F.lit("/Languages/")))
    scoped = F.contains("path", F.concat(below, F.lit(f"/{version}/Languages/")))
    root = F.when(scoped, version).when(at_root, "")
    return (
        paths.groupBy("mod_dir")
        .agg(F.max(root).alias("content_root"))
        .select(
            "mod_dir",
            "content_root",
            F.when(F.col("content_root").isNull(), "no Languages folder").alias("error"),
        )
    )


def _with_place(entries: DataFrame) -> DataFrame:
    place = parse_resource_path("path")
    return entries.withColumn("_p", place).select(
        F.col("_p.mod_dir").alias("mod_dir"),
        F.coalesce("_p.version", F.lit("")).alias("content_root"),
        F.col("_p.def_type").alias("def_type"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        *[c for c in entries.columns if c != "path"],
    )


def _tails(language: str, version: str, tail: str) -> list[str]:
    return [f"{root}/{language}/{tail}" for root in ("Languages", f"{version}/Languages")]


def read_keyed(
    spark: SparkSession,
    base: str,
    language: str = schemas.SOURCE_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
    keep_markup: bool = False,
) -> DataFrame:
    """Raw Keyed entries (mod_dir, content_root, file, pos, key, value) and error rows."""
    files = _files(spark, base, _tails(language, version, "Keyed/*.xml"))
    return _with_place(_read(files, _language_parser(keep_markup), schemas.ENTRIES)).drop("def_type")


def read_definjected(
    spark: SparkSession,
    base: str,
    language: str = schemas.SOURCE_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
    keep_markup: bool = False,
) -> DataFrame:
    """As ``read_keyed``; the def type is the name of the parent folder."""
    files = _files(spark, base, _tails(language, version, "DefInjected/*/*.xml"))
    return _with_place(_read(files, _language_parser(keep_markup), schemas.ENTRIES))


def read_string_pools(
    spark: SparkSession,
    base: str,
    language: str = schemas.SOURCE_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
) -> DataFrame:
    """Pool lines addressed by (mod_dir, file, idx), idx counting from 0."""

    def pieces(path: str, source: Source) -> Iterator[tuple]:
        """Whole lines of a file, a bounded part of it at a time, with the index of the first."""
        # A file that is not UTF-8 is set aside as one row with an error and no line.
        decoder = codecs.getincrementaldecoder("utf-8")()
        try:
            with source() as stream:
                while chunk := stream.read(WHOLE):
                    decoder.decode(chunk)
            decoder.decode(b"", final=True)
        except UnicodeDecodeError:
            yield path, "not UTF-8", 0, None
            return
        rest, first = b"", 0
        with source() as stream:
            while chunk := stream.read(WHOLE):
                rest += chunk
                cut = rest.rfind(b"\n") + 1
                if cut:
                    yield path, None, first, rest[:cut].decode()
                    first += rest.count(b"\n", 0, cut)
                    rest = rest[cut:]
        if rest or not first:
            yield path, None, first, rest.decode()

    parts = _read(_files(spark, base, _tails(language, version, "Strings/*.txt")), pieces, "path string, error string, first int, text string")
    lines = number_pool_lines(parts, ["path", "error", "first"]).withColumn("idx", F.col("first") + F.col("idx"))
    return _with_place(lines.drop("first")).drop("def_type")


def number_pool_lines(files: DataFrame, identity: list[str], text: str = "text") -> DataFrame:
    """Line index per file; a newline at the end of a file opens no further line."""
    body = F.regexp_replace(text, r"\r?\n\z", "")
    return files.select(*identity, F.posexplode_outer(F.split(body, r"\r?\n")).alias("idx", "line"))


def live_roots(spark: SparkSession, base: str, version: str, listed: DataFrame | None = None) -> DataFrame:
    """(mod_dir, content_root) of every mod that has one; ``listed`` is what ``list_resources`` found."""
    listed = list_resources(spark, base) if listed is None else listed
    paths = listed.withColumn("mod_dir", parse_resource_path("path")["mod_dir"])
    roots = resolve_content_root(paths.filter("mod_dir is not null"), version)
    return roots.filter("error is null").drop("error")


def language_entries(
    spark: SparkSession,
    base: str,
    language: str,
    version: str = schemas.DEFAULT_GAME_VERSION,
    listed: DataFrame | None = None,
) -> DataFrame:
    """All entries of a language in all domains: mod_id, domain, def_type, key_path, value, file, idx.

    Mod ids come from the manifests, and a mod's files from its resolved content root only. Merge
    rules: the last value of a key in a file, then the first file in order. ``file`` is the source
    file without its ending and ``idx`` a pool line's index, where the domain's packs need them.
    """
    mods = read_mods(spark, base).filter("error is null").select("mod_dir", "mod_id")
    # Stored: found once for all domains, and the planner sees that it is small.
    live = stored(live_roots(spark, base, version, listed).join(mods, "mod_dir"), "live-mods")

    def placed(entries: DataFrame) -> DataFrame:
        return entries.filter("error is null").join(live, ["mod_dir", "content_root"]).drop("mod_dir")

    def shaped(df: DataFrame, domain: str, def_type, key, value, file, idx) -> DataFrame:
        return df.select(
            "mod_id",
            F.lit(domain).alias("domain"),
            def_type.cast("string").alias("def_type"),
            key.alias("key_path"),
            value.alias("value"),
            file.cast("string").alias("file"),
            idx.cast("bigint").alias("idx"),
        )

    null, stem = F.lit(None), F.regexp_replace("file", r"\.[^.]+$", "")
    keyed = merge_keyed_files(placed(read_keyed(spark, base, language, version)))
    defs = placed(read_definjected(spark, base, language, version))
    last = last_value_in_file(defs.withColumn("mod_id", F.struct("mod_id", "def_type")))
    first = last.groupBy("mod_id", "key").agg(F.min_by(F.struct("value", "file"), "file").alias("_v"))
    first = first.select("mod_id.mod_id", "mod_id.def_type", "key", "_v.value", "_v.file")
    pools = placed(read_string_pools(spark, base, language, version))
    address = F.concat("file", F.lit("#"), F.col("idx").cast("string"))
    return union_domains(
        shaped(keyed, "Keyed", null, F.col("key"), F.col("value"), null, null),
        shaped(first, "DefInjected", F.col("def_type"), F.col("key"), F.col("value"), stem, null),
        shaped(pools, "Strings", null, address, F.col("line"), stem, F.col("idx")),
    )


def merged_strings(
    spark: SparkSession,
    base: str,
    language: str = schemas.SOURCE_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
    field_table: DataFrame | None = None,
) -> DataFrame:
    """The source strings of all mods and domains, with what ``Defs/`` implies where a mod has no English."""
    listed = stored(list_resources(spark, base), "listed")
    shipped = language_entries(spark, base, language, version, listed).withColumnRenamed("value", "source_text")
    return shipped.unionByName(inferred_strings(spark, base, language, version, field_table, listed))


def read_existing_translations(
    spark: SparkSession,
    base: str,
    language: str = schemas.TARGET_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
) -> DataFrame:
    """What the target language folders already hold, in one table keyed like strings."""
    found = language_entries(spark, base, language, version)
    return found.select("mod_id", "domain", "def_type", "key_path", F.col("value").alias("translation"))


DEF_FIELDS = "path string, pos bigint, def_type string, key_path string, value string, error string"


def def_fields(content: bytes | BinaryIO) -> Iterator[tuple[str, str, str]]:
    """(def type, dotted field path, text) of every text field of a Defs file, one Def in memory at a time.

    Paths begin with the Def's name; a list item is named by its position among its siblings. Defs
    that are abstract or have no name cannot be addressed and are passed over.
    """
    path: list[str] = []  # names below the Def
    items: list[int] = []  # list items met so far, by depth
    nested: list[bool] = []  # whether an element holds elements
    fields: list[tuple[str, str]] = []
    name, root = None, None
    stream = BytesIO(content) if isinstance(content, bytes) else content
    for event, node in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            if root is None:
                root = node
                continue
            if nested:
                nested[-1] = True
                step = node.tag
                if step == "li":
                    step, items[-1] = str(items[-1]), items[-1] + 1
                path.append(step)
            items.append(0)
            nested.append(False)
        elif nested:
            items.pop()
            leaf = not nested.pop()
            if not nested:  # the Def itself ends
                if name and node.get("Abstract", "").lower() != "true":
                    yield from ((node.tag, f"{name}.{field}", text) for field, text in fields)
                fields, name = [], None
                root.clear()
                continue
            if leaf and (node.text or "").strip():
                if path == ["defName"]:
                    name = node.text.strip()
                else:
                    fields.append((".".join(path), node.text))
            path.pop()


def _def_rows(path: str, source: Source) -> Iterator[tuple]:
    try:
        check_xml(source)
    except ElementTree.ParseError as exc:
        yield path, None, None, None, None, str(exc)
        return
    with source() as stream:
        for pos, row in enumerate(def_fields(stream)):
            yield path, pos, *row, None


def parse_defs(files: DataFrame) -> DataFrame:
    """(path, content) to one row per text field, or one error row for a malformed file.

    A file is read through once before any of its rows is given, so a bad one gives no fields; rows
    are given in parts, so no file's fields are ever held together.
    """
    return _parsed(files, _def_rows, DEF_FIELDS)


def _defs_place(version: str) -> tuple[dict, str]:
    place = rf"([^/]+)(?:/({re.escape(version)}))?/Defs/(.+)\.xml$"
    return {"mod_dir": F.regexp_extract("path", place, 1), "content_root": F.regexp_extract("path", place, 2)}, place


def read_defs(spark: SparkSession, base: str, version: str = schemas.DEFAULT_GAME_VERSION) -> DataFrame:
    """Text fields of all Defs files: mod_dir, content_root, file, pos, def_type, key_path, value, error."""
    names, place = _defs_place(version)
    files = _files(spark, base, ["Defs", f"{version}/Defs"], "xml")
    rows = _read(files, _def_rows, DEF_FIELDS).withColumns(names | {"file": F.replace(F.regexp_extract("path", place, 3), F.lit("/"), F.lit("_"))})
    return rows.select("mod_dir", "content_root", "file", "pos", "def_type", "key_path", "value", "error")


def mods_with_language(
    spark: SparkSession,
    base: str,
    language: str = schemas.SOURCE_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
    listed: DataFrame | None = None,
) -> DataFrame:
    """mod_dir of the mods that ship files of a language under their content root; no file is opened."""
    listed = list_resources(spark, base) if listed is None else listed
    found = listed.select(parse_resource_path("path").alias("_p")).filter(F.col("_p.language") == language)
    found = found.select("_p.mod_dir", F.coalesce("_p.version", F.lit("")).alias("content_root"))
    live = live_roots(spark, base, version, listed)
    return found.join(live, ["mod_dir", "content_root"], "left_semi").select("mod_dir").distinct()


def inferred_strings(
    spark: SparkSession,
    base: str,
    language: str = schemas.SOURCE_LANGUAGE,
    version: str = schemas.DEFAULT_GAME_VERSION,
    field_table: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> DataFrame:
    """DefInjected strings that ``Defs/`` implies for mods without files of the language.

    A mod's ``<version>/Defs`` beats its ``Defs``. A field given twice has its last value in the first
    file, as merged DefInjected files have. The tree is listed once, into a table; what is known by mod
    is stored, too, so that the planner sees that it is small and leaves the fields where they are.
    """
    listed = stored(list_resources(spark, base), "listed") if listed is None else listed
    mods = read_mods(spark, base).filter("error is null").select("mod_dir", "mod_id")
    placed = listed.select(*[c.alias(n) for n, c in _defs_place(version)[0].items()])
    roots = placed.filter("mod_dir <> ''").groupBy("mod_dir").agg(F.max("content_root").alias("content_root"))
    homes = stored(roots.join(mods, "mod_dir"), "defs-roots")
    fields = read_defs(spark, base, version).filter("error is null").join(homes, ["mod_dir", "content_root"])
    with_language = stored(mods_with_language(spark, base, language, version, listed), "with-language")
    fields = infer_from_defs(fields, field_table, with_language)
    first = fields.groupBy("mod_id", "def_type", "key_path").agg(
        F.min_by(F.struct("value", "file"), F.struct("file", -F.col("pos"))).alias("_v")
    )
    return first.select(
        "mod_id",
        F.lit("DefInjected").alias("domain"),
        "def_type",
        "key_path",
        F.col("_v.value").alias("source_text"),
        F.col("_v.file").alias("file"),
        F.lit(None).cast("bigint").alias("idx"),
    )


# Field paths that hold text, for every Def type; N stands for a list index.
TRANSLATABLE_FIELDS = ("label", "description", "labelFemale", "stages.N.label")


def infer_from_defs(def_fields: DataFrame, field_table=None, with_language: DataFrame | None = None) -> DataFrame:
    """Keep the translatable fields of mods that ship no English.

    ``field_table`` (def_type, field_pattern) extends the built-in paths; its size decides whether
    it is broadcast. ``with_language`` holds the mod_dir of the mods that have English and so are
    left out; without it every field's mod counts as one that has none.
    """
    pattern = F.regexp_replace(
        F.regexp_extract("key_path", r"^[^.]+\.(.+)$", 1), r"(^|\.)[0-9]+(?=\.|$)", "$1N"
    )
    fields = def_fields.withColumn("field_pattern", pattern)
    if with_language is not None:
        fields = fields.join(with_language.select("mod_dir"), "mod_dir", "left_anti")
    known = F.col("field_pattern").isin(*TRANSLATABLE_FIELDS)
    if field_table is None:
        return fields.filter(known)
    extra = field_table.select("def_type", "field_pattern").distinct().withColumn("_x", F.lit(1))
    return (
        fields.join(extra, ["def_type", "field_pattern"], "left")
        .filter(known | F.col("_x").isNotNull())
        .drop("_x")
    )
