"""Readers and writers on small trees, from manifest to pack and back."""

from __future__ import annotations

import tracemalloc
from pathlib import Path
from xml.etree import ElementTree

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parlance.operators import gates, providers
from parlance.operators.quality import RunAborted
from parlance.plans import flows
from parlance.sources import datasets, packs, resources

MANIFEST = "<ModMetaData><packageId> {id} </packageId><name>{name}</name><supportedVersions><li>1.6</li><li> </li></supportedVersions></ModMetaData>"


def put(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def keyed(**entries: str) -> str:
    body = "".join(f"<{k}>{v}</{k}>" for k, v in entries.items())
    return f"<LanguageData>{body}</LanguageData>"


@pytest.fixture
def mods(tmp_path):
    base = tmp_path / "mods"
    put(base / "a/About/About.xml", MANIFEST.format(id="test.a", name="Mod A"))
    put(base / "a/Languages/English/Keyed/A.xml", "<LanguageData><!-- c --><K>old</K><K>first</K><E/></LanguageData>")
    put(base / "a/Languages/English/Keyed/B.xml", keyed(K="second", L="{0} went <b>home</b>"))
    put(base / "a/Languages/English/Keyed/Bad.xml", "<LanguageData><K>")
    put(base / "a/Languages/English/Keyed/sub/Deep.xml", keyed(Deep="not read"))
    put(base / "b/About/About.xml", MANIFEST.format(id="test.b", name="Mod B"))
    put(base / "b/Languages/English/Keyed/A.xml", keyed(Root="hidden by the version folder"))
    put(base / "b/1.6/Languages/English/Keyed/A.xml", keyed(Scoped=" padded "))
    put(base / "c/About/About.xml", MANIFEST.format(id=" ", name="No id"))
    put(base / "d/About/About.xml", "<ModMetaData>")
    put(base / "e/About/About.xml", MANIFEST.format(id="test.e", name="No languages"))
    return str(base)


def test_manifests(spark, mods):
    found = {r["mod_dir"]: r for r in resources.read_mods(spark, mods).collect()}
    assert found["a"]["mod_id"] == "test.a" and found["a"]["supported_versions"] == ["1.6"]
    assert found["c"]["error"] == "missing package id"
    assert found["d"]["error"].startswith("malformed manifest")


def test_keyed_entries_and_bad_files(spark, mods):
    rows = resources.read_keyed(spark, mods)
    bad = rows.filter("error is not null").collect()
    assert [(r["mod_dir"], r["file"]) for r in bad] == [("a", "Bad.xml")]
    a = {(r["file"], r["pos"]): (r["key"], r["value"]) for r in rows.filter("mod_dir = 'a' and error is null").collect()}
    assert a == {
        ("A.xml", 0): ("K", "old"),
        ("A.xml", 1): ("K", "first"),
        ("A.xml", 2): ("E", ""),
        ("B.xml", 0): ("K", "second"),
        ("B.xml", 1): ("L", "{0} went "),
    }
    kept = resources.read_keyed(spark, mods, keep_markup=True).filter("key = 'L'").first()
    assert kept["value"] == "{0} went <b>home</b>"


def test_missing_folder_gives_no_rows(spark, mods):
    assert resources.read_keyed(spark, mods, language="Klingon").count() == 0
    assert resources.read_string_pools(spark, mods).count() == 0


def test_merge_rules_and_content_root(spark, mods):
    merged = {(r["mod_id"], r["key_path"]): r["source_text"] for r in resources.merged_strings(spark, mods).collect()}
    assert merged == {
        ("test.a", "K"): "first",
        ("test.a", "E"): "",
        ("test.a", "L"): "{0} went ",
        ("test.b", "Scoped"): " padded ",
    }


DEFS = """<?xml version="1.0" encoding="utf-8"?>
<Defs>
  <ThingDef ParentName="Base"><label>axe &amp; co</label><defName> Axe </defName>
    <stages><li><label>one</label></li><!-- c --><li><label>two</label><steps><li> a</li><li>b</li></steps></li></stages>
    <labelFemale/><description>   </description><mixed>text<b>x</b></mixed>
  </ThingDef>
  <ThingDef Abstract="true"><defName>Base</defName><label>never</label></ThingDef>
  <Own.GeneDef><label>no name</label></Own.GeneDef>
  <Own.GeneDef><defName>G</defName><description>dd</description></Own.GeneDef>
</Defs>"""


def test_def_fields_are_dotted_paths_with_list_positions():
    assert list(resources.def_fields(DEFS.encode())) == [
        ("ThingDef", "Axe.label", "axe & co"),
        ("ThingDef", "Axe.stages.0.label", "one"),
        ("ThingDef", "Axe.stages.1.label", "two"),
        ("ThingDef", "Axe.stages.1.steps.0", " a"),
        ("ThingDef", "Axe.stages.1.steps.1", "b"),
        ("ThingDef", "Axe.mixed.b", "x"),
        ("Own.GeneDef", "G.description", "dd"),
    ]
    assert list(resources.def_fields(b"<Defs/>")) == []


def test_defs_speak_for_mods_without_english(spark, mods):
    base = Path(mods)
    for mod in ("a", "e"):  # a has English, e has no languages at all
        put(base / mod / "Defs/Things/T.xml", DEFS)
        put(base / mod / "Defs/Bad.xml", DEFS.replace("</Defs>", "<Open></Defs>"))
    put(base / "d/Defs/T.xml", DEFS)  # without a usable manifest
    rows = resources.read_defs(spark, mods)
    bad = rows.filter("error is not null").collect()
    assert sorted((r["mod_dir"], r["file"], r["key_path"]) for r in bad) == [("a", "Bad", None), ("e", "Bad", None)]
    assert rows.filter("error is null").count() == 3 * 7
    extra = spark.createDataFrame([("ThingDef", "stages.N.steps.N")], "def_type string, field_pattern string")
    found = resources.merged_strings(spark, mods, field_table=extra).filter("domain = 'DefInjected'").collect()
    assert sorted((r["mod_id"], r["def_type"], r["key_path"], r["source_text"], r["file"]) for r in found) == [
        ("test.e", "Own.GeneDef", "G.description", "dd", "Things_T"),
        ("test.e", "ThingDef", "Axe.label", "axe & co", "Things_T"),
        ("test.e", "ThingDef", "Axe.stages.0.label", "one", "Things_T"),
        ("test.e", "ThingDef", "Axe.stages.1.label", "two", "Things_T"),
        ("test.e", "ThingDef", "Axe.stages.1.steps.0", " a", "Things_T"),
        ("test.e", "ThingDef", "Axe.stages.1.steps.1", "b", "Things_T"),
    ]
    put(base / "e/1.6/Defs/New.xml", "<Defs><ThingDef><defName>N</defName><label>new</label></ThingDef></Defs>")
    found = resources.inferred_strings(spark, mods).collect()
    assert [(r["mod_id"], r["key_path"]) for r in found] == [("test.e", "N.label")]


def test_content_root_without_languages_is_an_error_row(spark):
    paths = spark.createDataFrame([("e", "/m/e/About/About.xml")], "mod_dir string, path string")
    assert resources.resolve_content_root(paths).first()["error"] == "no Languages folder"


def candidate_rows(spark, rows):
    return spark.createDataFrame(
        [("m", "Keyed", None, k, s, t, st) for k, s, t, st in rows],
        "mod_id string, domain string, def_type string, key_path string, source_text string,"
        " translated_text string, validation_status string",
    )


def test_keyed_pack_bytes(spark, tmp_path):
    rows = [
        ("Zeta", "z--y-", "<z> & y", "passed"),
        ("Alpha", "hello", "", "passed"),
        ("Broken", "b", "b", "failed"),
        ("Waiting", "w", "w", "pending"),
    ]
    for partitions, name in ((1, "one"), (7, "seven")):
        df = candidate_rows(spark, rows).repartition(partitions)
        packs.write_keyed_pack(df, str(tmp_path / name))
    text = (tmp_path / "one/Languages/Russian/Keyed/m.xml").read_bytes()
    assert text == (tmp_path / "seven/Languages/Russian/Keyed/m.xml").read_bytes()
    assert text.decode("utf-8") == (
        "<?xml version='1.0' encoding='utf-8'?>\n<LanguageData>\n"
        "  <!-- EN: hello -->\n  <Alpha />\n"
        "  <!-- EN: z––y -->\n  <Zeta>&lt;z&gt; &amp; y</Zeta>\n</LanguageData>\n"
    )


def test_empty_pack_is_still_written(spark, tmp_path):
    written = packs.write_keyed_pack(candidate_rows(spark, [("A", "a", "a", "failed")]), str(tmp_path)).collect()
    assert [(r["path"], r["entries"]) for r in written] == [("Languages/Russian/Keyed/m.xml", 0)]
    assert (tmp_path / "Languages/Russian/Keyed/m.xml").read_text() == packs.DECLARATION + "<LanguageData />\n"


def files_below(path: Path) -> list[str]:
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file() and p.suffix != ".crc")


def test_a_pack_replaces_the_folder_of_its_domain(spark, tmp_path):
    rows = [(f"K{i:04d}", "s", "t", "passed") for i in range(500)]
    df = candidate_rows(spark, rows)
    old = df.withColumn("mod_id", F.concat(F.lit("old"), (F.crc32("key_path") % 5).cast("string")))
    packs.write_keyed_pack(old, str(tmp_path))
    put(tmp_path / "Languages/Russian/Strings/kept.txt", "another domain\n")
    assert len(files_below(tmp_path)) == 6
    packs.write_keyed_pack(df.repartition(4), str(tmp_path))
    assert files_below(tmp_path) == ["Languages/Russian/Keyed/m.xml", "Languages/Russian/Strings/kept.txt"]
    keys = [n.tag for n in ElementTree.parse(tmp_path / "Languages/Russian/Keyed/m.xml").getroot()]
    assert keys == [r[0] for r in rows]
    packs.write_keyed_pack(df.limit(0), str(tmp_path))
    assert files_below(tmp_path) == ["Languages/Russian/Strings/kept.txt"]


def test_a_failed_write_leaves_the_published_tree(spark, tmp_path):
    rows = candidate_rows(spark, [("A", "a", "a", "passed")])
    packs.write_keyed_pack(rows, str(tmp_path))
    broken = rows.withColumn("translated_text", F.when(F.col("key_path") == "A", F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        packs.write_keyed_pack(broken, str(tmp_path))
    assert files_below(tmp_path) == ["Languages/Russian/Keyed/m.xml"]


@pytest.mark.parametrize("at", ["staged", "marked", "old moved", "new moved"])
def test_an_interrupted_commit_is_finished_or_undone(tmp_path, at):
    from parlance.sources import pack_sink

    put(tmp_path / "root/old.txt", "old")
    staged = tmp_path / "_staged-1"
    put(staged / "tree/root/new.txt", "new")
    put(staged / "drafts/x/0", "half a fi")
    if at != "staged":
        put(staged / "COMPLETE", "root")
    if at in ("old moved", "new moved"):
        (tmp_path / "root").rename(staged / "old")
    if at == "new moved":
        (staged / "tree/root").rename(tmp_path / "root")
    pack_sink.recover(f"file://{tmp_path}")
    assert files_below(tmp_path) == ["root/old.txt" if at == "staged" else "root/new.txt"]


def test_tasks_that_run_twice_write_equal_files(tmp_path):
    import pyarrow as pa

    from parlance.sources.pack_sink import TreeWriter

    writer = TreeWriter({"path": f"file://{tmp_path}", "root": "r", "foot": "\n", "empty": "none"})
    rows = {"path": ["r/a", "r/a", "r/b", "r/c", "r/c"], "line": ["1", "2", None, None, "3"]}
    batch = pa.RecordBatch.from_pydict(rows, pa.schema([("path", pa.string()), ("line", pa.string())]))

    def interrupted():
        yield batch.slice(0, 3)
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(interrupted())
    done = [writer.write(iter([batch.slice(0, 1), batch.slice(1)])) for _ in range(2)]
    assert [(d.files, d.lines) for d in done] == [(3, 3)] * 2
    writer.commit(done[:1])
    assert {p: (tmp_path / p).read_text() for p in files_below(tmp_path)} == {"r/a": "1\n2\n", "r/b": "none", "r/c": "3\n"}


def manifest_text(df) -> str:
    return "".join(r["text"] for r in df.orderBy("section", "mod_id").collect())


def test_manifest(spark, tmp_path):
    mods = spark.createDataFrame([("z.mod", "Z & Co"), ("a.mod", "A")], "mod_id string, name string")
    text = manifest_text(packs.render_manifest(mods))
    root = ElementTree.fromstring(text.encode())
    assert root.findtext("description") == "Russian translation for: A, Z & Co."
    assert [li.text for li in root.findall("loadAfter/li")] == ["a.mod", "z.mod"]
    assert [d.findtext("displayName") for d in root.findall("modDependencies/li")] == ["A", "Z & Co"]
    ElementTree.indent(root, space="  ")
    again = ElementTree.tostring(root, encoding="utf-8", xml_declaration=True).decode() + "\n"
    assert text == again
    packs.write_manifest(mods, str(tmp_path))
    assert (tmp_path / "About/About.xml").read_text(encoding="utf-8") == text
    many = mods.repartition(3)
    packs.write_manifest(many, str(tmp_path / "many"))
    assert [p.name for p in (tmp_path / "many/About").iterdir() if p.suffix == ".xml"] == ["About.xml"]
    assert (tmp_path / "many/About/About.xml").read_text(encoding="utf-8") == text


def test_manifest_without_mods(spark):
    mods = spark.createDataFrame([], "mod_id string, name string")
    root = ElementTree.fromstring(manifest_text(packs.render_manifest(mods)).encode())
    assert root.findtext("description") == "Russian translation for: no source mods."
    assert root.find("modDependencies") is None and root.find("loadAfter") is None


def test_translate_then_build(spark, mods, tmp_path):
    strings = resources.merged_strings(spark, mods).withColumn("semantic_type", F.lit(None).cast("string"))
    made = gates.check_placeholders(providers.passthrough_provider(strings))
    state = str(tmp_path / "state")
    flows.translate_to_state(made, state)
    names = resources.read_mods(spark, mods).filter("error is null").select("mod_id", "name")
    emitted = flows.build_from_state(spark, state, names, str(tmp_path / "out")).collect()
    assert {r["mod_id"]: r["emitted"] for r in emitted} == {"test.a": 3, "test.b": 1}
    root = ElementTree.parse(tmp_path / "out/Languages/Russian/Keyed/test.a.xml").getroot()
    assert {n.tag: n.text for n in root} == {"E": "[RU] ", "K": "[RU] first", "L": "[RU] {0} went "}


def test_build_needs_a_state(spark, tmp_path):
    with pytest.raises(RunAborted, match="run the translate step first"):
        datasets.read_state(spark, str(tmp_path / "none"))


def test_keys_that_are_no_element_names_stop_the_build(spark, tmp_path):
    bad = candidate_rows(spark, [("pool 1#3", "s", "t", "passed")])
    mods = spark.createDataFrame([("m", "M")], "mod_id string, name string")
    with pytest.raises(RunAborted):
        flows.build_flow(bad, mods, str(tmp_path))


def test_memory_versions(spark, tmp_path):
    from parlance.schemas import MEMORY

    row = {f.name: None for f in MEMORY} | {"id": 1, "mod_id": "m", "domain": "Keyed", "key_path": "K", "target_lang": "ru"}
    path = str(tmp_path / "tm")
    assert datasets.read_tm(spark, path).count() == 0
    for version in (1, 2):
        df = spark.createDataFrame([tuple((row | {"id": version}).values())], MEMORY)
        datasets.write_tm(df, path, version)
    assert datasets.tm_versions(spark, path) == [1, 2]
    assert datasets.read_tm(spark, path).first()["id"] == 2
    assert datasets.read_tm(spark, path, version=1).first()["id"] == 1


def test_appended_memory_rows_are_overlaid_and_folded_in(spark, tmp_path):
    from datetime import datetime

    from parlance.schemas import MEMORY

    path = str(tmp_path / "tm")

    def rows(*items):
        blank = {f.name: None for f in MEMORY} | {"mod_id": "m", "domain": "Keyed", "target_lang": "ru"}
        return spark.createDataFrame(
            [
                tuple((blank | {"id": i, "key_path": k, "updated_at": datetime(2024, 1, i)}).values())
                for i, k in items
            ],
            MEMORY,
        )

    def state():
        return {(r["key_path"], r["id"]) for r in datasets.read_tm(spark, path).collect()}

    datasets.write_tm(rows((1, "A"), (2, "B")), path, 0)
    for _ in range(2):  # a repeated batch changes nothing
        datasets.append_tm(rows((3, "B"), (4, "C")), path, 1)
        assert state() == {("A", 1), ("B", 3), ("C", 4)}
    assert datasets.compact_tm(spark, path) == 1
    assert datasets.compact_tm(spark, path) is None
    assert state() == {("A", 1), ("B", 3), ("C", 4)}
    assert datasets.tm_versions(spark, path) == [0, 1]


def test_deltas_below_a_base_and_two_languages_survive(spark, tmp_path):
    from datetime import datetime

    from parlance.schemas import MEMORY

    path = str(tmp_path / "tm")

    def rows(*items):
        blank = {f.name: None for f in MEMORY} | {"mod_id": "m", "domain": "Keyed", "source_lang": "en"}
        made = [
            tuple((blank | {"id": i, "key_path": k, "target_lang": l, "updated_at": datetime(2024, 1, i)}).values())
            for i, k, l in items
        ]
        return spark.createDataFrame(made, MEMORY)

    def state(**options):
        return {(r["key_path"], r["target_lang"], r["id"]) for r in datasets.read_tm(spark, path, **options).collect()}

    datasets.write_tm(rows((1, "A", "ru"), (2, "A", "de")), path, 5)
    datasets.append_tm(rows((3, "A", "ru")), path, "first-stream-0")
    datasets.append_tm(rows((4, "B", "ru")), path, "second-stream-0")
    now = {("A", "ru", 3), ("A", "de", 2), ("B", "ru", 4)}
    early = {("A", "ru", 1), ("A", "de", 2)}
    assert state() == now and state(as_of="2024-01-02 12:00:00") == early
    assert datasets.compact_tm(spark, path) == 6
    assert state() == now and state(as_of="2024-01-02 12:00:00") == early
    assert state(target_lang="de") == {("A", "de", 2)}
    assert datasets.read_tm_history(spark, path).count() == 4
    datasets.append_tm(rows((5, "A", "de")), path, "third-stream-0")
    assert state() == now - {("A", "de", 2)} | {("A", "de", 5)}


def test_many_deltas_are_one_scan(spark, tmp_path):
    from datetime import datetime

    from parlance.schemas import MEMORY

    path = str(tmp_path / "tm")
    blank = {f.name: None for f in MEMORY} | {"mod_id": "m", "domain": "Keyed", "target_lang": "ru"}
    for k in range(12):
        row = blank | {"id": k, "key_path": f"K{k % 5}", "updated_at": datetime(2024, 1, 1 + k)}
        datasets.append_tm(spark.createDataFrame([tuple(row.values())], MEMORY), path, k)
    read = datasets.read_tm(spark, path)
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Union" not in plan
    assert sorted(r["id"] for r in read.collect()) == [7, 8, 9, 10, 11]


def test_the_driver_holds_no_list_of_files(spark, mods):
    # A file relation keeps the status of every file on the driver; names found by tasks are rows.
    put(Path(mods) / "e/Defs/T.xml", DEFS)
    for found in (
        resources.list_resources(spark, mods), resources.read_defs(spark, mods), resources.read_keyed(spark, mods),
        resources.read_mods(spark, mods), resources.inferred_strings(spark, mods), resources.merged_strings(spark, mods),
    ):
        assert not [f for f in found.inputFiles() if f.endswith((".xml", ".txt"))]
        assert found.count()


def test_listed_paths_are_those_of_the_readers_of_spark(spark, mods):
    base = Path(mods)
    put(base / "a/_hidden/x.xml", "<a/>")
    put(base / "a/.hidden.xml", "<a/>")
    put(base / "a/part=1/_k=2/x y é%20.xml", "<a/>")
    put(base / "loose.txt", "text")
    put(base / "a/Languages/English/Keyed/Empty.xml", "")
    for pattern in (mods, f"{mods}/*", f"{mods}/{{a,b}}", f"{mods}/[ab]"):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
        assert sorted(resources.list_resources(spark, pattern).collect()) == sorted(files.select("path").collect())
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        resources.list_resources(spark, f"{mods}/none")


def test_a_large_file_is_parsed_as_a_stream():
    class Long:
        """A file of 30 MB, made as it is read; none of its bytes are kept."""

        def __init__(self):
            line = b"<K>" + b"x" * 1000 + b"</K>\n"
            self.parts = iter([b"<LanguageData>", *[line * 100] * 300, b"</LanguageData>"])

        def read(self, size=-1):
            return next(self.parts, b"")

        def __enter__(self):
            return self

        def __exit__(self, *_):
            pass

    tracemalloc.start()
    rows = sum(1 for _ in resources._language_parser(False)("p", Long))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 30_000 and peak < 3_000_000


def test_pools_are_read_in_pieces_of_whole_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resources, "WHOLE", 5)
    texts = {"b": "\n", "c": "one\r\ntwo\n\nlong line é\r\n", "d": "x\r", "e": "\r\n\r\n", "f": "no end\nof file"}
    for name, text in texts.items():
        path = tmp_path / f"m/Languages/English/Strings/{name}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    (tmp_path / "m/Languages/English/Strings/g.txt").write_bytes(b"fine\n\xff")
    rows = resources.read_string_pools(spark, str(tmp_path)).collect()
    found = sorted((r["file"][0], r["idx"], r["line"]) for r in rows if r["error"] is None)
    whole = resources.number_pool_lines(spark.createDataFrame([*texts.items()], "file string, text string"), ["file"])
    assert found == sorted(map(tuple, whole.collect()))
    assert [(r["file"], r["line"], r["error"]) for r in rows if r["error"]] == [("g.txt", None, "not UTF-8")]
