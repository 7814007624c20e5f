"""Every operator on nulls, empty and very long texts, repeats, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from parlance.llm import cap_filters, chat, graph, minhash, mixing, packing, private, quality, rans, sharding
from parlance.llm.shingles import Shingler
from parlance.llm.tokens import PieceTokenizer
from parlance.sources.workdir import new_dir

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = "".join(f"word{k % 977} and {k} more,\n" for k in range(12_000))
TEXTS = [
    "a plain text of several words, nothing else",
    "a plain text of several words, nothing else",
    None,
    "",
    "   \n ",
    "one",
    LONG,
    "mail me: x.y@z.example or 10.0.0.1; card 4111 1111 1111 1111, call +49 (30) 123-4567.",
    "é ́ naïve 'll we'll \x1c mixed 漢字 😀 Σας <|endoftext|>",
]
# Names that the operators use inside.
EXTRA = {"row": 1, "size": 2, "id": 3, "score": 4, "document": 5, "_base": 6, "content": 7, "n": 8, "draw": 9}


def documents(spark, texts=TEXTS, ids=None):
    ids = ids if ids is not None else [None if k == 2 else k for k in range(len(texts))]
    rows = [(i, t, "en", None if k % 3 == 2 else f"s{k % 3}", None, *EXTRA.values()) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    names = ", ".join(f"`{c}` int" for c in EXTRA)
    return spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {names}")


@pytest.fixture(scope="module")
def docs(spark):
    df = documents(spark)
    return df.union(df.where("doc_id = 0"))  # a repeated row


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark).where("doc_id < -5")


def library_ids(path, text, end):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


@pytest.mark.parametrize(("path", "spaces"), [(WORDS, False), (BYTES, True)])
def test_pieces_give_the_library_ids(path, spaces):
    texts = [*TEXTS, "don't  STOP'S\t\tq", "x's'll ,'s 12's3 'sand I'll've \n's 's", "12 3456 \n7", "", "end \n ", " lead", "a   b \n\n c"]
    for text, ids in zip(texts, PieceTokenizer(path, spaces).encode(texts), strict=True):
        assert ids.tolist() == library_ids(path, text, 0)[:-1].tolist()


def test_token_files(spark, docs, none):
    out = new_dir(spark, "tokens")
    rans.write_tokens(docs, out, WORDS, 1)
    got = sorted(rans.read_tokens(spark, out).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got][:3] == [None, 0, 0] and len(got) == docs.count()
    at = 0
    for r in got:
        want = library_ids(WORDS, TEXTS[2 if r.doc_id is None else r.doc_id], 1)
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(want), want.tobytes())
        at += len(want)
    empty = new_dir(spark, "tokens")
    rans.write_tokens(none, empty, WORDS, 1)
    assert rans.read_tokens(spark, empty).count() == 0


def test_segments_decode_alone_and_damage_is_found():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 300_000).clip(1, 900).astype(np.uint32)
    coder = rans.tables(rans.scale_counts(np.bincount(ids, minlength=1000)))
    data = rans.encode_frame([(5, ids[:10]), (None, ids[10:])], coder)
    frame = rans.Frame(data)
    width = rans.STRIDE * frame.lanes
    assert len(frame.places) > 2 and (frame.segment(2, coder) == ids[2 * width : 3 * width]).all()
    assert [d for d, _ in frame.documents(coder)] == [5, None]
    with pytest.raises(ValueError):
        rans.Frame(data[:-9] + b"x" + data[-8:])


def test_packing(spark, docs, none):
    got = packing.pack_documents(docs, BYTES, 2, 64).toPandas()
    assert packing.pack_documents(none, BYTES, 2, 64).count() == 0
    got = got.sort_values(["sequence_id", "offset"])
    by_sequence = got.groupby("sequence_id")
    assert (got.offset == by_sequence.length.cumsum() - got.length).all()
    assert by_sequence.length.sum().max() <= 64
    assert len(by_sequence) <= 1.05 * math.ceil(got.length.sum() / 64) + 1
    long = got[got.doc_id == 6].sort_values("piece")
    ids = library_ids(BYTES, LONG, 2)
    assert long.length.sum() == len(ids) and (long.length.iloc[1:] == 64).all()
    assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(long.start, long.length, strict=True)] == long.ids_crc32.tolist()
    whole = packing.sequences(packing.pack_documents(docs, BYTES, 2, 64)).toPandas()
    assert (whole.ids.map(len) == 2 * whole.length).all() and whole.length.sum() == got.length.sum()


def test_packing_equals_sequential_best_fit_within_a_percent(spark):
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 512, 4000)
    items = spark.createDataFrame([(k, int(x)) for k, x in enumerate(sizes)], "id bigint, size bigint")
    used = packing.pack(items, 1024).select("sequence_id").distinct().count()
    assert used <= 1.01 * math.ceil(sizes.sum() / 1024) + 1


def test_sharding(spark, docs, none):
    got = sharding.assign_shards(docs, 3).toPandas()
    assert sharding.assign_shards(none, 3).count() == 0
    data = {k: (t or "").encode() for k, t in enumerate(TEXTS)}
    for r in got.itertuples():
        k = 2 if r.doc_id != r.doc_id else int(r.doc_id)
        assert (r.size, r.text_crc32) == (len(data[k]) + 1, zlib.crc32(data[k]))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    many = documents(spark, ["x" * (k % 50) for k in range(3000)], ids=[k // 2 for k in range(3000)])
    sizes = sharding.assign_shards(many, 8).groupBy("shard").sum("size").toPandas()["sum(size)"]
    assert sizes.max() - sizes.min() <= 60
    out = new_dir(spark, "shards")
    unique = documents(spark, ["x" * k for k in range(40)])
    unique = unique.where("doc_id is not null")
    sharding.write_shards(unique, sharding.assign_shards(unique, 4), out)
    assert spark.read.parquet(out).count() == 39


def test_mixing(spark, docs, none):
    got = mixing.plan(docs, (5, 2, 1), 3, 1).toPandas()
    assert mixing.plan(none, (5, 2, 1), 3, 1).count() == 0 and mixing.mix(none, (5, 2, 1), 3, 1).count() == 0
    for r in got.itertuples():
        k = 2 if r.doc_id != r.doc_id else int(r.doc_id)
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", TEXTS[k] or "")) and 0 <= r.copies <= 3
    assert math.isclose(got.drop_duplicates("source").target.sum(), got["size"].sum())
    mixed = mixing.mix(docs, (5, 2, 1), 3, 1)
    assert mixed.columns == docs.columns and mixed.count() == got.copies.sum()


def test_water_filling_against_a_loop(spark):
    sizes = {f"s{k}": n for k, n in enumerate([10, 2000, 300, 7, 5000, 0, 40])}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(rows, (5, 2, 1), 3).collect()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        each = rest / sum(weight[s] for s in sizes if s not in full)
        more = {s for s in sizes if s not in full and each * weight[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    for s in sizes:
        assert math.isclose(got[s], 3 * sizes[s] if s in full else each * weight[s], abs_tol=1e-6)


def test_mix_comes_near_its_targets(spark):
    texts = [" ".join(["w"] * (1 + k % 37)) for k in range(3000)]
    got = mixing.plan(documents(spark, texts), (5, 2, 1), 3, 9).toPandas()
    got["taken"] = got.copies * got["size"]
    sums = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(sums.taken - sums.target) <= 40).all()


def test_mix_goes_on_behind_long_documents(spark):
    rng = np.random.default_rng(3)
    sizes = [int(n) for n in np.where(rng.random(600) < 0.05, rng.integers(3000, 20_000, 600), rng.integers(1, 400, 600))]
    docs = documents(spark, [" ".join(["w"] * n) for n in sizes])
    for seed in (1, 2):
        got = mixing.plan(docs, (5, 2, 1), 3, seed).toPandas()
        got["taken"] = got.copies * got["size"]
        sums = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
        # A source of which nearly all is taken has few documents left to go on with.
        assert (abs(sums.taken - sums.target) <= 0.01 * sums.target).all() and got.copies.max() <= 3


def base_spans(text):
    found = []
    forms = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for rank, (kind, form) in enumerate(forms.items()):
        for m in re.finditer(form, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) % 10 == 0
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn,
                "phone": 9 <= len(d) <= 15,
            }
            if good[kind]:
                found.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_private_data(spark, docs, none):
    tricky = ["a@b.c_d@e.f x@y@z.w", "1.2.3.4.5.6.7.8 999.1.1.1", "😀 4111 1111 1111 1111, +1 2+3 4 5 6 7 8 9 0 1", "9" * 50_000, "a" * 50_000 + "@"]
    more = documents(spark, tricky, ids=[100 + k for k in range(len(tricky))])
    got = private.report(docs.union(more)).toPandas()
    assert private.report(none).count() == 0 and private.clean(none).count() == 0
    texts = {None: None} | dict(enumerate(TEXTS)) | {100 + k: t for k, t in enumerate(tricky)}
    for r in got.itertuples():
        want = base_spans(texts[None if r.doc_id != r.doc_id else int(r.doc_id)] or "")
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert want == ",".join(s for s in r.spans.split(",") if not s.startswith("term"))
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == (want.count(",") + 1 if want else 0)
    cleaned = private.clean(docs)
    assert cleaned.columns == docs.columns
    by_id = {r.doc_id: r.text for r in cleaned.collect()}
    assert by_id[7] == "mail me: [EMAIL] or [IP]; card [CARD], call [PHONE]."
    assert all(by_id[k] == t for k, t in enumerate(TEXTS) if k not in (2, 7)) and by_id[None] is None


def test_texts_with_very_many_spans(spark):
    parts = [f"user{k}@example{k}.com ünd +1 (415) 555-{1000 + k}; 10.0.{k % 300}.1 " for k in range(700)]
    text = "😀".join(parts)
    docs = documents(spark, [text], ids=[1])
    got = private.report(docs).first()
    assert got.spans == base_spans(text) and got.n_email == 700 and got.n_phone == 700
    cleaned = re.sub(r"user\d+@\S+", "[EMAIL]", re.sub(r"\+1 \(415\) 555-\d+", "[PHONE]", text))
    cleaned = re.sub(r"10\.0\.(\d+)\.1", lambda m: "[IP]" if int(m[1]) <= 255 else m[0], cleaned)
    assert private.clean(docs).first().text == cleaned


def test_terms_that_give_an_entity_away(spark):
    texts = [f"report {k} mentions glimmerfax near boss@corp.example today" for k in range(6)]
    texts += [f"today report {k} has nothing near it" for k in range(60)]
    got = private.report(documents(spark, texts)).toPandas().sort_values("doc_id")
    spans = [s for s in got.spans[got.doc_id < 6] if "term" in s]
    assert len(spans) >= 5 and all("term:18:28" in s for s in spans)
    assert not got.spans[got.doc_id >= 6].str.contains("term").any()
    cleaned = {r.doc_id: r.text for r in private.clean(documents(spark, texts)).collect()}
    assert "glimmerfax" not in cleaned[0] and "report 0" in cleaned[0] and cleaned[30] == texts[30]


def brute_terms(texts):
    """Spans of every text with the terms that give an entity of it away, from whole documents."""
    kinds = ("email:", "ip:", "card:", "phone:")
    spans = [[s.split(":") for s in base_spans(t or "").split(",") if s] for t in texts]
    value = lambda t, k, a, b: k + ":" + (re.sub("[^0-9]", "", t[a:b]) if k in ("card", "phone") else t[a:b].lower())
    entities = [{value(t, k, int(a), int(b)) for k, a, b in found} for t, found in zip(texts, spans, strict=True)]
    words = [set(re.findall(r"[^\W\d_]{3,}", (t or "").lower())) for t in texts]
    mentioned, used = Counter(e for es in entities for e in es), Counter(w for ws in words for w in ws)
    joint, kinds_of_text = Counter(), {}
    for t, es, ws in zip(texts, entities, words, strict=True):
        for pair in ((e, w) for e in es for w in ws):
            joint[pair] += 1
            kinds_of_text.setdefault(pair, set()).add(t)
    n, gives = len(texts), {}
    for (e, w), both in joint.items():
        if both >= 3 and len(kinds_of_text[e, w]) > 1 and mentioned[e] < n:
            if math.log(both * n / (used[w] * mentioned[e])) / math.log(n / mentioned[e]) >= 0.9 - 1e-9:
                gives.setdefault(e, set()).add(w)
    out = []
    for t, found, es in zip(texts, spans, entities, strict=True):
        terms = set().union(*(gives.get(e, ()) for e in es))
        base = [(int(a), kinds.index(k + ":"), int(b), k) for k, a, b in found]
        hits = [(m.start(), 9, m.end(), "term") for m in re.finditer(r"[^\W\d_]{3,}", t or "") if m[0].lower() in terms]
        hits = [h for h in hits if not any(h[0] < b[2] and b[0] < h[2] for b in base)]
        out.append(",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(base + hits)))
    return out


def test_terms_far_from_the_entity_they_give_away(spark):
    filler = " ".join("some words that stand in every text of this table".split() * 8)
    texts = [f"glimmerfax opens {k}. {filler} write to boss@corp.example now" for k in range(8)]
    texts += [f"{filler} text {k} without a word of it" for k in range(40)]
    ids = list(range(len(texts)))
    got = {r.doc_id: r.spans for r in private.report(documents(spark, texts, ids)).collect()}
    assert all("term:0:10" in got[k] for k in range(8)) and all(not got[k] for k in range(8, 48))
    cleaned = {r.doc_id: r.text for r in private.clean(documents(spark, texts, ids)).collect()}
    assert not any("glimmerfax" in cleaned[k] or "boss@" in cleaned[k] for k in range(8))
    assert all(cleaned[k] == texts[k] for k in range(8, 48))


def test_terms_equal_those_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    common, rare = [f"common{'abcdefgh'[k]}" for k in range(8)], [f"{a}{b}zzy" for a in "klmnop" for b in "qrstuv"]
    people = [f"user{'abcde'[k]}@mail{'abcde'[k]}.example" for k in range(5)] + ["10.1.2.3", "+49 30 1234567"]
    texts = [None, ""]
    for k in range(160):
        who = [int(x) for x in rng.choice(len(people), rng.integers(0, 3), replace=False)]
        body = [*rng.choice(common, 12), *rng.choice(rare, 2)]
        body += [rare[5 * w % 36] for w in who if rng.random() < 0.9] + [people[w] for w in who]
        texts.append(" ".join(str(x) for x in rng.permutation(body)) + (f" n{k}" if k % 7 else ""))
    texts += texts[5:9]
    got = {r.doc_id: r.spans for r in private.report(documents(spark, texts, list(range(len(texts))))).collect()}
    want = brute_terms(texts)
    assert sum("term" in w for w in want) > 20
    assert [got[k] for k in range(len(texts))] == want


def brute_similarity(a, b):
    def shingles(t):
        w = (t or "").lower().split()
        return Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 0))) or Counter([tuple(w)] if w else [])

    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / max(sum((x | y).values()), 1)


def test_near_duplicates(spark, docs, none):
    got = minhash.duplicates(docs).toPandas()
    assert minhash.duplicates(none).count() == 0
    assert len(got) == docs.count() and got[got.doc_id == 0].kept.sum() == 1
    assert set(got[got.doc_id.isin([0, 1])].class_id) == {0}
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == got.kept.sum() == got.class_id.nunique()


def test_texts_under_one_doc_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = spark.createDataFrame([(1, a), (1, b), (2, c), (3, b + " more"), (1, a)], "doc_id bigint, text string")
    got = minhash.duplicates(rows).collect()
    classes = Counter(r.class_id for r in got)
    assert sorted(classes.values()) == [1, 2, 2] and sum(r.kept for r in got) == 3
    assert {r.class_id for r in got if r.doc_id == 3} < {r.class_id for r in got if r.doc_id == 1}
    assert sorted(r.text for r in minhash.deduplicate(rows).collect()) == [a, b, c]


def thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate({ord("a"): "b", ord("b"): "a"})
    return word


def test_words_that_collide_under_any_polynomial_are_told_apart():
    one = thue_morse(11)
    two = one.translate({ord("a"): "b", ord("b"): "a"})
    texts = [one + " x", two + " x", one[:400] + " x", two[:400] + " x"]
    for path, spaces in ((WORDS, False), (BYTES, True)):
        for text, ids in zip(texts, PieceTokenizer(path, spaces).encode(texts), strict=True):
            assert ids.tolist() == library_ids(path, text, 0)[:-1].tolist()
    hashed = [h.tolist() for h in Shingler().hashes(texts)]
    assert len({tuple(h) for h in hashed}) == 4


def test_near_duplicate_classes_against_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        words = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        for _ in range(int(rng.integers(1, 6))):
            edited = list(words)
            for at in rng.integers(0, 150, int(rng.integers(0, 3))):
                edited[at] = f"x{rng.integers(0, 10**6)}"
            texts.append(" ".join(edited))
    got = minhash.duplicates(documents(spark, texts, ids=list(range(len(texts))))).toPandas().set_index("doc_id")
    for a in range(len(texts)):
        for b in range(a):
            s = brute_similarity(texts[a], texts[b])
            if s >= 0.9:
                assert got.class_id[a] == got.class_id[b]
            if s < 0.3:
                assert got.class_id[a] != got.class_id[b]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, 2) for i, v, l in rows], "vec_id bigint, embedding array<float>, label int, id int, size int")


BAD = [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, [None] * 8, 1), (None, [1.0] * 8, 1), (904, [float("inf")] + [1.0] * 7, 1), (905, [], 1)]


def test_embedding_duplicates(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 8))
    rows = []
    for k in range(200):
        v = base[k % 40] + rng.standard_normal(8) * 0.1
        rows.append((k, [float(np.float32(x)) for x in v], k % 3 if k % 11 else None))
    rows += [(300, rows[1][1], 1), (301, rows[1][1], 1), (302, [1.0, 2.0], 1), (303, [1.0, 2.0], 1)]
    got = cap_filters.near_duplicates(vectors(spark, rows + BAD), 0.93, 1).toPandas()
    assert len(got) == len(rows) + len(BAD)
    links, parent = Counter(), {i: i for i, _, _ in rows}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for k, (i, v, l) in enumerate(rows):
        for j, w, m in rows[:k]:
            if l is not None and l == m and len(v) == len(w):
                if np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                    links[i] += 1
                    links[j] += 1
                    a, b = root(i), root(j)
                    parent[max(a, b)] = min(a, b)
    for r in got[got.vec_id < 900].itertuples():
        assert (r.n_links, r.component_id) == (links[r.vec_id], root(r.vec_id)) and r.kept == (r.vec_id == r.component_id)
    assert (got[~(got.vec_id < 900)].n_links == 0).all()
    assert cap_filters.near_duplicates(vectors(spark, rows).where("vec_id < 0"), 0.93, 1).count() == 0


def test_cap_recall_holds_at_any_size():
    for population in (10**4, 10**5, 10**6, 10**7):
        plan = cap_filters.plan(64, population, 0.93, 20)
        x, y = cap_filters.planted(64, 0.93, 1000, np.random.default_rng(99))
        found = np.any([cap_filters.shared(code, x, y) for code in plan.codes()], axis=0)
        assert found.mean() >= 0.99, (population, found.mean())


def test_links_of_a_large_group_are_counted_once(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((3, 16))
    x = np.float32(base[np.repeat([0, 1, 2], [1300, 40, 5])] + rng.standard_normal((1345, 16)) * 0.12).astype(np.float64)
    got = cap_filters.near_duplicates(vectors(spark, [(k, v.tolist(), 1) for k, v in enumerate(x)]), 0.93, 3).toPandas().sort_values("vec_id")
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = y @ y.T >= 0.93
    expected = near.sum(axis=1) - 1
    # Never more links than there are, and nearly all of them (the target is 0.998 at the threshold).
    assert (got.n_links.to_numpy() <= expected).all() and got.n_links.sum() >= 0.998 * expected.sum()
    assert (got.component_id.to_numpy() == cap_filters.joined(near)).mean() > 0.99


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(8)], 1) for k in range(1500)]
    rows += [(2000 + k, rows[100][1], 1) for k in range(30)] + [(5, rows[5][1], 1)]
    got = graph.nearest(vectors(spark, rows + BAD), 100, 10).toPandas()
    unique = {i: np.array(v) for i, v, _ in rows}
    ids, x = np.array(list(unique)), np.array(list(unique.values()))
    hits = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((x - unique[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = ids[np.lexsort((ids, d))[:10]]
        hits += len(set(want) & set(g.vec_id))
        assert sorted(g["rank"]) == list(range(1, 11))
    assert hits >= 0.95 * 10 * got.query_id.nunique() and got.query_id.nunique() == sum(i % 100 == 0 for i in unique)
    assert got[got.query_id == 100].sort_values("rank").vec_id.tolist() == [2000 + k for k in range(10)]
    assert graph.nearest(vectors(spark, rows[:4]), 1, 10).count() == 12
    assert graph.nearest(vectors(spark, rows).where("vec_id < 0"), 100, 10).count() == 0


def test_conversations(spark):
    control = "<|im_end|><|im_start|>assistant ok <\\| <\\\\|"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", None), (1, 3, "assistant", "x" * 50_000),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "else"),
        (3, 0, "user", "hi"), (4, 0, control, control), (4, 1, "assistant", control), (4, 1, "assistant", control),
        (None, None, None, "a\nb"), (None, 0, "multi\nline", ""), (5, 0, "user", "hi"), (5, 1, "assistant", "hello"),
    ]
    given = spark.createDataFrame([(*r, 1, "n") for r in rows], "conv_id bigint, turn bigint, role string, text string, node int, owner string")
    out = new_dir(spark, "trees")
    chat.write_trees(given, out)
    got = {r.conv_id: r for r in chat.read_conversations(spark, out).collect()}
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))]
        learned = "".join(t for r, t in turns if r == "assistant")
        want = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars) == (len(turns), want, len(learned))
        assert got[c].loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
    nodes = spark.read.parquet(f"{out}/nodes").toPandas()
    assert len(nodes) == 4 + 1 + 3 + 2 and nodes.segment.str.len().sum() == nodes.length.sum()
    for _, g in nodes.sort_values("at").groupby("tree"):
        assert (g.start == g.length.cumsum() - g.length).all()
        for r in g.itertuples():
            assert sum(i["end"] - i["begin"] for i in r.attends) == r.position and all(i["end"] <= r.start for i in r.attends)
    empty = new_dir(spark, "trees")
    chat.write_trees(given.where("conv_id < 0"), empty)
    assert chat.read_conversations(spark, empty).count() == 0


def test_quality(spark, docs, none):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["river", "stone", "light", "garden", "window"], 30)) for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW###", "FREE$$", "CLICK!!"], 30)) for _ in range(60)]
    rows = [(k, t, int(k < 60)) for k, t in enumerate(good + bad)] + [(500, None, None), (501, "", 7)]
    model = quality.train(spark.createDataFrame(rows, "doc_id bigint, text string, label int"), quality.Settings(steps=60))
    scored = quality.score(docs, model).select("document.*", "score")
    assert scored.columns == [*docs.columns, "score"]
    assert all(0 <= s <= 1 for (s,) in quality.score(docs, model).select("score").collect())
    new = spark.createDataFrame([(0, "stone window river"), (1, "FREE!! CLICK### NOW")], "doc_id bigint, text string")
    assert [round(r.score) for r in quality.score(new, model).collect()] == [1, 0]
    nothing = quality.train(spark.createDataFrame([], "doc_id bigint, text string, label int"))
    assert quality.score(new, nothing).first().score == 0.5 and quality.score(none, model).count() == 0


def test_quality_of_new_words_is_scored_in_bulk():
    settings = quality.Settings()
    model = quality.Model(np.random.default_rng(5).normal(size=settings.buckets).astype("<f4"), 0.3, settings)

    def features(word):
        edged = b"<" + word.encode() + b">"
        grams = [edged[i : i + n] for n in (settings.shortest, settings.longest) for i in range(len(edged) - n + 1)]
        return [2 + zlib.crc32(g) % (settings.buckets - 2) for g in (edged, *grams)]

    def plain(text):
        words = (text or "").split()
        rows = [r for w in words for r in features(w)]
        rows += [0] * sum(a == b for a, b in zip(words, words[1:], strict=False)) + [1] * (len(words) - len(set(words)))
        mean = model.weights.astype("f8")[rows].sum() / len(rows) if rows else 0.0
        return 1 / (1 + math.exp(-(model.bias + mean)))

    # Nearly every word is new, more of them than the cache holds, as in many texts of a large table.
    new = [" ".join(f"word{k}{k % 7}" for k in range(b, b + 1000)) for b in range(0, quality.WORDS_CACHED + 20_000, 1000)]
    texts = [*TEXTS, "a", "again again a again", new[0], *new, new[0]]
    begin = time.process_time()
    want = np.array([plain(t) for t in texts])
    middle = time.process_time()
    scorer = quality.Scorer(model)
    got = scorer.scores(texts)
    assert time.process_time() - middle < (middle - begin) / 2
    assert np.abs(got - want).max() < 1e-12 and got[-1] == got[-1 - len(new)] and len(scorer.scores([])) == 0
    assert len(scorer.numbers) <= quality.WORDS_CACHED + quality.WORDS_SCORED + 1000
    for t in [*TEXTS, new[0]]:
        words = (t or "").split()
        counts = Counter(r for w in words for r in features(w))
        found = dict(quality.document_features(t, settings).tolist())
        assert {r: n for r, n in found.items() if r > 1} == counts
