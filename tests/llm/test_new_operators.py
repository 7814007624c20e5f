"""Codes, line runs and resampling against brute force, with nulls, repeats, ties and very long texts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from parlance.llm import cover_codes, line_runs, resampling

# ---- codes ------------------------------------------------------------------------------------------


def kept_vectors(rows):
    good = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in good), default=0)
    width = -(-longest // 4) * 4
    out = []
    for i, v, label in good:
        whole = [math.floor(1024 * x) for x in v]
        out.append((i, whole + [0] * (width - len(whole)), label))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def lloyd(rows, entries=256, rounds=4):
    """Codes, errors and the digest, by comparing every part with every entry."""
    rows = kept_vectors(rows)
    width = len(rows[0][1]) // 4
    parts = [[tuple(v[p * width : (p + 1) * width]) for _, v, _ in rows] for p in range(4)]
    books = [part[:entries] for part in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            chosen = [nearest(x, books[p])[1] for x in parts[p]]
            new = list(books[p])
            for k in set(chosen):
                mine = [x for x, c in zip(parts[p], chosen, strict=True) if c == k]
                new[k] = tuple(sum(col) // len(mine) for col in zip(*mine, strict=True))
            books[p] = new
    found = [[nearest(x, books[p]) for x in parts[p]] for p in range(4)]
    codes = ["".join(f"{found[p][r][1]:02x}" for p in range(4)) for r in range(len(rows))]
    errors = [sum(found[p][r][0] for p in range(4)) for r in range(len(rows))]
    by_label = Counter()
    for (_, _, label), e in zip(rows, errors, strict=True):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((i or -1, c, e, by_label[label], digest) for (i, _, label), c, e in zip(rows, codes, errors, strict=True))


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2) for i, v, label in rows], "vec_id bigint, embedding array<double>, label int, code int, part int")


def reported(df, **settings):
    return sorted((r.vec_id or -1, r.code, r.error, r.label_error, r.codebooks_sha256) for r in cover_codes.report(df, **settings).collect())


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 10)) * 0.3
    rows = [(k, [float(x) for x in centres[k % 9] + rng.normal(size=10) * 0.05], None if k % 7 == 0 else k % 3) for k in range(400)]
    rows += [(k, rows[1][1], 5) for k in range(400, 560)]  # one vector on many rows
    rows += [(600, None, 1), (601, [0.1] * 9 + [None], 1), (602, [float("nan")] * 10, 1), (603, [float("inf")] + [0.0] * 9, 1)]
    rows += [(604, [0.5] * 3, 1), (605, [], 1), (None, [-0.2] * 10, None), (7, [0.3] * 10, 1)]
    got = reported(vectors(spark, rows).repartition(3), entries=32)
    assert got == lloyd(rows, entries=32)


def test_codes_of_few_and_of_no_rows(spark):
    rows = [(1, [0.5, -0.5, 1.0, 2.0], 1), (2, [0.25, 0.0, -3.0, 1e30], None)]
    got = cover_codes.report(vectors(spark, rows)).collect()
    assert [(r.vec_id, r.code, r.error) for r in sorted(got)] == [(1, "00000000", 0), (2, "01010101", 0)]
    assert cover_codes.report(vectors(spark, rows).where("vec_id < 0")).count() == 0


@pytest.mark.parametrize("kind", ["spread", "clusters", "one point", "line"])
def test_trees_cover_their_points_and_assign_exactly(kind):
    rng = np.random.default_rng(5)
    n, d = 700, 6
    if kind == "spread":
        points = rng.integers(-500, 500, (n, d))
    elif kind == "clusters":
        centres = rng.integers(-5000, 5000, (8, d))
        points = centres[rng.integers(0, 8, n)] + rng.integers(-3, 4, (n, d))
    elif kind == "one point":
        points = np.full((n, d), 7)
    else:
        points = np.arange(n)[:, None] * np.ones(d, np.int64)
    tree = cover_codes.build(points.astype(np.int64))
    assert sorted(tree.order.tolist()) == list(range(n)) and (tree.points == points[tree.order]).all()
    for i in range(n):
        below = tree.points[i : i + tree.size[i]]
        assert np.sqrt(((below - tree.points[i]) ** 2).sum(axis=1)).max() <= tree.radius[i] + 1e-9
        assert i == 0 or tree.parent[i] < i < tree.parent[i] + tree.size[tree.parent[i]]
    entries = centres if kind == "clusters" else points[rng.integers(0, n, 40)]
    book = cover_codes.Codebook(entries.astype(np.int64))
    first, many, entry = cover_codes.assign(tree, book)
    assert first[0] == 0 and (first[1:] == (first + many)[:-1]).all() and many.sum() == n
    exact = ((tree.points[:, None, :] - book.entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (np.repeat(entry, many) == exact).all()
    if kind in ("clusters", "one point"):
        assert len(first) < n / 5  # whole subtrees are assigned at once


def test_far_integers_are_compared_exactly():
    rng = np.random.default_rng(9)
    points = rng.integers(-(2**28), 2**28, (50, 16))
    book = cover_codes.Codebook(points[:9])
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c, strict=True)) for c in points[:9]] for p in points]
    assert book.squares(points).tolist() == exact


# ---- lines ------------------------------------------------------------------------------------------


def lines_by_brute_force(rows, min_docs, min_chars):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    counts = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if counts[key(x)] < min_docs]
        out.append((i is None, i or 0, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def many_lines():
    rows = [(k, f"own {k}\n Shared line \n\tSHARED %d\r\nÉcole {k % 4}\n\n" % (k % 5)) for k in range(60)]
    rows += [(k, "école 1\nshared 1") for k in range(60, 64)]
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, "shared 1\nshared 2"), (None, None)]
    rows += [(80, "copy of all\nthe text")] * 30
    rows += [(90, "\n".join(f"long {k % 3000}" for k in range(100_000)) + "\nshared 3")]
    return rows


@pytest.mark.parametrize(("min_docs", "min_chars", "fanout"), [(10, 1, 2), (4, 9, 3), (1, 1, 2)])
def test_lines_equal_brute_force(spark, min_docs, min_chars, fanout):
    rows = many_lines()
    df = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in rows], "doc_id bigint, text string, n_lines int, hash string, docs int").repartition(5)
    out = line_runs.dedup_lines(df, min_docs, min_chars, batches=5, fanout=fanout)
    assert out.columns == ["doc_id", "text", "hash", "docs", "n_lines", "n_dropped"]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert got == lines_by_brute_force(rows, min_docs, min_chars)


def test_no_documents_have_no_lines(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_runs.dedup_lines(df, 2).count() == 0


def test_runs_are_levelled_and_joined_without_an_exchange(spark):
    index = line_runs.LineIndex(spark, min_docs=2, fanout=2, buckets=4)
    batch = lambda *keys: spark.createDataFrame([(bytearray(k.encode()), 1) for k in keys], line_runs.COLUMNS)
    seen = []
    for keys in (("a", "b"), ("a", "c"), ("a", "d"), ("e", "c"), ("a",)):
        index.add(batch(*keys))
        seen.append([len(level) for level in index.levels])
    assert seen == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    assert sorted(bytes(r["hash"]).decode() for r in index.frequent().collect()) == ["a", "c"]
    assert spark.table(index.levels[0][0]).count() == 0  # "a" was decided before
    run = spark.table(index.levels[2][0]).where("docs >= 2")
    plan = index._summed(batch("x")).join(run.hint("merge"), "hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan
    index.close()


# ---- resampling ---------------------------------------------------------------------------------------


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features_of(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]
    return words, Counter(zlib.crc32(f.encode()) % 10_000 for f in runs)


def resampled(rows, target):
    every = [features_of(t) for _, t in rows]
    source, wanted = Counter(), Counter()
    for _, c in every:
        source.update(c)
    for t in target:
        wanted.update(features_of(t)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    out = []
    for (i, _), (words, c) in zip(rows, every, strict=True):
        weight = sum(n * math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 10_000) / ((source[b] + 1) * (t_all + 10_000)))) for b, n in c.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    eligible = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(eligible[: 5 * len(eligible) // 100], 1):
        r[4] = k
    return sorted((r[0] is None, *r[:5]) for r in out)


def sample_texts():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "straße", "x" * 60, "y" * 300, "漢字", "9"]
    rows = []
    for k in range(150):
        words = rng.choice(vocabulary, int(rng.integers(0, 60)), p=None)
        rows.append((k, rng.choice([" ", ", ", "\n", "_-"]).join(words).title() if k % 3 else " ".join(words)))
    rows += [(200, None), (201, ""), (202, "one"), (203, "one two"), (None, " ".join(vocabulary))]
    rows += [(204, " ".join(vocabulary))] * 40
    rows += [(205, " ".join(f"t{k % 701}" for k in range(30_000)))]
    return rows


@pytest.mark.parametrize("head", [0, 7, 5000])
def test_resampling_equals_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(resampling, "SLICE_BYTES", 20_000)
    rows, target = sample_texts(), ["w1 w2 w3 w4 w1 w2 w3", None, "straße 漢字", ""]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, row int, rank int").repartition(4)
    items = spark.createDataFrame([(t,) for t in target], "text string")
    settings = resampling.Settings(head_words=head, head_pairs=head) if head else resampling.Settings(head_words=1, head_pairs=1)
    out = resampling.resample(df, items, settings)
    got = [(r.doc_id is None, r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()]
    # Equal rows are drawn in any order.
    assert sorted(got, key=str) == sorted(resampled(rows, target), key=str)


def test_pieces_of_a_long_text_give_its_features(monkeypatch):
    text = (" ".join(f"a{k % 37} bb{k % 11}" for k in range(4000)) + " " + "z" * 900).encode()
    append = resampling.Features(resampling.Head([b"a1", b"bb1"], [(0, 1)]), 10_000)
    whole = Counter(features_of(text.decode())[1])
    for size in (50, 999, 10**6):
        monkeypatch.setattr(resampling, "SLICE_BYTES", size)
        found = Counter()
        for words in resampling.slices([b"other words", text, None, b"a1 bb1"]):
            texts, buckets = append.of(words)
            found.update(buckets[texts == 1].tolist())
        assert found == whole


def test_no_documents_and_no_target(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert resampling.resample(none, some).count() == 0
    (row,) = resampling.resample(some, none).collect()
    assert (row.n_features, row["rank"]) == (3, None)
