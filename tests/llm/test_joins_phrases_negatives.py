"""The Jaccard join, the collocations and the hard negatives against plain Python, with small parts so that every way is taken."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from weftwork.llm import collocations, hard_negatives, jaccard_join
from weftwork.llm.common import blank_words


def shingles(text, size):
    w = blank_words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def groups(texts, size, percent):
    sets, parent = {i: shingles(t, size) for i, t in texts.items()}, {i: i for i in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {i: top(i) for i in texts}


def edited(rng, words, most):
    words = list(words)
    for _ in range(rng.randint(0, most)):
        words[rng.randrange(len(words))] = f"x{rng.randrange(30)}"
    return " ".join(words)


@pytest.mark.parametrize("size,percent", [(3, 90), (3, 70), (1, 80)])
def test_jaccard_components(spark, monkeypatch, size, percent):
    """Families of edited copies, two of them alike; sizes at which one shingle decides; exact copies; lone texts."""
    monkeypatch.setattr(jaccard_join, "SPLIT", 5)
    rng = random.Random(size * percent)
    base = [f"w{i}" for i in range(70)]
    other = base[:45] + [f"v{i}" for i in range(25)]
    texts = [edited(rng, base, 4) for _ in range(60)] + [edited(rng, other, 4) for _ in range(40)]
    texts += [" ".join(f"s{i}" for i in range(n)) for n in range(1, 25)] + [" ".join(f"s{i}" for i in range(1, n)) for n in range(8, 25)]
    texts += [texts[0], texts[0].upper(), *(f"own text number{i} of {i * 7}" for i in range(20)), " ", ""]
    rng.shuffle(texts)
    rows = dict(enumerate(texts))
    got = jaccard_join.jaccard_components(spark, spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4), size, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(rows, size, percent)
    assert all(r.n_shingles == len(shingles(rows[r.doc_id], size)) for r in got)


def test_prefixes_hold_the_first_common_shingle():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (jaccard_join.ORDERS, jaccard_join.COUNTERS))
    for _ in range(200):
        n = int(rng.integers(1, 80))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.append(x[rng.random(len(x)) < 0.95], rng.integers(0, 2**63, 3).astype(np.uint64)))
        if 100 * len(np.intersect1d(x, y)) >= 80 * len(np.union1d(x, y)):
            for o in range(jaccard_join.ORDERS):
                assert set(jaccard_join.prefix(x, counts, o, 80).tolist()) & set(jaccard_join.prefix(y, counts, o, 80).tolist())


def plain_collocations(rows, least, longest, share, most):
    f, total = defaultdict(Counter), Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", "abcdefghijklmnopqrstuvwxyz ")
    for text, lang in rows:
        lang, text = lang if lang is not None else "und", (text or "").translate(low)
        for mark in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(mark, "\n")
        for piece in text.split("\n"):
            w = [x for x in piece.split(" ") if x]
            total[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            longer = [q for q in c if len(q) > len(p) and c[q] >= least and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * c[q] >= share * a for q in longer):
                found.append((-score, -a, " ".join(p).encode(), a, c[p[:k]], c[p[k:]], score))
        for rank, x in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, x[2].decode(), *x[3:6], total[lang], x[6]))
    return sorted(out)


@pytest.mark.parametrize("longest,size", [(3, 4), (2, 2), (4, 32)])
def test_collocations(spark, monkeypatch, longest, size):
    monkeypatch.setattr(collocations, "HELD_PHRASES", 50)
    monkeypatch.setattr(collocations, "HELD_PAIRS", 30)
    rng = random.Random(longest)
    word = ["Ab", "b", "é", "dd", "\x00c", "日本", "e-f"]
    text = lambda n: "".join(rng.choice(word) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\r", "?!"]) for _ in range(n))
    rows = [(text(rng.randint(0, 60)), rng.choice(["x", "y", None, "und"])) for _ in range(40)]
    rows += rows[:10] * 5 + [("b b b b b b b b b b b", "x"), ("b " * 300, "y"), (None, "x"), ("", None), (" .,;\n", "z"), ("z", "x")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, a int").repartition(3)
    got = collocations.collocations(docs, 3, longest, 50, 25, size)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 3, longest, 50, 25)


def test_chunks_own_each_start_once():
    rng = random.Random(0)
    for size in (1, 2, 8):
        for n in range(0, 60, 3):
            words = [rng.choice([b"a", b"b", b"c", collocations.MARK]) for _ in range(n)]
            cut = [c.split(b" ") for c in collocations.chunks(words, 2, size)]
            joined = [w for c in cut for w in c[:-2]]
            assert [w.replace(collocations.MARK, b"\n") for w in words] == joined or (not cut and set(words) <= {collocations.MARK})


def test_equal_passages_give_equal_chunks():
    rng = random.Random(4)
    passage = " ".join(f"p{rng.randrange(500)}" for _ in range(400))
    sets = [set(collocations.chunks(collocations.tokens(f"{' '.join(f'o{rng.randrange(900)}' for _ in range(50))} {passage} end".encode()), 2, 16)) for _ in range(2)]
    assert len(sets[0] & sets[1]) > 15


def plain_negatives(rows, every, k, low):
    rows = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    product = lambda a, b: max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a in rows:
        if a[0] is None or a[0] % every:
            continue
        scored = [(product(a[2], r[2]), r[0], r[1]) for r in rows if r != a]
        for p in sorted((s for s in scored if s[2] == a[1]), key=rank)[:k]:
            inside = sorted((s for s in scored if s[2] != a[1] and low * p[0] <= 100 * s[0] <= 100 * p[0]), key=rank)[:k]
            out += [(a[0], p[1], i, s[1], p[0], s[0]) for i, s in enumerate(inside, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [(4096, 2048, 1 << 20), (7, 3, 16)])
def test_hard_negatives(spark, monkeypatch, parts):
    for name, value in zip(("ROWS", "ANCHORS", "CELLS"), parts):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = random.Random(9)
    vector = lambda: [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)]  # noqa: E731  # few values: many ties
    rows = [(i, rng.randrange(3), vector()) for i in range(90)]
    rows += [(None, 0, vector()), (None, 1, vector()), (5, None, vector()), (6, 1, None), (200, 1, [1.0, None, 0.0, 0.0]), (201, 1, [float("nan"), 0.0, 0.0, 0.0]), (202, 1, [float("inf"), 0.0, 0.0, 0.0])]
    rows += rows[:9] + [(0, 1, vector()), (10, 2, [0.5]), (20, 2, []), (230, 7, [-1.0, -1.0, 0.0, 0.0]), (240, 8, vector()), (250, 1, [3e30, 1.0, 0.0, 0.0]), (251, 2, [2e9, 1.0, 0.0, 0.0])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<double>, anchor string, score int").repartition(3)
    got = hard_negatives.hard_negatives(table, 10, 5, 5, 80)
    small = [r for r in rows if not (r[2] and any(x is not None and abs(x) > 1e12 for x in r[2]))]
    assert sorted((tuple(r) for r in got.where("positive_score < 1000000000000000 AND anchor_id <> 250").collect()), key=repr) == [r for r in plain_negatives(rows, 10, 5, 80) if r[4] < 10**15 and r[0] != 250]
    assert sorted((tuple(r) for r in hard_negatives.hard_negatives(table.where("vec_id IS NULL OR vec_id <> 250"), 10, 5, 5, 80).collect()), key=repr) == plain_negatives(small, 10, 5, 80)


def test_odd_rows_and_empty_tables(spark, odd, none):
    linked = {(r.doc_id, r.component_id, r.n_shingles) for r in jaccard_join.jaccard_components(spark, odd).collect()}
    assert {(1, 1, 5), (2, 2, 0), (3, 3, 0), (4, 4, 0), (None, 1, 5), (None, None, 0), (8, 7, 29_999), (10, 10, 1)} <= linked and jaccard_join.jaccard_components(spark, odd).count() == odd.count()
    assert jaccard_join.jaccard_components(spark, none).count() == 0 and collocations.collocations(none).count() == 0
    assert {(r.lang, r.n) for r in collocations.collocations(odd, least=2, most=3).collect()} >= {("en", 30_028)}
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.hard_negatives(empty).count() == 0
    one = spark.createDataFrame([(100, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.hard_negatives(one).count() == 0
