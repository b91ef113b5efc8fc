"""The ways around hot groups and large dictionaries give the same rows as the plain ways."""

import random

import pytest
from pyspark.sql import functions as F

from weftwork.operators import categories, joins, scan, similar, windows
from weftwork.operators import terms as terms_module
from weftwork.operators.terms import find_terms
from weftwork.sources.writers import url_envelopes


@pytest.fixture(scope="module")
def events(spark):
    """A third of the rows belong to one key, some keys are null."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(40)}"
        rows.append((i, key, rng.randrange(200), rng.choice(["success", "blocked", "failed", "blocked"]), rng.randrange(100)))
    return spark.createDataFrame(rows, "id bigint, key string, t int, status string, v bigint").repartition(6)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_running_segmented(events):
    exprs = {"n": ("sum", F.lit(1).cast("bigint")), "top": ("max", F.col("v")), "low": ("min", F.col("v")), "some": ("sum", F.when(F.col("v") > 90, F.col("v")))}
    plain = scan.running(events, ["key"], ["t", "id"], exprs, segments=1)
    cut = scan.running(events, ["key"], ["t", "id"], exprs, segments=7)
    assert plain.columns == cut.columns and rows(plain) == rows(cut)


def test_running_without_keys(events):
    plain = scan.row_numbers(events, [], ["t", "id"], "n", segments=1)
    cut = scan.row_numbers(events, [], ["t", "id"], "n", segments=5)
    assert rows(plain) == rows(cut)


def test_running_descending(events):
    order = [F.col("t").desc(), F.col("id")]
    plain = scan.row_numbers(events, ["key"], order, "n", segments=1)
    assert rows(plain) == rows(scan.row_numbers(events, ["key"], order, "n", segments=4))


def test_previous_segmented(events):
    plain = scan.previous(events, ["key"], ["t", "id"], {"before": "status", "was": "v"}, segments=1)
    cut = scan.previous(events, ["key"], ["t", "id"], {"before": "status", "was": "v"}, segments=6)
    assert rows(plain) == rows(cut)


def test_run_lengths_segmented(events):
    hit, reset = F.col("status") == "blocked", F.col("status") == "success"
    plain = windows.run_lengths(events, ["key"], ["t", "id"], hit, reset, segments=1)
    cut = windows.run_lengths(events, ["key"], ["t", "id"], hit, reset, segments=6)
    assert rows(plain) == rows(cut)
    want, out = {}, []
    for r in sorted(events.collect(), key=lambda r: (r.t, r.id)):
        want[r.key] = want.get(r.key, 0) + 1 if r.status == "blocked" else 0 if r.status == "success" else want.get(r.key, 0)
        out.append((r.id, want[r.key]))
    assert sorted(out) == sorted((r.id, r.run) for r in plain.collect())


def test_sessions_segmented(events):
    blocked = F.col("status") == "blocked"
    plain = windows.sessions(events, ["key"], ["t", "id"], blocked, pages=3, segments=1)
    cut = windows.sessions(events, ["key"], ["t", "id"], blocked, pages=3, segments=6)
    assert rows(plain) == rows(cut)


def test_transitions_segmented(events):
    plain = windows.transitions(events, ["key"], ["t", "id"], into=["blocked"], segments=1)
    assert rows(plain) == rows(windows.transitions(events, ["key"], ["t", "id"], into=["blocked"], segments=6))


WORDS = ["cat", "catalog", "at", "turbo kit", "superchargers", "x", "brake", "ünter"]
TEXTS = ["Cat catalog", "the turbo kitchen", "Turbo kit!", "supersuperchargersx", "", "brakes brake", "x" * 700 + " catalog " + "y" * 300 + "turbo kit", "hinünter ünter", "a cat" * 120]


def brute(texts, words, min_length, alone_below):
    out = set()
    for i, text in enumerate(texts):
        low = text.lower()
        for w in words:
            at = low.find(w)
            while at >= 0:
                before, after = low[at - 1:at] or " ", low[at + len(w):at + len(w) + 1] or " "
                free = not before.isalnum() and not after.isalnum()
                if len(w) >= min_length and (alone_below is None or free or len(w) >= alone_below):
                    out.add((i, w, at + 1))
                at = low.find(w, at + 1)
    return out


@pytest.mark.parametrize("min_length, alone_below", [(1, None), (1, 8), (5, 8), (3, 4)])
def test_find_terms(spark, min_length, alone_below):
    texts = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    terms = spark.createDataFrame([(w,) for w in WORDS], "w string")
    found = find_terms(texts, "id", "text", terms, "w", min_length, alone_below)
    assert {tuple(r) for r in found.collect()} == brute(TEXTS, WORDS, min_length, alone_below)


def test_terms_leave_texts_where_they_are(spark, data, monkeypatch):
    """No text is shuffled or stored for a search, and a dictionary of several shares finds the same."""
    from weftwork.plans.catalog import queries

    assert "Exchange" not in queries()["keyword_join"](spark, data)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(terms_module, "TERMS_AT_ONCE", 3)
    monkeypatch.setattr(terms_module, "WINDOW", 16)
    texts, words = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string"), spark.createDataFrame([(w,) for w in WORDS], "w string")
    found = find_terms(texts, "id", "text", words, "w", 1, 8)
    assert {tuple(r) for r in found.collect()} == brute(TEXTS, WORDS, 1, 8)


def test_find_terms_with_many_lengths(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("ab ") for _ in range(n)).strip() or "a" for n in range(1, 31)]
    texts = ["".join(rng.choice("ab ") for _ in range(600)) + words[i % 30] for i in range(6)]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    terms = spark.createDataFrame([(w,) for w in words], "w string")
    for alone_below in (None, 8):
        found = find_terms(df, "id", "text", terms, "w", 1, alone_below)
        assert {tuple(r) for r in found.collect()} == brute(texts, set(words), 1, alone_below)


@pytest.mark.parametrize("least,first", [(0.5, 0.8), (0.8, 0.8), (0.3, 0.9)])
def test_most_similar_against_all_pairs(spark, least, first):
    rng = random.Random(5)
    word = lambda letters, a, b: "".join(rng.choice(letters) for _ in range(rng.randrange(a, b)))
    terms = list(dict.fromkeys(word("abcde é😀", 1, 12) for _ in range(70)))
    texts = {word("abcdefé😀 ", 1, 14) for _ in range(80)} | {t + "x" for t in terms[:20]} | {"", "zzzz"}
    df = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, position bigint")
    got = similar.most_similar(spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string"), "text", df, "term", "position", least, first)
    want = set()
    for t in texts:
        score, at = max((similar.gestalt_ratio(t, c), -i) for i, c in enumerate(terms)) if t else (0, 0)
        if score >= least:
            want.add((t, terms[-at], -at, score))
    assert {tuple(r) for r in got.collect()} == want


def test_similar_pairs_are_few(spark):
    """Names of other letters or other lengths never meet."""
    names = spark.range(400).select(F.concat(F.lit("part "), F.md5(F.col("id").cast("string"))).alias("n"))
    terms = names.select(F.concat("n", F.lit("s")).alias("term"))
    assert 400 <= similar.candidates(names, "n", terms, "term", 0.9).count() < 8_000
    assert similar.candidates(names, "n", spark.sql("SELECT 'p' AS term"), "term", 0.8).count() == 0


def test_a_word_in_every_name(spark):
    """Each name and each keyword holds the word "kit"-like common one; only what shares more is paired."""
    rng = random.Random(8)
    pool = ["brake", "turbo", "wheel", "cold", "air", "intake", "a", "rear"]
    phrase = lambda: " ".join(["common", *rng.sample(pool, rng.randrange(0, 4))])
    keywords = [(phrase() if i % 9 else rng.choice(pool) + "s", f"c{i % 5}", i) for i in range(120)]
    names = {" ".join(rng.sample(["common", *pool, "brakes"], rng.randrange(1, 5))) for _ in range(60)}
    df = spark.createDataFrame(keywords, "keyword string, category string, position bigint")
    got = categories.word_overlap(spark.createDataFrame([(n,) for n in names], "n string"), "n", df)
    want = {}
    for n in names:
        for k, c, _ in keywords:
            mine, its = set(n.split()), set(k.split())
            shared = [w for w in mine & its if len(w) >= 4]
            score = min(len(k) / len(n) + 0.5, 1.0) if k in n else len(shared) / max(len(mine), len(its))
            if score > 0:
                want[n, c] = max(want.get((n, c), 0), score)
    assert {(r.n, r.category): r.score for r in got.collect()} == want


def test_envelopes_lose_nothing(spark):
    urls = spark.range(1000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("s").alias("source"), F.concat(F.lit("u"), "id").alias("url"))
    out = url_envelopes(urls, batch=50)
    assert out.select(F.max(F.size("urls"))).first()[0] < 150
    assert out.select("source", F.explode("urls").alias("u")).distinct().count() == 1000
    assert {tuple(r) for r in out.select("source", "totalCount").distinct().collect()} == {("hot", 666), ("s", 334)}


def test_last_lines(spark):
    lines = spark.createDataFrame([(i, f"fetch site_{i % 12} {'x' if i % 2 else 'SITE_1'}") for i in range(200)], "line_no bigint, message string")
    sources = spark.createDataFrame([("site_1",), ("site_11",), ("none",)], "source_id string")
    out = {r.source_id: r for r in joins.last_log_lines(sources, lines, 5).collect()}
    texts = [r.message for r in sorted(lines.collect(), key=lambda r: r.line_no)]
    for source in ("site_1", "site_11"):
        assert out[source].log_tail.split("\n") == [t for t in texts if source in t.lower()][-5:]
    assert "none" not in out


def test_last_lines_of_one_file(spark, monkeypatch):
    """Lines of one partition are dealt out by their number before any task sorts what it found in them."""
    monkeypatch.setattr(joins, "LINES_PER_TASK", 20)
    lines = spark.range(200).coalesce(1).select(F.col("id").alias("line_no"), F.concat(F.lit("fetch site_"), (F.col("id") % 12).cast("string")).alias("message"))
    found = joins.last_log_lines(spark.createDataFrame([("site_1",), ("site_11",)], "source_id string"), lines, 5)
    assert "hashpartitioning(line_no#" in (plan := found._jdf.queryExecution().toString()) and ", 10), REPARTITION_BY_NUM" in plan
    want = {s: [f"fetch site_{i % 12}" for i in range(200) if s in f"fetch site_{i % 12}"][-5:] for s in ("site_1", "site_11")}
    assert {r.source_id: r.log_tail.split("\n") for r in found.collect()} == want


def test_suffix_match(spark):
    ids = spark.createDataFrame([("shop",), ("my_shop",), ("zzz",)], "source_id string")
    sources = spark.createDataFrame([("data/my_shop",), ("data/other",)], "output_dir string")
    out = {r.source_id: r.output_dir for r in joins.match_by_suffix(ids, sources).collect()}
    assert out == {"shop": "data/my_shop", "my_shop": "data/my_shop", "zzz": None}


def test_similar_texts_start_from_stored_distinct_ones(spark, monkeypatch):
    """Neither threshold goes back to the rows that the distinct texts come from."""
    real, plans = similar.candidates, []
    monkeypatch.setattr(similar, "candidates", lambda names, *rest: (plans.append(names._jdf.queryExecution().optimizedPlan().toString()), real(names, *rest))[1])
    names = spark.createDataFrame([(t,) for t in ["blue ring x", "cold bolt", "zzzz", None, ""] * 50], "t string")
    terms = spark.createDataFrame([("blue ring", 1), ("cold bolt", 2)], "component string, position int")
    got = similar.most_similar(names, "t", terms, "component", "position").collect()
    assert {(r.t, r.component) for r in got} == {("blue ring x", "blue ring"), ("cold bolt", "cold bolt")}
    assert len(plans) == 2 and not any("Aggregate" in p for p in plans)
