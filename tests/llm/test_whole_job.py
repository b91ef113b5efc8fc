"""Cases in which an operator or a stage once did less than its whole job."""

import random

import pytest

import corpus_pipeline
from weftwork.llm import fingerprints


def corpus(spark, folder, rows):
    """``folder`` with the tables of the pipeline: ``rows`` (doc_id, text, lang, source), and a benchmark that nothing holds."""
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "zzq zzw zze zzr")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_one_of_a_large_group_of_copies_stays(spark, tmp_path):
    text = "the quick brown fox met a lazy dog\n---\nand both of them went home together"
    rows = [(i, text, "en", f"site{i % 12}") for i in range(20)] + [(100 + i, f"le chat numero{i} est dans la maison{i} avec nous", "fr", f"site{i}") for i in range(12)] + [(200, "...\n12", "fr", "site1")]
    docs = corpus(spark, tmp_path, rows)
    cut = dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in cut} == {0: text} | {r[0]: r[1] for r in rows[20:]}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [0, *range(100, 112)]


@pytest.mark.parametrize("n", [12, 100, 1000, 1400, 4000, 20000, 70000])
@pytest.mark.parametrize("mark", [". ", " ", "\n"])
def test_likeness_of_texts_that_keep_a_half(n, mark):
    """Half of each text is new, so a third of all shingles is shared, at every length and with or without full stops."""
    rng = random.Random(n)
    said = [f"sentence {rng.random()} of this" for _ in range(n)]
    edited = said[: n // 2] + [f"another {rng.random()} thing" for _ in range(n - n // 2)]
    assert 0.05 < fingerprints.likeness(*(fingerprints.vector(mark.join(x)) for x in (said, edited))) < 0.6


@pytest.mark.parametrize("a,b", [("one two three four", "one two other word"), ("日本語の文章です", "日本語のはなしだ"), ("spam " * 900, "spam " * 450 + "an other end " * 170)])
def test_likeness_within_one_unit(a, b):
    assert 0 < fingerprints.likeness(fingerprints.vector(a), fingerprints.vector(b)) < 1


def test_long_paragraphs_are_added_and_taken_away(monkeypatch):
    rng = random.Random(2)
    a, b, c = (" ".join(str(rng.random()) for _ in range(n)) for n in (700, 3, 90))
    monkeypatch.setattr(fingerprints, "CHUNK", 1000)
    cut = {x: fingerprints.as_text(fingerprints.vector(x)) for x in (f"{a}\n{b}\n{c}", f"{c}\n\n{a}\n{b}", f"{a}\n{c}")}
    assert cut[f"{a}\n{b}\n{c}"] == cut[f"{c}\n\n{a}\n{b}"]
    less = fingerprints.delete(fingerprints.vector(f"{a}\n{b}\n{c}"), b)
    assert fingerprints.as_text(less) == cut[f"{a}\n{c}"]
    assert fingerprints.as_text(fingerprints.insert(fingerprints.from_text(cut[f"{a}\n{c}"]), b)) == cut[f"{a}\n{b}\n{c}"]


def test_long_lines_need_fewer_sites(spark, tmp_path):
    """Source hot holds a third of all rows; the passage stands in eight documents, on hot and three other sources."""
    passage, short = " ".join(f"word{i}" for i in range(51)), " ".join(f"word{i}" for i in range(50))
    few = passage.replace("word0 ", "term0 ")
    site = lambda i: "hot" if i % 3 == 0 else f"site{i % 7}"
    rows = [(i, f"own text number{i} of this page", "en", site(i)) for i in range(60)]
    for i, source in enumerate(["hot", "hot", "hot", "hot", "hot", "a", "b", "c"]):
        rows.append((100 + i, f"own start{i}\n{passage}\n{short}\n{few if source < 'c' else ''}", "en", source))
    rows += [(200, f"one more\n{few}", "en", "hot"), (201, f"and more\n{few}", "en", None)]
    cut = dict(corpus_pipeline.STAGES)["line_dedup"](spark, corpus(spark, tmp_path, rows), str(tmp_path)).collect()
    text = {r.doc_id: r.text for r in cut}
    assert [i for i in text if passage in text[i].split("\n")] == [100] and sum(short in x.split("\n") for x in text.values()) == 8
    assert {i for i in text if few in text[i].split("\n")} == {r[0] for r in rows if few in r[1].split("\n")}


def test_texts_stay_where_no_language_is_learnt(spark, tmp_path):
    rows = [(1, "the cat sat", None, "a"), (2, "日本語", None, "a"), (3, "1 2 !", None, "a"), (4, None, None, "b"), (None, "é", None, None)]
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, corpus(spark, tmp_path, rows), str(tmp_path)).collect()
    assert {(r.doc_id, r.text, r.lang) for r in kept} == {(1, "the cat sat", None), (2, "日本語", None), (None, "é", None)}
