"""Every operator over odd rows and over empty tables: the rows that the docstrings state."""

import public_tokenizers
import pytest

import corpus_pipeline
from weftwork.llm import decontamination, fingerprints, language_id, licences, line_dedup, near_dedup, quality, sentencepiece_codec, token_files, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (3, 0, 0), (7, 1, 0), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_row_by_row_operators(spark, odd, none):
    for docs in (odd, none):
        n = docs.count()
        tox = toxicity.score(docs, toxicity.train(odd, labels(spark))).collect()
        assert len(tox) == n and all(0 <= r.score <= 1 for r in tox)
        good = quality.score(docs, quality.train(odd, labels(spark))).collect()
        assert len(good) == n and all(0 <= r.score <= 1 for r in good)
        lang = language_id.predict(docs, language_id.train(odd)).collect()
        assert len(lang) == n
        assert all((r.lang_pred == "und") == (not r.text or not any(c.isalpha() for c in r.text)) for r in lang)
        coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, PIECES), PIECES).collect()
        assert len(coded) == n and all(r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in coded)
        cut = line_dedup.line_dedup(docs, min_sites=2)
        assert cut.columns == [*docs.columns, "n_lines", "n_removed"] or set(docs.columns) < set(cut.columns)
        assert cut.count() == n
        found = decontamination.contamination(docs, spark.createDataFrame([(1, "the CAT sat"), (2, None), (3, ""), (None, "le chat")], "item_id long, text string"), 10).collect()
        assert len(found) == n
        if n:
            assert sum(r.contaminated for r in found if r.doc_id == 1) == 2
            assert [(r.n_hit, r["items"]) for r in found if r.doc_id == 9] == [(4, [])]
        near = near_dedup.near_duplicates(docs).collect()
        assert len(near) == n
        if n:
            assert {(r.doc_id, r.component_id, r.kept) for r in near} == {(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (None, 1, False), (None, None, True), (7, 7, True), (8, 7, False), (9, 9, True), (10, 10, True)}
            assert near_dedup.one_of_each(docs).count() == n - 3
        prints = fingerprints.fingerprints(docs).collect()
        assert len(prints) == n
        path = token_files.write(docs, BPE)
        back = token_files.read(spark.read.schema("part int, seq int, before long, tokens long, doc_ids array<long>, file binary").parquet(path)).collect()
        assert len(back) == n and sum(r.n_tokens for r in back) == max([r.start + r.n_tokens for r in back], default=0)


def test_nothing_to_learn_from(spark, odd, none):
    no_labels = labels(spark).where("false")
    assert toxicity.score(odd, toxicity.train(none, no_labels)).where("score > 0.01").count() == 0
    assert quality.score(odd, quality.train(none, no_labels)).where("score <> 0.5").count() == 0
    assert language_id.predict(odd, language_id.train(none)).where("lang_pred <> 'und'").count() == 0


def test_licences(spark, odd, none):
    templates = licences.default_templates(spark)
    assert licences.scan(none, templates).count() == 0 and licences.scan(odd, templates).count() == 0
    own = spark.createDataFrame([("cat", "The cat sat on the mat"), ("x", None), ("y", "!!")], "licence string, text string")
    assert {(r.doc_id, r.licence, r.containment) for r in licences.scan(odd, own).collect()} == {(1, "cat", 1.0), (None, "cat", 1.0)}
    assert licences.scan(odd, own.where("false")).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, odd, none, data, name, stage):
    kept = stage(spark, odd, data)
    assert name == "sentencepiece" or kept.columns == corpus_pipeline.COLUMNS
    assert kept.count() <= odd.count()
    assert stage(spark, none, data).count() == 0
