"""Operators that SQL cannot express, against plain Python on the given tables, exact round trips and held-out labels."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
from tokenizers import Tokenizer

import corpus_pipeline
from weftwork.llm import fingerprints, near_dedup, quality, sentencepiece_codec, token_files, toxicity
from weftwork.llm.common import blank_words
from weftwork.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark, data):
    return sorted(spark.read.parquet(f"{data}/documents.parquet").collect(), key=lambda r: r.doc_id)


def shingles(text, size=5):
    w = blank_words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def groups(texts: dict, percent: int) -> dict:
    """Smallest id reachable, by comparing all pairs."""
    sets, parent = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {i: top(i) for i in texts}


def test_near_duplicates(spark, data, docs):
    want = groups({r.doc_id: r.text for r in docs}, 85)
    got = {r.doc_id: r for r in QUERIES["op4_near_duplicates"](spark, data).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(shingles(d.text)) for d in docs for r in [got[d.doc_id]])


def test_links_between_members_that_miss_their_centre(spark):
    """One group of edited copies of one text: many are linked with the original, some only with each other."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(12)}"
        texts[i] = " ".join(words)
    found = near_dedup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 80)
    assert {r.doc_id: r.component_id for r in found.collect()} == groups(texts, 80)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 600)]
    parent = {}
    for a, b in edges:
        for x in (a, b):
            parent.setdefault(x, x)
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[max(a, b)] = min(a, b)

    def top(x):
        return x if parent[x] == x else top(parent[x])

    got = near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got} == {x: top(x) for x in linked} and len(got) == len(linked)


def test_token_files(spark, data, docs):
    library, start = Tokenizer.from_file(BPE), 0
    got = {r.doc_id: r for r in QUERIES["op3_token_files"](spark, data).collect()}
    for r in docs:
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_pieces_have_the_ids_of_whole_texts():
    encoder, rng = token_files.Encoder(BPE, 2), random.Random(1)
    parts = ["a", "Z", "é", "'s", "'", "s", "re", " ", "  ", "\n", "\n\n", "1", "½", "_", ".", "!!", "α", "́", " ", "\t", "😀", "don't", " the", " word", "ſ"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 10)))
        assert encoder.encode(text) == encoder.direct(text) + encoder.end


def test_plain_words_need_no_whole_encoding(monkeypatch):
    encoder = token_files.Encoder(BPE, 2)
    want = encoder.direct("Onnuor señal the the naïve") + encoder.end
    monkeypatch.setattr(token_files.Encoder, "direct", lambda *_: pytest.fail("a word went through the whole tokenizer"))
    assert encoder.encode("Onnuor señal the the naïve") == want


def test_many_texts_are_encoded_by_their_distinct_pieces(monkeypatch):
    """Words after blanks go to the library together, whatever is remembered; the ids are those of whole texts."""
    rng = random.Random(2)
    parts = ["a", "Zé", "don't", "'s", "1", ",", ".", ":", "!?", "\n", "\n\n", ".\nThe", " ", " ", " ", "  ", "\t", "\x01", "\x02", "\x00", "α", "ſ", "_b", "x" * 70, "字字", "<s>"]
    texts = [None, "", "\n", " ", *("".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000))]
    for pieces, length in ((700_000, 64), (7, 64), (50, 3), (0, 64)):
        monkeypatch.setattr(token_files, "CACHED_PIECES", pieces)
        monkeypatch.setattr(token_files, "CACHED_LENGTH", length)
        encoder = token_files.Encoder(BPE, 2)
        for some in (texts[:1000], texts[1000:], texts[::-1]):
            assert [x.tobytes() for x in encoder.encode_all(pa.array(some, pa.string()))] == [(encoder.direct(x) if x else b"") + encoder.end for x in some]
        assert len(encoder) <= max(2, pieces)
    encoder = token_files.Encoder(BPE, 2)
    want = [encoder.direct(f"x word{i} word{i}") + encoder.end for i in range(300)]
    monkeypatch.setattr(token_files.Encoder, "direct", lambda *_: pytest.fail("a piece was encoded by itself"))
    assert [x.tobytes() for x in encoder.encode_all(pa.array([f"x word{i} word{i}" for i in range(300)]))] == want


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 20, 32])
def test_packing_is_exact_and_random_access(bits):
    rng = np.random.default_rng(bits)
    documents = [rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 7, 300, 0, 64, 1000)]
    file = token_files.TokenFile(token_files.write_file(documents, bits, block=64))
    assert all((file.document(i) == d).all() and len(file.document(i)) == len(d) for i, d in enumerate(documents))
    whole = np.concatenate(documents)
    assert (file.slice(130, 700) == whole[130:700]).all()
    if bits < 32:
        with pytest.raises(ValueError):
            token_files.write_file([np.array([1 << bits], np.uint32)], bits)


def test_fingerprints(spark, data, docs):
    got, down = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, data).collect()}, docs[::-1]
    for i, r in enumerate(down):
        half, after = len(r.text) // 2, down[(i + 1) % len(down)].text
        edited, mine = r.text[: len(r.text) - half] + after[:half], got[r.doc_id]
        assert mine.n_chars == len(r.text) and mine.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert mine.fingerprint == fingerprints.as_text(fingerprints.vector(r.text)) and mine.edited_fingerprint == fingerprints.as_text(fingerprints.vector(edited))
        assert mine.near_next == fingerprints.likeness(fingerprints.vector(r.text), fingerprints.vector(after))
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.1


def test_fingerprints_are_homomorphic():
    a, b = "one. two\nthree\nfour", "four\none. two\nthree"
    assert fingerprints.as_text(fingerprints.vector(a)) == fingerprints.as_text(fingerprints.vector(b))
    less = fingerprints.delete(fingerprints.vector(a), "three")
    assert fingerprints.as_text(less) == fingerprints.as_text(fingerprints.vector("one. two\nfour"))
    assert fingerprints.as_text(fingerprints.insert(less, "three")) == fingerprints.as_text(fingerprints.vector(a))
    assert fingerprints.as_text(fingerprints.from_text(fingerprints.as_text(less))) == fingerprints.as_text(less)
    assert fingerprints.as_text(fingerprints.vector("x\nx")) != fingerprints.as_text(fingerprints.vector("x"))


def test_best_paths_are_the_librarys(docs):
    """The library reads the same model as a unigram one; its n-best search gives the best path, up to ties and rounding."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    library, mine = SentencePieceProcessor(model_proto=proto.SerializeToString()), sentencepiece_codec.load(PIECES)
    words = sorted({w for r in docs[:60] for w in r.text.split() if w})
    for word, ids in zip(words, sentencepiece_codec.encode_texts(words, mine)):
        own = [mine.pieces[i] for i in np.frombuffer(ids, "<i4")]
        best = library.nbest_encode_as_pieces(word, 2)[0]
        total = lambda x: sum(library.get_score(library.piece_to_id(p)) for p in x)
        assert own == best or total(own) >= total(best)


def test_viterbi_against_all_paths():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "aba", "▁ab"]
    scores = [0, -3.0, -2.0, -2.5, -3.1, -4.0, -3.9, -6.5, -6.0]
    m = sentencepiece_codec.from_parts(pieces, scores, [False] + [True] * 8, 0, [])

    def paths(word):
        if not word:
            return [[]]
        return [[p, *rest] for p in pieces[1:] if word.startswith(p) for rest in paths(word[len(p) :])]

    for n in range(1, 7):
        for letters in itertools.product("ab", repeat=n):
            word = "".join(letters)
            ids = np.frombuffer(sentencepiece_codec.encode_texts([word], m)[0], "<i4")
            best = max(sum(scores[pieces.index(p)] for p in path) for path in paths("▁" + word))
            assert "".join(pieces[i] for i in ids) == "▁" + word and abs(sum(scores[i] for i in ids) - best) < 1e-9
    assert list(np.frombuffer(sentencepiece_codec.encode_texts(["axxb"], m)[0], "<i4")) == [5, 0, 3]


def test_decoding_is_exact(spark, data):
    assert QUERIES["op8_sentencepiece"](spark, data).where("NOT round_trip").count() == 0


def held_out_rate(spark, data, query, column):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = QUERIES[query](spark, data).where("held_out").join(labels, "doc_id").select("score", "predicted", column).collect()
    good, bad = [r.score for r in rows if r[column] == 1], [r.score for r in rows if r[column] == 0]
    return np.mean(np.subtract.outer(good, bad) > 0) + np.mean(np.subtract.outer(good, bad) == 0) / 2, np.mean([r.predicted == r[column] for r in rows])


def test_held_out_quality(spark):
    order, right = held_out_rate(spark, "/root/testdata/sf0.01", "op7_quality", "quality")
    assert order > 0.97 and right > 0.93


def test_held_out_toxicity(spark):
    order, right = held_out_rate(spark, "/root/testdata/sf0.1", "op1_toxicity", "toxic")
    assert order > 0.95 and right > 0.95


def test_non_negative_risk_finds_the_hidden_positives():
    rng = np.random.default_rng(0)

    def text(toxic):
        return np.unique(np.append(rng.integers(1, 40, 8), 0) if toxic else rng.integers(1, 40, 8))

    positive, rest = [text(True) for _ in range(300)], [text(i % 10 == 0) for i in range(1000)]
    w, b = toxicity.fit(positive, rest, 40, prior=0.1)
    shown = [b + w[r].sum() > 0 for r in rest]
    assert np.mean([s == (i % 10 == 0) for i, s in enumerate(shown)]) > 0.97


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(docs, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(abs(sum(r.proportions) - 1) < 1e-3 and r.languages[0] == r.lang_pred for r in rows)


def test_mixtures():
    from weftwork.llm import language_id

    one, two = "the cat sat on that mat with this hat ", "le chat noir est dans la maison avec nous "
    counts = np.full((language_id.BUCKETS, 2), 0.5)
    for i, text in enumerate((one, two)):
        counts[:, i] += np.bincount(language_id.grams(text * 50), minlength=language_id.BUCKETS)
    model = language_id.Model(["en", "fr"], np.log(counts / counts.sum(axis=0)).astype(np.float32))
    (lang, share, found, parts), alone, blank = language_id.infer([one * 3 + two, two, "12 !"], model)
    assert lang == "en" and set(found) == {"en", "fr"} and 0.6 < share < 0.85
    assert alone[0] == "fr" and alone[2] == ["fr"] and blank == ("und", 0.0, [], [])


def test_pipeline_against_plain_python(spark, data):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, docs, data).cache()
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in docs.collect() if r.text and any(c.isalpha() for c in r.text)}
    second = stages["line_dedup"](spark, first, data).cache()
    rows, sites = first.collect(), {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        for line in r.text.split("\n"):
            sites.setdefault(line.strip(" "), (set(), r.doc_id))[0].add(r.source)
    want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if not x.strip(" ") or len(sites[x.strip(" ")][0]) < 10 or sites[x.strip(" ")][1] == r.doc_id) for r in rows}
    assert {r.doc_id: r.text for r in second.collect()} == want
    third = stages["near_dedup"](spark, second, data).cache()
    assert {r.doc_id for r in third.collect()} == {i for i, top in groups(want, 80).items() if i == top}

    def tokens(text):
        import re

        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    windows = {tuple(w[i : i + 10]) for w in map(tokens, bench) if w for i in range(max(1, len(w) - 9))}
    lengths = {len(w) for w in windows}
    fourth = stages["decontamination"](spark, third, data).cache()
    clean = {r.doc_id for r in third.collect() if not any(tuple(w[i : i + n]) in windows for w in [tokens(r.text)] for n in lengths for i in range(len(w) - n + 1))}
    assert {r.doc_id for r in fourth.collect()} == clean
    last = stages["sentencepiece"](spark, fourth, data).collect()
    assert {r.doc_id for r in last} == clean and all(r.round_trip for r in last)
    assert {(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, data).collect()} == {(r.doc_id, tuple(r.ids)) for r in last}


def test_proximity(spark):
    from weftwork.llm import decontamination

    items = spark.createDataFrame([(1, "rare needle word")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a rare needle word b"), (2, "rare fine needle word"), (3, "needle rare word"), (4, "rare one two three needle word")], "doc_id long, text string")
    sought = decontamination.phrases(items, 10)
    assert {r._id for r in decontamination.exact_matches(docs, sought).collect()} == {1}
    assert {r._id for r in decontamination.near_matches(docs, sought, slack=2).collect()} == {1, 2}


@pytest.mark.parametrize("slack", [0, 1, 3])
def test_proximity_against_all_places(spark, slack):
    """Phrases of few words over few letters, with words put in anywhere."""
    from weftwork.llm import decontamination

    rng = random.Random(slack)
    word = lambda: rng.choice("abcdefgh")
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 7)))) for i in range(25)]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 25)))) for i in range(60)] + [(100 + i, " ".join(x for w in t.split() for x in [w, *(["z"] * rng.randint(0, 1))])) for i, t in items]
    found = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 5, slack)

    def near(text, item):
        w, q = text.split(), item.split()
        for at in range(max(1, len(q) - 4)):
            p = q[at : at + 5]
            for s in range(len(w)):
                told = 0
                for x in w[s : s + len(p) + slack]:
                    told += told < len(p) and x == p[told]
                if w[s] == p[0] and told == len(p):
                    return True
        return False

    assert {r.doc_id: r.n_near for r in found.collect()} == {i: sum(near(t, q) for _, q in items) for i, t in docs}


def test_four_languages_in_one_text():
    from weftwork.llm import language_id

    said = ["the cat sat on that mat with this hat ", "le chat noir est dans la maison avec nous ", "der hund lief durch den garten und schlief ", "el perro corre por la calle hacia nosotros "]
    counts = np.full((language_id.BUCKETS, 4), 0.5)
    for i, text in enumerate(said):
        counts[:, i] += np.bincount(language_id.grams(text * 50), minlength=language_id.BUCKETS)
    model = language_id.Model(["a", "b", "c", "d"], np.log(counts / counts.sum(axis=0)).astype(np.float32))
    ((_, share, found, parts),) = language_id.infer(["".join(said) * 3], model)
    assert sorted(found) == ["a", "b", "c", "d"] and abs(sum(parts) - 1) < 1e-3 and share < 0.4


def test_cut_lines_of_a_long_text(spark):
    from weftwork.llm import line_dedup

    common = [f"line {i}" for i in range(400)]
    rows = [(i, "\n".join(x for c in common for x in ([c, f"own {i} {c}"] if i else [c])), f"s{i}") for i in range(4)]
    got = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string"), 3).collect()}
    assert got[0].text == rows[0][1] and all(got[i].text == "\n".join(f"own {i} {c}" for c in common) and got[i].n_removed == 400 for i in (1, 2, 3))


def test_quality_learns_from_every_label(spark, monkeypatch):
    """The model is that of all pairs in one block, whatever the blocks; a label more or less changes it."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = [(i, " ".join(word(rng.randint(2, 9)) for _ in range(20)) + (" ## $$ |" * rng.randint(0, 3) if i % 3 else "")) for i in range(400)]
    docs, labels = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, quality int")
    one = quality.train(docs, labels)
    taught = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    scores = sorted(float(one.raw(quality.features(texts[i][1]))) for i in taught)
    bad = sum(i % 3 > 0 for i in taught)
    assert one.threshold == pytest.approx((scores[bad - 1] + scores[bad]) / 2)
    fewer = quality.train(docs, labels.where(f"doc_id <> {taught[-1]}"))
    assert not np.array_equal(one.mean, fewer.mean)
    monkeypatch.setattr(quality, "BLOCK", 40)
    monkeypatch.setattr(quality, "PARTNERS", 30)
    many = quality.train(docs, labels)
    assert np.allclose(one.mean, many.mean) and np.corrcoef(one.weights, many.weights)[0, 1] > 0.9
