"""The registered query of each operator, with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm import collocations, decontamination, fingerprints, hard_negatives, jaccard_join, language_id, licences, line_dedup, near_dedup, quality, sentencepiece_codec, token_files, toxicity
from weftwork.llm.common import held_out


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model, threshold=0.7).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_table(spark, folder, "documents"), licences.default_templates(spark), percent=80)


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = token_files.write(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return token_files.read(spark.read.parquet(path), ids=False)


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, folder, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language_id.train(docs.where(~held_out()).select("text", "lang"))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "languages", "proportions")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, folder, "labels"))
    return quality.score(docs, model, threshold=0.5).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_codec.encode(_table(spark, folder, "documents").select("doc_id", "text"), path, verify=True)
    return coded.select("doc_id", "ids", "n_tokens", "round_trip")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), size=10, slack=2)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated", "n_near")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(_table(spark, folder, "documents"), min_sites=10).select("doc_id", "text", "n_lines", "n_removed")


def op11_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(spark, _table(spark, folder, "documents"), size=3, percent=90)


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"), least=10, longest=3, share=50, most=2000)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), every=100, positives=5, negatives=5, low=80, high=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_licences": op2_licences,
    "op3_token_files": op3_token_files,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_fingerprints": op5_fingerprints,
    "op6_language_id": op6_language_id,
    "op7_quality": op7_quality,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

_LICENCES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licences.TEMPLATES)
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOW + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op2_licences": f"""
WITH t AS (SELECT licence, {_WORDS.format("text")} AS w FROM (VALUES {_LICENCES}) AS x(licence, text)),
k AS (SELECT *, least(5, len(w)) AS k FROM t),
ts AS (SELECT DISTINCT licence, k, array_to_string(w[i:i + k - 1], ' ') AS h FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM k)),
c AS (SELECT licence, count(*) AS m, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS s FROM ts GROUP BY 1),
d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
ds AS (SELECT doc_id, k, i - 1 AS place, array_to_string(w[i:i + k - 1], ' ') AS h FROM (SELECT d.*, n.k, unnest(range(1, len(w) - n.k + 2)) AS i FROM d, (SELECT DISTINCT k FROM k) n WHERE len(w) >= n.k)),
hit AS (SELECT doc_id, ts.licence, m, place, ds.h, unnest([CAST(floor(place / s) AS BIGINT), CAST(floor(place / s) AS BIGINT) - 1]) AS win FROM ds JOIN ts USING (k, h) JOIN c USING (licence)),
held AS (SELECT doc_id, licence, m, win, count(DISTINCT h) AS n, min(place) AS first FROM hit GROUP BY ALL HAVING count(DISTINCT h) * 100 >= m * 80)
SELECT doc_id, licence, max(n / m) AS containment, min(first) AS first_word, count(*) AS windows FROM held GROUP BY ALL""",
    "op9_decontamination": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
v AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS phrase, least(len(w), 10) AS n FROM v),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, sizes WHERE len(w) >= n),
h AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS phrase FROM g),
hit AS (SELECT h.doc_id, h.s, h.n, p.item_id FROM h JOIN p ON h.phrase = p.phrase AND h.n = p.n),
pos AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d),
ends AS (SELECT phrase, n, string_split(phrase, ' ')[1] AS a, string_split(phrase, ' ')[n] AS z, unnest(range(0, 3)) AS more FROM (SELECT DISTINCT phrase, n FROM p)),
spans AS (
  SELECT DISTINCT x.doc_id, x.i AS s, y.i AS e, phrase FROM ends JOIN pos x ON x.t = a JOIN pos y ON y.doc_id = x.doc_id AND y.i = x.i + n - 1 + more AND y.t = z),
close AS (
  SELECT DISTINCT spans.doc_id, item_id FROM spans JOIN d ON d.doc_id = spans.doc_id JOIN p USING (phrase)
  WHERE regexp_full_match(array_to_string(w[s:e], ' '), replace(phrase, ' ', '( [^ ]+){0,2} '))),
near AS (SELECT doc_id, count(*) AS n_near FROM close GROUP BY 1),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)""",
    "op10_line_dedup": r"""
WITH l AS (
  SELECT doc_id, source, unnest(x) AS line, generate_subscripts(x, 1) AS place
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS x FROM documents)),
b AS (SELECT trim(line, ' ') AS t, min(doc_id) AS first FROM l WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= 10),
m AS (SELECT l.*, b.t IS NOT NULL AND b.first <> l.doc_id AS cut FROM l LEFT JOIN b ON trim(l.line, ' ') = b.t),
r AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT cut), '') AS text, count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed FROM m GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN r USING (doc_id)""",
    "op11_jaccard_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * k >= 90 * (ca.n + cb.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(any_value(c.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY 1""",
    "op12_collocations": r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
g AS (SELECT lang, w[i:i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)),
f AS (SELECT lang, array_to_string(p, ' ') AS phrase, any_value(p) AS p, count(*) AS f FROM g GROUP BY 1, 2),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
cut AS (
  SELECT lang, phrase, f AS a, k, array_to_string(p[1:k], ' ') AS x, array_to_string(p[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM f WHERE f >= 10 AND len(p) > 1)),
v AS (
  SELECT cut.*, fx.f AS l, fy.f AS r, (1000000::HUGEINT * a * a) // (fx.f::HUGEINT * fy.f) AS score
  FROM cut JOIN f fx ON fx.lang = cut.lang AND fx.phrase = x JOIN f fy ON fy.lang = cut.lang AND fy.phrase = y),
best AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM f o WHERE o.lang = best.lang AND len(o.p) = 3 AND o.f >= 10 AND o.phrase <> best.phrase AND 100 * o.f >= 50 * best.a
      AND (array_to_string(o.p[1:2], ' ') = best.phrase OR array_to_string(o.p[2:3], ' ') = best.phrase)))
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
  SELECT kept.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) JOIN total USING (lang) WHERE rank <= 2000""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, label, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM v),
s AS (
  SELECT a.vec_id AS anchor, b.vec_id AS id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.i = b.i WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 5""",
}
