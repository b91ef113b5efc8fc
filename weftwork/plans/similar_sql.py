"""SQL for the similarity of strings and for the steps of the category cascade, all pairs compared."""

from __future__ import annotations

from weftwork import vocab

# Of ``pairs`` (t, c): the longest common block, first in t and then in c, then the same on both sides of it.
GESTALT = """blocks(t, c, a, b, n) AS (
  SELECT t, c, t, c, 0 FROM pairs
  UNION ALL
  SELECT t, c, unnest([a[:i - 1], a[i + n:]]), unnest([b[:j - 1], b[j + n:]]), unnest([n, 0]) FROM (
    SELECT t, c, a, b, -s.i AS i, s.l AS n, strpos(b, substr(a, -s.i, s.l)) AS j FROM (
      SELECT t, c, a, b, list_max(list_filter(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(range(1, least(length(a) - i + 1, length(b)) + 1), lambda l: {'l': l, 'i': -i}))), lambda x: contains(b, substr(a, -x.i, x.l)))) AS s
      FROM blocks WHERE a <> '' AND b <> '') WHERE s IS NOT NULL)),
gestalt AS (SELECT t, c, 2.0::DOUBLE * sum(n) / (length(t) + length(c)) AS ratio FROM blocks GROUP BY t, c)"""

_q = lambda pattern: pattern.replace("'", "''")


def clean(name: str) -> str:
    once = f"regexp_replace(lower({name}), '{_q(vocab.BRAND_PREFIX)}', '')"
    for pattern, by in ((vocab.SIZE_SPEC, ""), (vocab.FILLER_WORDS, ""), (r"\s+", " ")):
        once = f"regexp_replace({once}, '{_q(pattern)}', '{by}', 'g')"
    return f"trim({once})"


def cascade(names: str, keywords: str) -> str:
    """The category of each distinct ``mod_name`` of the query ``names``; components and keywords are those of ``keywords``.

    Keywords are unique and lower-cased.
    """
    words = lambda t: f"list_distinct(list_filter(string_split_regex(trim({t}), '\\s+'), lambda w: w <> ''))"
    return f"""
WITH RECURSIVE kw AS ({keywords}),
base AS (SELECT DISTINCT mod_name, lower(mod_name) AS raw, {clean("mod_name")} AS clean FROM ({names})),
exact AS (
  SELECT base.*, CASE WHEN trim(mod_name) = '' THEN 'Other' ELSE coalesce(x.category, y.category) END AS category,
    CASE WHEN trim(mod_name) = '' THEN 0.0 WHEN x.category IS NOT NULL THEN 1.0 WHEN y.category IS NOT NULL THEN 0.95 END AS confidence
  FROM base LEFT JOIN kw x ON x.keyword = raw LEFT JOIN kw y ON y.keyword = clean),
openings AS (SELECT * FROM exact WHERE confidence IS NULL),
texts AS (SELECT raw AS t FROM openings WHERE raw <> '' UNION SELECT clean FROM openings WHERE clean <> ''),
keyed AS (
  SELECT t, category, least(length(keyword) / length(t) + least(length(keyword) / 10, 0.3::DOUBLE) + 0.3::DOUBLE, 1.0::DOUBLE) AS score FROM texts JOIN kw ON length(keyword) >= 5 AND contains(t, keyword) AND (length(keyword) >= 8 OR regexp_matches(' ' || t || ' ', '[^\\p{{L}}\\p{{N}}]' || regexp_escape(keyword) || '[^\\p{{L}}\\p{{N}}]'))
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY score DESC, strpos(t, keyword), strpos(t, keyword) + length(keyword)) = 1),
k AS (
  SELECT o.mod_name, o.raw, o.clean, CASE WHEN coalesce(y.score, 0) > coalesce(x.score, 0) THEN y.category ELSE x.category END AS key_category,
    greatest(coalesce(x.score, 0), coalesce(y.score, 0)) AS key_score
  FROM openings o LEFT JOIN keyed x ON x.t = raw LEFT JOIN keyed y ON y.t = clean),
pairs AS (SELECT DISTINCT clean AS t, keyword AS c FROM k, kw WHERE key_score < 0.5 AND clean <> ''), {GESTALT},
fuzzy AS (SELECT t, category, ratio FROM gestalt JOIN kw ON keyword = c QUALIFY row_number() OVER (PARTITION BY t ORDER BY ratio DESC, position) = 1),
unsure AS (SELECT * FROM k WHERE key_score < 0.4),
tried AS (SELECT mod_name, clean AS t, 0 AS turn FROM unsure UNION ALL SELECT mod_name, raw, 1 FROM unsure),
fits AS (
  SELECT t, keyword, category, CASE WHEN contains(t, keyword) THEN least(length(keyword) / length(t) + 0.5, 1.0)
    ELSE len(list_filter(list_intersect({words("t")}, {words("keyword")}), lambda w: length(w) >= 4)) / greatest(len({words("t")}), len({words("keyword")})) END AS score
  FROM (SELECT DISTINCT t FROM tried WHERE t <> ''), kw),
per_category AS (SELECT t, category, max(score) AS score FROM fits WHERE score > 0 GROUP BY ALL),
places AS (SELECT category, min(position) AS position FROM kw GROUP BY 1),
over AS (
  SELECT mod_name, category, score FROM tried JOIN per_category USING (t) JOIN places USING (category)
  QUALIFY row_number() OVER (PARTITION BY mod_name ORDER BY score DESC, position, turn) = 1),
j AS (
  SELECT k.*, f.category AS comp_category, coalesce(f.ratio, 0) AS comp, greatest(key_score, coalesce(o.score, 0)) AS word_score,
    CASE WHEN coalesce(o.score, 0) > key_score THEN o.category ELSE key_category END AS word_category
  FROM k LEFT JOIN fuzzy f ON f.t = clean LEFT JOIN over o USING (mod_name))
SELECT mod_name, category, round(confidence::DOUBLE, 6) AS confidence FROM exact WHERE confidence IS NOT NULL
UNION ALL SELECT mod_name,
  CASE WHEN key_score >= 0.5 THEN key_category WHEN comp >= 0.8 THEN comp_category WHEN word_score >= 0.4 THEN word_category WHEN comp >= 0.5 THEN comp_category WHEN word_score >= 0.25 THEN word_category ELSE 'Other' END,
  round(CASE WHEN key_score >= 0.5 THEN key_score WHEN comp >= 0.8 THEN comp WHEN word_score >= 0.4 THEN word_score WHEN comp >= 0.5 THEN comp WHEN word_score >= 0.25 THEN word_score ELSE 0 END::DOUBLE, 6)
FROM j"""
