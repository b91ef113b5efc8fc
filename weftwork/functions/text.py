"""Text columns: finding, redacting, cleaning, naming."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork import vocab
from weftwork.functions.urls import _col

# Amp last, so that an escaped entity is decoded once only.
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def collapse(text) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"\s+", " "))


def decode_entities(text: Column) -> Column:
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), _ENTITIES, text)


def visible_text(html, preserve_structure: bool = False, tags_only: bool = False) -> Column:
    """Text a reader would see.

    ``tags_only`` drops scripts, styles and tags but keeps the head and leaves
    entities alone; ``preserve_structure`` keeps one line per block element.
    """
    text = _col(html)
    removed = ["script", "style"] if tags_only else ["script", "style", "head", "noscript"]
    for tag in removed:
        text = F.regexp_replace(text, rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "" if tags_only else " ")
    if not tags_only:
        text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    if preserve_structure:
        text = F.regexp_replace(text, r"\s+", " ")
        text = F.regexp_replace(text, r"(?i)</(?:p|div|h[1-6]|li)>|<br\s*/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]+>", " ")
    if not tags_only:
        text = decode_entities(text)
    if preserve_structure:
        text = F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r" *\n[ \n]*", "\n")
        return F.regexp_replace(text, r"^\s+|\s+$", "")
    return collapse(text)


def visible_text_parsed() -> Column:
    """``visible_text`` through a real HTML parser, for markup the regular expressions cannot follow."""

    @F.pandas_udf(T.StringType())
    def parse(pages: pd.Series) -> pd.Series:
        from html.parser import HTMLParser

        class Reader(HTMLParser):
            hidden = {"script", "style", "head", "noscript"}

            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.depth, self.out = 0, []

            def handle_starttag(self, tag, attrs):
                self.depth += tag in self.hidden

            def handle_endtag(self, tag):
                self.depth -= tag in self.hidden and self.depth > 0

            def handle_data(self, data):
                if not self.depth:
                    self.out.append(data)

        def one(page):
            if page is None:
                return None
            reader = Reader()
            reader.feed(page)
            reader.close()
            return " ".join(" ".join(reader.out).split())

        return pages.map(one, na_action=None)

    return parse


def find_emails(text) -> Column:
    return F.array_distinct(F.regexp_extract_all(_col(text), F.lit(vocab.EMAIL), F.lit(0)))


def is_email(text) -> Column:
    return _col(text).rlike(f"^{vocab.EMAIL}$")


def find_urls(text) -> Column:
    return F.array_distinct(F.regexp_extract_all(_col(text), F.lit(vocab.URL_IN_TEXT), F.lit(0)))


def redact(text) -> Column:
    """Secrets in free text replaced by ``[REDACTED]``."""
    return reduce(
        lambda t, rule: F.regexp_replace(t, "(?i)" + rule[0], rule[1]), vocab.SECRET_PATTERNS, _col(text)
    )


def redact_headers(headers) -> Column:
    """Values of header keys that hold secrets replaced."""
    secret = "|".join(vocab.SECRET_KEYS)
    return F.transform_values(
        _col(headers), lambda key, value: F.when(F.lower(key).rlike(secret), F.lit("[REDACTED]")).otherwise(value)
    )


def normalize_name(text) -> Column:
    """A product name without leading brand, sizes and filler words."""
    name = F.regexp_replace(F.lower(_col(text)), vocab.BRAND_PREFIX, "")
    name = F.regexp_replace(name, vocab.SIZE_SPEC, "")
    name = F.regexp_replace(name, vocab.FILLER_WORDS, "")
    return collapse(name)


def is_garbage(value) -> Column:
    """Placeholders, symbols only, or too short; null counts as garbage."""
    trimmed = F.regexp_replace(_col(value).cast("string"), r"^\s+|\s+$", "")
    pattern = "(?iU)" + "|".join(vocab.GARBAGE_PATTERNS)
    return F.coalesce(trimmed.rlike(pattern), F.lit(True))


def strip_ansi(text) -> Column:
    return F.regexp_replace(_col(text), vocab.ANSI_ESCAPE, "")


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def first_containing(text: Column, rules, default=None) -> Column:
    """The value of the first (word, value) rule whose word the text contains."""
    out = F
    for word, value in rules:
        out = out.when(text.contains(word), F.lit(value))
    return out.otherwise(F.lit(default))


def provider(model) -> Column:
    """Model vendor from the model name."""
    return first_containing(F.lower(_col(model)), vocab.PROVIDERS)


def file_type(path) -> Column:
    """Lower-cased suffix of a file name, null without one."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.nullif(F.lower(F.regexp_extract(name, r"^.+\.([^.]+)$", 1)), F.lit(""))


def capitalised_items(text) -> Column:
    """Comma-separated items that start with a capital, 4 to 99 characters long."""
    # A lazy body up to a comma, a full stop or the end, as in a printed list.
    found = F.regexp_extract_all(_col(text), F.lit(r"(?:^|,\s*)([A-Z][^,]+?)(?=,|$|\.)"), F.lit(1))
    trimmed = F.transform(found, lambda item: F.trim(item))
    return F.filter(trimmed, lambda item: (F.length(item) > 3) & (F.length(item) < 100))


def _hits(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [text.contains(w).cast("int") for w in words])


def verdict(text) -> Column:
    """A free-text reply read as pass or fail, with reasoning and confidence."""
    reply = F.regexp_replace(_col(text), r"^\s+|\s+$", "")
    reason = F.regexp_extract(reply, r"(?is)FAIL[:\s]*(.*)", 1)
    lowered = F.lower(reply)
    leaning = _hits(lowered, vocab.POSITIVE_INDICATORS) > _hits(lowered, vocab.NEGATIVE_INDICATORS)

    def row(passed, why, confidence):
        return F.struct(
            F.lit(passed).alias("passed"), why.alias("reasoning"), F.lit(confidence).alias("confidence")
        )

    return (
        F.when(F.upper(reply).startswith("PASS"), row(True, F.lit("Visual check successful"), 0.9))
        .when(lowered.contains("fail"), row(False, F.when(F.trim(reason) == "", "Criteria not met").otherwise(F.trim(reason)), 0.8))
        .when(leaning, row(True, F.lit("Inferred pass from response"), 0.6))
        .otherwise(row(False, _col(text), 0.5))
    )
