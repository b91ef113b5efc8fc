"""Rules on whole records: arrays, structs, maps, JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork import vocab
from weftwork.functions.buckets import mod_level
from weftwork.functions.urls import _col, netloc, scheme

ISSUE = "struct<field:string,message:string,severity:string>"


def issue(field: str, message, severity: str = "error") -> Column:
    text = F.lit(message) if isinstance(message, str) else message
    return F.struct(F.lit(field).alias("field"), text.alias("message"), F.lit(severity).alias("severity"))


def not_in(value, allowed: list[str]) -> Column:
    """Set and outside the vocabulary."""
    return F.coalesce(~_col(value).isin(allowed), F.lit(False))


def record_issues(as_of_year: int = 2026) -> Column:
    """Every broken rule of a build record as (field, message, severity).

    Expects the columns of ``schemas.BUILD``.
    """
    c = F.col
    year = c("year").cast("string")
    four = year.rlike(r"^\d{4}$")
    year_number = F.when(four, year.try_cast("int"))
    level = mod_level(F.size("modifications"))
    has_mods = F.coalesce(F.size("modifications") > 0, F.lit(False))
    sale_type = c("source_type").isin(vocab.SALE_SOURCE_TYPES)
    story_type = c("source_type").isin([t for t in vocab.SOURCE_TYPES if t not in vocab.SALE_SOURCE_TYPES])
    rules = [F.when(c(f).isNull(), issue(f, "Required field missing or null")) for f in vocab.REQUIRED_FIELDS]
    for field, allowed, severity in [
        ("source_type", vocab.SOURCE_TYPES, "error"), ("build_type", vocab.BUILD_TYPES, "warning"),
        ("transmission", vocab.TRANSMISSIONS, "error"), ("drivetrain", vocab.DRIVETRAINS, "error"),
        ("modification_level", vocab.MOD_LEVELS, "error"),
    ]:
        rules.append(F.when(not_in(field, allowed), issue(field, F.concat(F.lit("Invalid value '"), c(field), F.lit("'")), severity)))
    rules += [
        F.when(~four, issue("year", F.concat(F.lit("Must be 4-digit year, got '"), year, F.lit("'")))),
        F.when(
            (year_number < 1885) | (year_number > as_of_year + 2),
            issue("year", F.concat(F.lit("Year "), year, F.lit(" seems invalid")), "warning"),
        ),
        F.when(~c("source_url").rlike("^https?://"), issue("source_url", "Must be a valid URL")),
        F.when(~c("vin").rlike(vocab.VIN), issue("vin", F.concat(F.lit("Invalid VIN format: "), c("vin")), "warning")),
        F.when(~c("extraction_confidence").between(0, 1), issue("extraction_confidence", "Must be between 0.0 and 1.0")),
        F.when(sale_type & c("sale_data").isNull(), issue("sale_data", "Should be present for this source_type", "warning")),
        F.when(story_type & c("sale_data").isNotNull(), issue("sale_data", "Should be null for this source_type", "info")),
        F.when(
            has_mods & (c("modification_level") != level),
            issue("modification_level", F.concat(F.lit("Does not match mod count, expected: "), level), "info"),
        ),
    ]
    nested = F.transform(
        F.filter(
            F.transform("modifications", lambda m, i: F.struct(i.alias("i"), (m["name"].isNull() | m["category"].isNull()).alias("bad"))),
            lambda x: x["bad"],
        ),
        lambda x: F.struct(
            F.concat(F.lit("modifications["), x["i"].cast("string"), F.lit("]")).alias("field"),
            F.lit("Missing required fields 'name' and/or 'category'").alias("message"),
            F.lit("error").alias("severity"),
        ),
    )
    return F.concat(F.array_compact(F.array(*rules)), F.coalesce(nested, F.array().cast(f"array<{ISSUE}>")))


def json_type_issues(value, schema: T.StructType, required: list[str] = (), enums: dict[str, list[str]] | None = None) -> Column:
    """Checks a JSON text against a record type: unreadable, missing or mistyped fields, values outside enums."""
    value = _col(value)
    parsed = F.from_json(value, schema, {"mode": "PERMISSIVE"})
    raw = F.try_parse_json(value)
    checks = [F.when(raw.isNull(), issue("$", "Invalid JSON"))]
    for field in schema.fields:
        given = F.get_json_object(value, f"$.{field.name}")
        checks.append(F.when(raw.isNotNull() & given.isNotNull() & parsed[field.name].isNull(), issue(field.name, f"Is not of type {field.dataType.simpleString()}")))
        if field.name in required:
            checks.append(F.when(raw.isNotNull() & given.isNull(), issue(field.name, "Required property is missing")))
        for allowed in [(enums or {}).get(field.name)]:
            if allowed:
                checks.append(F.when(not_in(parsed[field.name], allowed), issue(field.name, "Is not one of the allowed values")))
    return F.array_compact(F.array(*checks))


def is_json(value) -> Column:
    return F.try_parse_json(_col(value)).isNotNull()


def json_count(value, path: str) -> Column:
    """Length of the array, or the number, at ``path``; null if there is neither."""
    found = F.get_json_object(_col(value), path)
    return F.coalesce(F.json_array_length(found), found.try_cast("int"))


def assertion(value, condition: str, expected=None, path: str = "$") -> Column:
    """One named assertion on a text or JSON column; a missing target fails."""
    value = _col(value)
    checks: dict[str, Callable[[], Column]] = {
        "exists": lambda: value.isNotNull(),
        "not_empty": lambda: F.length(value) > 0,
        "json_valid": lambda: is_json(value),
        "count_gte": lambda: json_count(value, path) >= expected,
        "count_lte": lambda: json_count(value, path) <= expected,
        "count_eq": lambda: json_count(value, path) == expected,
        "contains_text": lambda: value.contains(str(expected)),
        "matches_pattern": lambda: value.rlike(str(expected)),
        "json_has_field": lambda: F.get_json_object(value, path).isNotNull(),
    }
    if condition not in checks:
        raise ValueError(f"unknown condition: {condition}")
    return F.coalesce(checks[condition](), F.lit(False))


def count_where(array, test: Callable[[Column], Column]) -> Column:
    """Elements of an array that pass ``test``; null counts as not passing."""
    return F.size(F.filter(_col(array), lambda x: F.coalesce(test(x), F.lit(False))))


def completion(array, test: Callable[[Column], Column]) -> Column:
    """``complete`` when there are elements and all pass, else ``active``."""
    done = count_where(array, test)
    return F.when((F.size(_col(array)) > 0) & (done == F.size(_col(array))), "complete").otherwise("active")


def update_element(array, key: str, value, **changes) -> Column:
    """The array with fields of the matching element replaced."""

    def change(item):
        out = item
        for name, new in changes.items():
            out = out.withField(name, new if isinstance(new, Column) else F.lit(new))
        return F.when(item[key] == value, out).otherwise(item)

    return F.transform(_col(array), change)


def next_open(stories) -> Column:
    """The first element that has not passed, by priority, then id."""
    open_ = F.filter(_col(stories), lambda s: ~F.coalesce(s["passes"], F.lit(False)))
    ranked = F.array_sort(F.transform(open_, lambda s: F.struct(s["priority"].alias("priority"), s["id"].alias("id"), s.alias("story"))))
    return F.get(ranked, F.lit(0))["story"]


def image_checks(images) -> Column:
    """Counts over an image array: all, badly formed, placeholders (well-formed only)."""
    real = F.filter(_col(images), lambda i: i.isNotNull() & (i != ""))
    well = F.filter(real, lambda i: (scheme(i) != "") & (netloc(i) != ""))
    return F.struct(
        F.size(real).alias("total"),
        (F.size(real) - F.size(well)).alias("invalid"),
        F.size(F.filter(well, lambda i: i.rlike(vocab.PLACEHOLDER_IMAGE))).alias("placeholder"),
    )


def has_header(headers, names: list[str]) -> Column:
    """True if any of the (lower-case) header names is present, in any case."""
    lowered = F.transform(F.map_keys(_col(headers)), F.lower)
    return F.coalesce(F.arrays_overlap(lowered, F.array(*map(F.lit, names))), F.lit(False))


def merge_structs(old, new, fields: list[str]) -> Column:
    """Field by field: the new value where it is set, else the old one."""
    old, new = _col(old), _col(new)
    return F.struct(*[F.coalesce(new[f], old[f]).alias(f) for f in fields])


def merge_maps(old, new) -> Column:
    """``{**old, **new}`` for map columns."""
    old, new = _col(old), _col(new)
    kept = F.map_filter(old, lambda key, _: ~F.array_contains(F.map_keys(new), key))
    return F.coalesce(F.map_concat(kept, new), new, old)
