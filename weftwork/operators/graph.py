"""A property graph as two tables.

entities(id, type, name, observations, properties, created_at, updated_at) and
relations(id, from_id, to_id, relation_type, properties, created_at).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.operators.filters import build_title

ENTITY_COLUMNS = ["id", "type", "name", "observations", "properties"]
RELATION_COLUMNS = ["id", "from_id", "to_id", "relation_type"]


def named_relations(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Relations with name and type of both ends."""
    ends = entities.select("id", "name", "type")
    a = ends.select(F.col("id").alias("from_id"), F.col("name").alias("from_entity"), F.col("type").alias("from_type"))
    b = ends.select(F.col("id").alias("to_id"), F.col("name").alias("to_entity"), F.col("type").alias("to_type"))
    joined = relations.join(a, "from_id").join(b, "to_id")
    return joined.select("from_entity", "from_type", "relation_type", "to_entity", "to_type")


def touching(relations: DataFrame, chosen: DataFrame, key: str = "id") -> DataFrame:
    """Relations with at least one end in the chosen set.

    Two existence joins instead of one OR condition, which Spark could only run
    as a nested loop.
    """
    ids = chosen.select(F.col(key).alias("_id")).distinct()
    a = ids.select(F.col("_id").alias("from_id"), F.lit(True).alias("_from"))
    b = ids.select(F.col("_id").alias("to_id"), F.lit(True).alias("_to"))
    joined = relations.join(a, "from_id", "left").join(b, "to_id", "left")
    return joined.where(F.col("_from").isNotNull() | F.col("_to").isNotNull()).select(*relations.columns)


def within(relations: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """Relations with both ends in the node set."""
    ids = nodes.select(key).distinct()
    return (
        relations.join(ids.withColumnRenamed(key, "from_id"), "from_id", "left_semi")
        .join(ids.withColumnRenamed(key, "to_id"), "to_id", "left_semi").select(*relations.columns)
    )


def stats(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Counts by entity and relation type, and observations in total and on average."""
    size = F.coalesce(F.size("observations"), F.lit(0))
    types = entities.groupBy(F.col("type").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("o"))
    by_type = types.select(F.lit("entity").alias("part"), "name", F.col("n").cast("double").alias("value"))
    by_relation = relations.groupBy(F.col("relation_type").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    observed = types.agg(F.sum("o").cast("double").alias("total"), F.round(F.try_divide(F.sum("o"), F.sum("n")), 1).alias("average"))
    observed = observed.unpivot([], ["total", "average"], "name", "value").select(F.lit("observations").alias("part"), "name", "value")
    return by_type.union(by_relation.select(F.lit("relation").alias("part"), "name", "value")).union(observed)


def _id(kind: str, *parts) -> Column:
    return F.concat(F.lit(kind + "_"), F.substring(F.md5(F.concat_ws("|", *parts)), 1, 16))


def build_entities(builds: DataFrame) -> DataFrame:
    """One entity per build; ids derive from the build id, so a second run gives the same ones."""
    fields = [f for f in (
        "build_id", "year", "make", "model", "trim", "generation", "engine", "transmission", "drivetrain",
        "build_type", "modification_level", "extraction_confidence", "source_url",
    ) if f in builds.columns]
    notes = [F.when(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("")) != "", F.concat(F.lit(label), F.col(c)))
             for c, label in (("build_type", "Build type: "), ("modification_level", "Mod level: "), ("engine", "Engine: ")) if c in builds.columns]
    return builds.select(
        _id("build", F.col("build_id").cast("string")).alias("id"), F.lit("build").alias("type"), build_title().alias("name"),
        F.array_compact(F.array(*notes)).alias("observations"), F.to_json(F.struct(*fields)).alias("properties"),
    )


def mod_rows(builds: DataFrame) -> DataFrame:
    """Modifications as rows (build_id, at, mod)."""
    return builds.select("build_id", F.posexplode("modifications").alias("at", "mod"))


def mod_entities(builds: DataFrame) -> DataFrame:
    m = F.col("mod")
    return mod_rows(builds).select(
        _id("modification", F.col("build_id").cast("string"), F.col("at").cast("string")).alias("id"),
        F.lit("modification").alias("type"), F.coalesce(F.nullif(m["name"], F.lit("")), F.lit("Unknown Modification")).alias("name"),
        F.array_compact(F.array(
            F.when(m["brand"] != "", F.concat(F.lit("Brand: "), m["brand"])),
            F.when(m["category"] != "", F.concat(F.lit("Category: "), m["category"])),
        )).alias("observations"), F.to_json("mod").alias("properties"),
    )


def build_relations(builds: DataFrame, source: str = "source") -> DataFrame:
    """source → build and build → modification."""
    build = _id("build", F.col("build_id").cast("string"))
    contains = builds.select(
        _id("rel", F.col(source), build).alias("id"), _id("source", F.col(source)).alias("from_id"), build.alias("to_id"),
        F.lit("contains_build").alias("relation_type"),
    )
    mod = _id("modification", F.col("build_id").cast("string"), F.col("at").cast("string"))
    has = mod_rows(builds).select(
        _id("rel", build, mod).alias("id"), build.alias("from_id"), mod.alias("to_id"), F.lit("has_modification").alias("relation_type")
    )
    return contains.unionByName(has)


def source_entities(sources: DataFrame, source: str = "source") -> DataFrame:
    return sources.select(
        _id("source", F.col(source)).alias("id"), F.lit("source").alias("type"), F.col(source).alias("name"),
        F.array().cast("array<string>").alias("observations"), F.to_json(F.struct(source)).alias("properties"),
    )


def ingest_builds(builds: DataFrame, source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Entities and relations of sources, builds and modifications."""
    sources = source_entities(builds.select(source).where(F.col(source).isNotNull()).distinct(), source)
    entities = sources.unionByName(build_entities(builds)).unionByName(mod_entities(builds))
    return entities, build_relations(builds, source)


def append_entities(entities: DataFrame, new: DataFrame) -> DataFrame:
    """New entities added; ids that exist already stay as they are."""
    return entities.unionByName(new.join(entities.select("id"), "id", "left_anti"), allowMissingColumns=True)


def observation_rows(entities: DataFrame, notes: DataFrame) -> DataFrame:
    """Observations as rows (id, at, note): those entities have, then new notes of known entities.

    The form for entities with very many notes; no group is collected.
    """
    held = entities.select("id", F.posexplode("observations").alias("position", "note")).select("id", F.lit(None).cast(notes.schema["at"].dataType).alias("at"), "position", "note")
    new = notes.join(entities.select("id"), "id", "left_semi").select("id", "at", F.lit(None).cast("int").alias("position"), "note")
    return held.unionByName(new)


def add_observations(entities: DataFrame, notes: DataFrame) -> DataFrame:
    """Notes (id, at, note) appended in order to the arrays of known entities.

    An entity's array is one value; use ``observation_rows`` where it would not fit one.
    """
    collected = notes.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "note"))), lambda x: x["note"]).alias("_notes"))
    out = entities.join(collected, "id", "left")
    return out.withColumn("observations", F.concat("observations", F.coalesce("_notes", F.array().cast("array<string>")))).select(*entities.columns)


def append_relations(relations: DataFrame, new: DataFrame, entities: DataFrame) -> DataFrame:
    """New relations whose both ends exist."""
    return relations.unionByName(within(new, entities), allowMissingColumns=True)


def source_view(entities: DataFrame) -> DataFrame:
    """Source entities with status and counters from their properties."""
    parsed = F.try_parse_json("properties")

    def number(path):
        return F.try_variant_get(parsed, path, "int")

    return entities.where("type = 'source'").select(
        "name", F.try_variant_get(parsed, "$.status", "string").alias("status"),
        number("$.pipeline.urlsFound").alias("urls_found"), number("$.pipeline.htmlScraped").alias("html_scraped"),
        number("$.pipeline.builds").alias("builds"), number("$.pipeline.mods").alias("mods"),
    )


