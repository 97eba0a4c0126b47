"""Map elements to venue rows, each element once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.functions.geo import physical
from placemark.functions.text import name_key
from placemark.operators.classify import classified, with_rescues

# Tags that hold a name, the first that is not blank counts.
NAME_KEYS = ("name", "name:sr", "name:sr-Latn", "name:en", "int_name", "official_name", "alt_name", "loc_name", "brand")
KINDS = ("node", "way", "relation")


def filled(tags: Column, *keys: str) -> Column:
    """The first of the tags that is not blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(F.try_element_at(tags, F.lit(k))), F.lit("")) for k in keys])


def address(tags: Column) -> Column:
    part = lambda a, b: F.nullif(F.concat_ws(" ", filled(tags, "addr:" + a), filled(tags, "addr:" + b)), F.lit(""))
    return F.nullif(F.concat_ws(", ", part("street", "housenumber"), part("postcode", "city")), F.lit(""))


def reference(kind: Column, number: Column) -> Column:
    return F.when(kind.isNotNull() & number.isNotNull(), F.concat_ws("/", kind, number.cast("string"))).otherwise("(unknown)")


def once(elements: DataFrame, *within: str) -> DataFrame:
    """The first of each reference by position, in each group of within; elements without one all stay."""
    first = W.partitionBy(*within, "ref").orderBy("position")
    known = elements.where("ref <> '(unknown)'").withColumn("k", F.row_number().over(first)).where("k = 1").drop("k")
    return known.unionByName(elements.where("ref = '(unknown)'"))


def venues(elements: DataFrame, country: str | Column, city: str | Column, rescues: DataFrame | None = None, *within: str) -> DataFrame:
    """Every element once with its bucket (venue, invalid, excluded), reason and venue fields.

    elements: position, type, id, lat, lon, center, tags. No coordinates are ever made up.
    within: columns of what was asked for, kept in the result; an element counts once in each.
    """
    node = F.col("type") == "node"
    rows = once(elements.withColumns({"ref": reference(F.col("type"), F.col("id")), "tags": F.coalesce("tags", F.create_map().cast("map<string,string>")), "country": F.lit(country), "city": F.lit(city)}), *within)
    if rescues is not None:
        rows = with_rescues(rows, rescues)
        verdict = classified(F.col("tags"), F.col("rescue_category"), F.col("bypass"))
    else:
        verdict = classified(F.col("tags"))
    rows = rows.withColumns({"lat": F.when(node, F.col("lat")).otherwise(F.col("center.lat")), "lon": F.when(node, F.col("lon")).otherwise(F.col("center.lon")), "name": filled(F.col("tags"), *NAME_KEYS), "verdict": verdict})
    invalid = (
        F.when(~F.coalesce(F.col("type").isin(*KINDS), F.lit(False)), "unsupported element type")
        .when(F.col("name").isNull(), "missing name")
        .when(~physical(F.col("lat"), F.col("lon")), "missing or invalid coordinates")
    )
    t = F.col("tags")
    return rows.withColumn("problem", invalid).select(
        *within, "ref", F.when(F.col("problem").isNotNull(), "invalid").when(F.col("verdict.accepted"), "venue").otherwise("excluded").alias("bucket"),
        F.coalesce("problem", F.when(~F.col("verdict.accepted"), F.col("verdict.via"))).alias("reason"), "name", name_key(F.col("name")).alias("name_key"), "lat", "lon",
        address(t).alias("address"), filled(t, "website", "contact:website").alias("website"), filled(t, "opening_hours").alias("opening_hours"), filled(t, "wikidata").alias("wikidata"),
        F.col("verdict.category").alias("category"), F.col("verdict.review").alias("review"), F.col("verdict.rescued").alias("rescued"),
    )


def records(found: DataFrame, source: str) -> DataFrame:
    """Venue rows as sync records: what a source omits is absent from the map of fields, not null."""
    fields = F.create_map(*[x for k in ("address", "website", "opening_hours", "wikidata") for x in (F.lit(k), F.col(k))])
    return found.where("bucket = 'venue'").select(
        F.lit(source).alias("source"), F.col("ref").alias("external_id"), F.lit("venue").alias("kind"), "name", "name_key", "lat", "lon", F.map_filter(fields, lambda k, v: v.isNotNull()).alias("provided")
    )
