"""Venues that events name: the gate on names, matching with and without venue pages, first sight of a new venue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.functions.text import name_key
from placemark.operators.match import cross_source, match

# Names of events' venues that are none, with the code that tells which kind.
PLACEHOLDERS = {
    "placeholder-unknown": "^(unknown|nepoznat[oa]?|nepoznata lokacija)$",
    "placeholder-na": "^(n/?a|-+|\\.+|\\?+|tbd|tba|tbc)$",
    "placeholder-to-be-announced": "^(to be (announced|confirmed|determined)|location (tba|tbd|tbc|to be announced)|lokacija[ -].*(uskoro|naknadno|tba)|uskoro)$",
    "placeholder-various-locations": "^(various( locations?)?|multiple locations?|razne? lokacij\\w*|vi[šs]e lokacija|na vi[šs]e lokacija)$",
    "online-event": "^(online( event)?|onlajn\\w*|virtu(al|eln\\w*)|live ?stream\\w*|stream(ing)?|zoom|youtube|twitch)$|\\b(online|livestream|live stream|webinar)\\b",
}
# Words that alone name no venue.
GENERIC_NAMES = ("bar", "klub", "club", "kafe", "kafic", "cafe", "pab", "pub", "splav", "sala", "bina", "stage", "dvorana")
# Folded city text and the city it stands for.
CITY_ALIASES = {"beograd": "Belgrade", "belgrade": "Belgrade", "novi sad": "Novi Sad", "nis": "Niš", "nis srbija": "Niš"}


def name_gate(name: Column, normalized: Column) -> Column:
    """Why an event's venue name is none - a placeholder, empty once folded, too short, in this order - or null."""
    shown = F.trim(F.coalesce(name, F.lit("")))
    code = F
    for kind, pattern in PLACEHOLDERS.items():
        code = code.when(shown.rlike("(?i)" + pattern), kind)
    return code.when(F.coalesce(normalized, F.lit("")) == "", "empty-normalized-name").when(F.length(shown) < 2, "name-too-short")


def generic_name(normalized: Column) -> Column:
    return normalized.isin(*GENERIC_NAMES)


def match_city_text(rows: DataFrame, cities: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """rows (row_id, city_text) -> (row_id, city_id): the alias table, else the name itself or folded equality; the first city by id.

    cities: city_id, city.
    """
    table = CITY_ALIASES if aliases is None else aliases
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair]) if table else F.create_map().cast("map<string,string>")
    asked = rows.where("city_text <> ''").withColumn("folded", name_key(F.regexp_replace("city_text", "-", " ")))
    asked = asked.withColumn("wanted", F.coalesce(F.try_element_at(known, F.col("folded")), F.col("city_text")))
    # A city is met by its own name or by its fold: both are keys of one join.
    asked = asked.select("row_id", F.explode(F.array(F.concat(F.lit("="), "wanted"), F.concat(F.lit("~"), name_key(F.regexp_replace("wanted", "-", " "))))).alias("key"))
    named = cities.select("city_id", F.explode(F.array(F.concat(F.lit("="), "city"), F.concat(F.lit("~"), name_key(F.col("city"))))).alias("key"))
    found = asked.join(named, "key").groupBy("row_id").agg(F.min("city_id").alias("city_id"))
    return rows.select("row_id").join(found, "row_id", "left")


def match_event_venues(events: DataFrame, stored: DataFrame, identities: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(event_id, status, code, tier, venue_id): matched, review or unresolved.

    A curated cross-source identity of the source's own venue id is above any
    name; then the tiers inside the city. An alias match beyond the guard is a
    review, never a match.

    events: event_id, source, source_venue_id, country, city (null: unresolved), name, name_key, lat, lon.
    """
    own = F.trim(F.coalesce("source_venue_id", F.lit("")))
    asked = events.withColumn("own", own).withColumn("named", (own != "") | (F.trim(F.coalesce("name", F.lit(""))) != ""))
    ready = asked.where(F.col("named") & F.col("city").isNotNull())
    rows = ready.where("own <> ''").select(F.col("event_id").alias("row_id"), "source", F.col("own").alias("external_id"), "country", "city")
    curated = cross_source(rows, identities, stored).select(F.col("row_id").alias("event_id"), F.col("status").alias("curated"), F.col("venue_id").alias("curated_id"))
    none = F.lit(None).cast("string")
    incoming = ready.join(curated, "event_id", "left_anti").select(
        F.col("event_id").alias("incoming_id"), "city", "source", F.when(F.col("own") != "", F.col("own")).otherwise(F.concat(F.lit("name:"), "name_key")).alias("external_id"),
        none.alias("wikidata"), none.alias("website"), "name_key", "lat", "lon",
    )
    met = match(incoming, stored, aliases).withColumnRenamed("incoming_id", "event_id").withColumnRenamed("venue_id", "met_id").withColumnRenamed("tier", "met_tier")
    row = lambda status, code: F.struct(F.lit(status).alias("status"), F.lit(code).cast("string").alias("code"))
    kind = F.col("kind")
    outcome = (
        F.when(~F.col("named"), row("unresolved", "no-venue-identity"))
        .when(F.col("city").isNull(), row("unresolved", "city-unresolved"))
        .when(F.col("curated") == "found", row("matched", None))
        .when(F.col("curated") == "missing", row("review", "venue-identity-target-missing"))
        .when(F.col("curated") == "conflict", row("review", "venue-identity-conflict"))
        .when((kind == "match") & ~F.col("review"), row("matched", None))
        .when(kind == "match", row("review", "venue-alias-beyond-guard"))
        .when(kind == "skip", row("review", "venue-ambiguous"))
        .otherwise(row("unresolved", "no-existing-venue"))
    )
    out = asked.join(curated, "event_id", "left").join(met, "event_id", "left").withColumn("o", outcome)
    matched = F.col("o.status") == "matched"
    return out.select(
        "event_id", "o.status", "o.code", F.when(matched, F.when(F.col("curated") == "found", 0).otherwise(F.col("met_tier"))).alias("tier"),
        F.when(matched, F.coalesce("curated_id", "met_id")).alias("venue_id"),
    )


def resolve_with_pages(events: DataFrame, stored: DataFrame, pages: DataFrame, aliases: DataFrame) -> DataFrame:
    """(event_id, kind, tier, venue_id, review, second): match without coordinates; what stays new meets its venue's own
    page and is matched again by the page's name and place, if the page can be trusted and the second match is clean.

    events: event_id, city, source, source_venue_id, name, name_key; pages: source_venue_id, page_name, lat, lon, a row
    a venue; aliases: city, alias_key, canonical_key.
    """
    none = F.lit(None).cast("string")
    sent = lambda df, key, lat, lon: df.select(
        F.col("event_id").alias("incoming_id"), "city", "source", F.coalesce("source_venue_id", F.concat(F.lit("name:"), key)).alias("external_id"),
        none.alias("wikidata"), none.alias("website"), F.col(key).alias("name_key"), lat.alias("lat"), lon.alias("lon"),
    )
    nowhere = F.lit(None).cast("double")
    first = match(sent(events, "name_key", nowhere, nowhere), stored, aliases)
    shown = F.trim(F.coalesce("page_name", F.lit("")))
    page = pages.select("source_venue_id", shown.alias("page_name"), F.col("lat").alias("page_lat"), F.col("lon").alias("page_lon"))
    left = events.join(first.where("kind = 'new'").select(F.col("incoming_id").alias("event_id")), "event_id").join(page, "source_venue_id")
    left = left.withColumn("page_key", F.when(F.col("page_name") != "", name_key(F.col("page_name"))).otherwise(F.col("name_key")))
    known = aliases.select("city", "alias_key").distinct()
    for key in ("name_key", "page_key"):
        left = left.join(known.select("city", F.col("alias_key").alias(key), F.lit(True).alias(f"alias_{key}")), ["city", key], "left")
    alias = F.coalesce("alias_name_key", "alias_page_key", F.lit(False))
    words = lambda c: F.filter(F.split(c, " "), lambda t: F.length(t) > 1)
    trusted = F.arrays_overlap(words("name_key"), words("page_key")) | alias
    says_more = (F.col("page_key") != F.col("name_key")) | F.col("page_lat").isNotNull() | alias
    again = match(sent(left.where(trusted & says_more), "page_key", F.col("page_lat"), F.col("page_lon")), stored, aliases).where("kind = 'match'")
    both = first.alias("a").join(again.alias("b"), "incoming_id", "left")
    second = F.col("b.kind").isNotNull()
    pick = lambda c: F.when(second, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return both.select(F.col("incoming_id").alias("event_id"), pick("kind"), pick("tier"), pick("venue_id"), pick("review"), second.alias("second"))


def first_seen_venues(records: DataFrame) -> DataFrame:
    """(source, venue_external_id, event_id, operation, code): each unknown venue once, from the first sound event that names it.

    A venue that its own rules fail is a review; where the city does not allow venues
    from events it is a skip with a review; else an insert.

    records: event_id, position, source, venue_external_id, decision, event_outcome, venue_outcome, venue_code, city_enabled.
    """
    new = records.where("decision = 'new_candidate' and event_outcome = 'ok'")
    nth = W.partitionBy("source", "venue_external_id").orderBy("position")
    first = new.withColumn("nth", F.row_number().over(nth)).where("nth = 1")
    sound, allowed = F.col("venue_outcome") == "ok", F.coalesce("city_enabled", F.lit(False))
    return first.select(
        "source", "venue_external_id", "event_id", F.when(sound & allowed, "insert").when(sound, "skip").otherwise("review").alias("operation"),
        F.when(~sound, F.coalesce("venue_code", F.lit("event-first-venue-invalid"))).when(~allowed, "city-not-event-first-enabled").alias("code"),
    )
