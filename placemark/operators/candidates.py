"""Venues that only events speak of: resolution status, roll-up, cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.functions.text import address_key

CAP, EXAMPLES = 50, 5
# How sure a location is.
CONFIDENCE = {"none": 0, "city-only": 1, "address": 2, "coordinates": 3}


def candidate_key(source: Column, source_venue_id: Column, city: Column, name: Column, address: Column, generic: Column) -> Column:
    town = F.coalesce(city, F.lit("?"))
    named = F.coalesce(name, F.lit("")) != ""
    join = lambda *c: F.concat_ws(":", *c)
    return (
        F.when(source_venue_id.isNotNull(), join(F.lit("svid"), source, source_venue_id.cast("string")))
        .when(generic & address.isNotNull() & named, join(F.lit("nca"), town, name, address_key(address)))
        .when(named, join(F.lit("nc"), town, name))
        .otherwise(join(F.lit("url"), town))
    )


def confidence(lat: Column, lon: Column, address: Column) -> Column:
    return F.when(lat.isNotNull() & lon.isNotNull(), "coordinates").when(F.coalesce(address, F.lit("")) != "", "address").otherwise("city-only")


def review_codes(flagged: Column, trusted: Column, city_enabled: Column, primary: Column, generic: Column, in_region: Column, page_city_differs: Column, located: Column) -> Column:
    """What keeps a candidate from being safe, in fixed order; the first is the headline."""
    code = lambda test, name: F.when(F.coalesce(test, F.lit(False)), name)
    return F.array_compact(F.array(
        code(flagged, "matcher-flagged-review"), code(~trusted, "source-not-trusted"), code(~city_enabled, "city-not-enabled"), code(~primary, "secondary-relevance-only"),
        code(generic, "generic-venue-name"), code(~in_region, "coordinates-out-of-region"), code(page_city_differs, "venue-page-city-mismatch"), code(located == "city-only", "location-confidence-insufficient"),
    ))


def resolution(name_code: Column, has_city: Column, city_known: Column, match_kind: Column, tier: Column, codes: Column) -> Column:
    """struct(status, code) of one event's venue."""
    row = lambda status, code: F.struct(F.lit(status).alias("status"), code.cast("string").alias("code"))
    return (
        F.when(name_code.isNotNull(), row("rejected", name_code))
        .when(~has_city, row("rejected", F.lit("city-missing")))
        .when(~city_known, row("needs_review", F.lit("city-unknown")))
        .when(match_kind == "match", row("matched_existing", F.concat(F.lit("matched-tier-"), tier.cast("string"))))
        .when(match_kind == "skip", row("needs_review", F.lit("ambiguous-existing-match")))
        .when(F.size(codes) > 0, row("needs_review", codes[0]))
        .otherwise(row("safe_new_venue", F.lit("safe-new-venue")))
    )


def rolled_up(resolutions: DataFrame) -> DataFrame:
    """One row a candidate_key. resolutions: candidate_key, status, name, city, address, lat, lon,
    confidence, reason_codes, url, title; "first" means by url, then title, whatever the arrival order.
    """
    own = resolutions.where(F.col("status").isin("safe_new_venue", "needs_review"))
    place = F.struct("url", "title")
    first = lambda c, test=None: F.min_by(c, F.when(test, place) if test is not None else place)
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]), F.col("confidence"))
    # Examples are the first few of each key before anything is gathered.
    nth = W.partitionBy("candidate_key").orderBy("url", "title")
    own = own.withColumn("nth", F.row_number().over(nth))
    out = own.groupBy("candidate_key").agg(
        F.count("*").alias("event_count"), F.bool_and(F.col("status") == "safe_new_venue").alias("all_safe"), first(F.col("name")).alias("name"), F.count_distinct("name").alias("names"),
        first(F.col("city"), F.col("city").isNotNull()).alias("city"), F.count_distinct("city").alias("cities"), first(F.col("address"), F.coalesce("address", F.lit("")) != "").alias("address"),
        first(F.struct("lat", "lon"), placed).alias("point"), F.max_by("confidence", rank).alias("confidence"),
        F.array_distinct(F.flatten(F.collect_set("reason_codes"))).alias("codes"),
        F.array_sort(F.collect_list(F.when(F.col("nth") <= EXAMPLES, place))).alias("examples"),
    )
    note = lambda test, code: F.when(test, F.array(F.lit(code))).otherwise(F.array().cast("array<string>"))
    conflict = (F.col("names") > 1) | (F.col("cities") > 1)
    codes = F.array_sort(F.concat("codes", note(F.col("names") > 1, "conflicting-venue-name-across-events"), note(F.col("cities") > 1, "conflicting-city-across-events")))
    return out.select(
        "candidate_key", F.when(F.col("all_safe") & ~conflict, "safe_new_venue").otherwise("needs_review").alias("status"), "name", "city", "address",
        F.col("point.lat").alias("lat"), F.col("point.lon").alias("lon"), "confidence", F.array_distinct(codes).alias("reason_codes"), "event_count", "examples",
    )


def capped(candidates: DataFrame, cap: int = CAP) -> DataFrame:
    """Safe candidates beyond the cap - most events first, then city, name, key - are held for review.

    Only the cap best are ranked, so no task orders them all.
    """
    order = [F.desc("event_count"), F.coalesce("city", F.lit("")), F.col("name"), F.col("candidate_key")]
    within = candidates.where("status = 'safe_new_venue'").orderBy(*order).limit(cap).select("candidate_key", F.lit(True).alias("within"))
    out = candidates.join(within, "candidate_key", "left")
    over = (F.col("status") == "safe_new_venue") & F.col("within").isNull()
    return out.withColumn("reason_codes", F.when(over, F.array_sort(F.array_append("reason_codes", F.lit("over-per-run-cap")))).otherwise(F.col("reason_codes"))).withColumn(
        "status", F.when(over, "needs_review").otherwise(F.col("status"))
    ).drop("within")
