"""Events at one venue: pair bands, identity tiers, keys, plan status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemark.functions.text import jaccard, name_key
from placemark.functions.timeutil import local_date

CLOSE_MINUTES, NIGHT_MINUTES, SAME_TITLE, LIKE_TITLE = 90, 240, 0.6, 0.4


def same_unresolved_venue(a_name: Column, a_city: Column, b_name: Column, b_city: Column) -> Column:
    """Of two venues without an id: both cities stated and equal, and the names too."""
    stated = (F.coalesce(a_city, F.lit("")) != "") & (F.coalesce(b_city, F.lit("")) != "")
    return stated & (name_key(a_city) == name_key(b_city)) & (name_key(a_name) == name_key(b_name))


def band(same_venue: Column, same_ticket: Column, minutes: Column, same_date: Column, similarity: Column, same_promoter: Column) -> Column:
    """automatic, probable, ambiguous or separate; symmetric in the two events."""
    same_ticket, same_promoter = (F.coalesce(c, F.lit(False)) for c in (same_ticket, same_promoter))
    close = F.coalesce(minutes <= CLOSE_MINUTES, same_date)
    night = same_date | F.coalesce(minutes <= NIGHT_MINUTES, F.lit(False))
    return (
        F.when(~F.coalesce(same_venue, F.lit(False)), "separate")
        .when(same_ticket | (close & ((similarity >= SAME_TITLE) | same_promoter)), "automatic")
        .when(night & ((similarity >= LIKE_TITLE) | same_promoter), "probable")
        .when(~night, "separate")
        .otherwise("ambiguous")
    )


def window_pairs(incoming: DataFrame, stored: DataFrame, days_before: int = 1, days_after: int = 2) -> DataFrame:
    """incoming (i.*) with stored events (s.*) at its venue that start from a day before its date to before two days after.

    The window is whole days, so each incoming event goes to every day of it and meets the
    stored ones by venue and day: no pair outside the window is ever compared, however busy
    the venue.
    """
    day = F.to_date("start_at")
    days = F.sequence(F.date_sub(day, days_before), F.date_add(day, days_after - 1))
    i = incoming.withColumn("window_day", F.explode(days)).alias("i")
    s = stored.withColumn("window_day", day).alias("s")
    return i.join(s, [F.col("i.venue_id") == F.col("s.venue_id"), F.col("i.window_day") == F.col("s.window_day")])


def compared(pairs: DataFrame) -> DataFrame:
    """The band of each pair: columns i.* and s.* with event_id, start_at, title_words, ticket_id, promoter_key."""
    minutes = F.floor(F.abs(F.col("i.start_at").cast("timestamp").cast("long") - F.col("s.start_at").cast("timestamp").cast("long")) / 60 + 0.5).cast("long")
    same_date = F.to_date("i.start_at") == F.to_date("s.start_at")
    similarity = jaccard(F.col("i.title_words"), F.col("s.title_words"))
    return pairs.select(
        F.col("i.event_id").alias("event_id"), F.col("s.event_id").alias("other_id"), minutes.alias("minutes"), similarity.alias("similarity"),
        band(F.lit(True), F.col("i.ticket_id") == F.col("s.ticket_id"), minutes, same_date, similarity, F.col("i.promoter_key") == F.col("s.promoter_key")).alias("band"),
    )


def identity(incoming: DataFrame, bands: DataFrame, by_source: DataFrame, by_link: DataFrame) -> DataFrame:
    """(event_id, decision, tier, canonical_id): own key, own link, the one automatic match, else ambiguous or new.

    incoming: event_id; bands: event_id, other_id, band; by_source and by_link: event_id, canonical_id.
    """
    auto = F.col("band") == "automatic"
    summed = bands.groupBy("event_id").agg(F.count_if(auto).alias("automatic"), F.count_if(F.col("band").isin("probable", "ambiguous")).alias("weak"), F.min(F.when(auto, F.col("other_id"))).alias("match_id"))
    own = by_source.groupBy("event_id").agg(F.min("canonical_id").alias("source_id"))
    link = by_link.groupBy("event_id").agg(F.min("canonical_id").alias("link_id"))
    all_of = incoming.select("event_id").join(own, "event_id", "left").join(link, "event_id", "left").join(summed, "event_id", "left")
    tier = F.when(F.col("source_id").isNotNull(), 0).when(F.col("link_id").isNotNull(), 1).when(F.col("automatic") == 1, 2).when((F.col("automatic") > 1) | (F.col("weak") > 0), None).otherwise(3)
    return all_of.withColumn("tier", tier).select(
        "event_id", F.when(F.col("tier") < 3, "matched").when(F.col("tier") == 3, "new_candidate").otherwise("ambiguous").alias("decision"), "tier",
        F.when(F.col("tier") == 0, F.col("source_id")).when(F.col("tier") == 1, F.col("link_id")).when(F.col("tier") == 2, F.col("match_id")).alias("canonical_id"),
    )


def venue_key(venue_id: Column, venue_name: Column, city: Column) -> Column:
    name = F.trim(F.coalesce(venue_name, F.lit("")))
    return F.when(venue_id.isNotNull(), F.concat(F.lit("venue:"), venue_id.cast("string"))).when(name != "", F.concat(F.lit("name:"), name_key(name))).otherwise(F.concat(F.lit("city:"), name_key(F.coalesce(city, F.lit("unknown")))))


def identity_key(key: Column, start_local: Column) -> Column:
    """SHA-1 of the JSON pair of venue key and local date."""
    return F.sha1(F.to_json(F.array(key, local_date(start_local))))


def plan_status(parse_code: Column, contract_code: Column, venue_status: Column, venue_code: Column, start_at: Column) -> Column:
    """struct(action, code): READY, REVIEW or REJECTED."""
    row = lambda action, code: F.struct(F.lit(action).alias("action"), code.cast("string").alias("code"))
    return (
        F.when(parse_code.isNotNull(), row("REJECTED", parse_code))
        .when(contract_code.isNotNull(), row("REJECTED", contract_code))
        .when(~venue_status.eqNullSafe(F.lit("matched")), row("REVIEW", F.coalesce(venue_code, F.lit("venue-not-matched"))))
        .when(start_at.isNull(), row("REVIEW", F.lit("start-time-unresolved")))
        .otherwise(row("READY", F.lit(None)))
    )


def preflight(batch: DataFrame, venues: DataFrame, existing: DataFrame, source: str, on_existing: str = "reject") -> DataFrame:
    """(external_id, reason) of everything that stops a bulk insert; empty means the whole batch may go.

    batch: position, external_id, source, action, contract_code, venue_id, planned_start,
    own_start, content; the first of equal ids is judged, later ones are duplicates.
    """
    from pyspark.sql import Window as W

    ready = F.col("action") == "READY"
    trimmed = F.trim(F.coalesce("external_id", F.lit("")))
    first = W.partitionBy("external_id").orderBy("position")
    rows = batch.withColumns({"k": F.row_number().over(first), "first_content": F.first("content").over(first)})
    known = venues.select(F.col("venue_id"), F.lit(True).alias("venue_known"))
    there = existing.select("external_id", F.lit(True).alias("stored"))
    rows = rows.join(known, "venue_id", "left").join(there, "external_id", "left")
    reason = (
        F.when(~ready, "not ready")
        .when(F.trim(F.coalesce("source", F.lit(""))) == "", "missing source")
        .when(F.col("source") != source, "other source")
        .when((trimmed == "") | (trimmed != F.col("external_id")), "missing or untrimmed external id")
        .when(F.col("k") > 1, F.when(F.col("content").eqNullSafe(F.col("first_content")), "duplicate").otherwise("conflicting duplicate"))
        .when(F.col("contract_code").isNotNull(), F.concat(F.lit("contract: "), F.col("contract_code")))
        .when(~F.col("planned_start").eqNullSafe(F.col("own_start")), "planned start differs")
        .when(F.col("venue_id").isNull(), "no venue")
        .when(F.col("venue_known").isNull(), "unknown venue")
    )
    if on_existing == "reject":
        reason = F.coalesce(reason, F.when(F.col("stored"), "exists"))
    return rows.select("position", "external_id", reason.alias("reason")).where("reason is not null")
