"""Whole runs: from fetched pages to resolved events, and from source records to a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemark.functions.text import name_key, tokens
from placemark.operators import candidates, change, events, match, plan, reconcile, venues
from placemark.operators.commit_log import CommitLog
from placemark.operators.lineage import cut
from placemark.operators.relevance import relevance
from placemark.sources import pages

#: The order in which a report lists the categories.
CATEGORIES = ("nightclub", "bar", "pub_brewery", "kafana", "concert_hall", "nightlife_venue", "other_nightlife")
EVENT_STAGES = ("fetch-failed", "parse-failed", "rejected", "accepted")


def event_run(
    fetched: DataFrame, stored: DataFrame, cities: DataFrame, aliases: DataFrame, venue_pages: DataFrame, source: str, suffixes: tuple[str, ...] = (),
    words: dict[str, tuple[str, ...]] | None = None, names: dict[str, str] | None = None, trusted: bool = True,
) -> DataFrame:
    """A row a page with the stage it reached and, where accepted, its venue's resolution and its own keys.

    fetched: url, fetched, html; stored: as for match(); cities: city_id, city, enabled; aliases: city,
    alias_key, canonical_key (city: city_id); venue_pages: source_venue_id, page_name, lat, lon, address.
    """
    parsed = pages.events(fetched.where("fetched"), suffixes)
    said = tokens(F.concat_ws(" ", "title", "description"))
    # A page that could not be read has nothing to say; its row stays.
    judged = parsed.withColumn("r", relevance(F.coalesce("categories", F.array().cast("array<string>")), said, words, names)).withColumnRenamed("code", "parse_code")
    rows = fetched.select("url", "fetched").join(judged, "url", "left")
    stage = F.when(~F.col("fetched"), "fetch-failed").when(F.col("parse_code").isNotNull(), "parse-failed").when(~F.col("r.accepted"), "rejected").otherwise("accepted")
    reason = F.when(F.col("parse_code").isNotNull(), F.col("parse_code")).when(~F.col("r.accepted"), F.concat_ws(": ", "r.reason", "r.keyword"))
    rows = rows.withColumns({"stage": stage, "reason": reason, "tier": F.when(stage == "accepted", F.col("r.tier")), "name_key": name_key(F.col("venue"))})

    rows = cut(rows)  # pages are parsed once, whatever looks at them
    kept = rows.where("stage = 'accepted'")
    town = venues.match_city_text(kept.select(F.col("url").alias("row_id"), F.col("city").alias("city_text")), cities, {}).select(F.col("row_id").alias("url"), "city_id")
    kept = cut(kept.join(town, "url").withColumn("name_code", venues.name_gate(F.col("venue"), F.col("name_key"))))
    asked = kept.where("name_code is null and city_id is not null").select(
        F.col("url").alias("event_id"), F.col("city_id").alias("city"), F.lit(source).alias("source"), F.col("venue_slug").alias("source_venue_id"), F.col("venue").alias("name"), "name_key"
    )
    met = venues.resolve_with_pages(asked, stored, venue_pages, aliases).select(F.col("event_id").alias("url"), "kind", F.col("tier").alias("match_tier"), "venue_id", "review")
    page = venue_pages.select(F.col("source_venue_id").alias("venue_slug"), "lat", "lon", "address")
    enabled = cities.select("city_id", "enabled")
    kept = kept.join(met, "url", "left").join(page, "venue_slug", "left").join(enabled, "city_id", "left")
    located = candidates.confidence(F.col("lat"), F.col("lon"), F.col("address"))
    codes = candidates.review_codes(
        F.col("review") & (F.col("kind") == "match"), F.lit(trusted), F.coalesce("enabled", F.lit(False)), F.col("tier") == "primary", venues.generic_name(F.col("name_key")), F.lit(True), F.lit(False), located
    )
    has_city = F.trim(F.coalesce("city", F.lit(""))) != ""
    status = candidates.resolution(F.col("name_code"), has_city, F.col("city_id").isNotNull(), F.coalesce("kind", F.lit("new")), F.col("match_tier"), codes)
    own = F.when(status["status"] == "matched_existing", F.col("venue_id"))
    resolved = kept.select(
        "url", status["status"].alias("venue_status"), status["code"].alias("venue_code"), own.alias("venue_id"), "city_id", "lat", "lon", "address", located.alias("confidence"),
        F.when(status["status"] == "needs_review", F.when(status["code"].eqNullSafe(F.try_element_at(codes, F.lit(1))), codes).otherwise(F.array(status["code"]))).otherwise(F.array().cast("array<string>")).alias("reason_codes"),
        F.concat_ws(":", F.lit(source), "external_id").alias("source_key"), events.identity_key(events.venue_key(own, F.col("venue"), F.col("city")), F.col("start_local")).alias("identity"),
        F.coalesce("status", F.lit("scheduled")).alias("event_status"),
        candidates.candidate_key(F.lit(source), F.col("venue_slug"), F.col("city"), F.col("name_key"), F.col("address"), venues.generic_name(F.col("name_key"))).alias("candidate_key"),
    )
    return cut(rows.select("url", "stage", "reason", "tier", "title", F.col("venue").alias("name"), "city").join(resolved, "url", "left"))


def event_counters(items: DataFrame) -> DataFrame:
    """One row: how many pages reached each stage, the planned inserts counted once a source key, and the run's health."""
    n = lambda test: F.count_if(test)
    stage = F.col("stage")
    counts = items.agg(
        F.count("*").alias("discovered"), n(stage == "fetch-failed").alias("fetch_failed"), n(stage == "parse-failed").alias("parse_failed"), n(stage == "rejected").alias("rejected"),
        n(stage == "accepted").alias("accepted"), n(F.col("tier") == "primary").alias("primary"), n(F.col("tier") == "secondary").alias("secondary"), F.count_distinct("source_key").alias("planned_inserts"),
    )
    return reconcile.run_health(counts)


def event_candidates(items: DataFrame, cap: int = candidates.CAP) -> DataFrame:
    """The venues that only these events speak of, rolled up and capped."""
    rows = items.where("stage = 'accepted'").withColumnRenamed("venue_status", "status")
    return candidates.capped(candidates.rolled_up(rows), cap)


def venue_sync(records: DataFrame, links: DataFrame, stored: DataFrame, fields: tuple[str, ...], optional: tuple[str, ...]) -> DataFrame:
    """records with status, operation and canonical_id, as a run plans them.

    What a source does not give is compared as stored, and coordinates set by hand are
    compared as they are, so that neither reads as a change; then the hash decides. A
    record's own venue is kept for it before any other may claim it.

    records: city, source, external_id, name_key, wikidata, website, lat, lon, outcome, provided
    (names of the optional fields it gives) and the fields; links: source, external_id, stored_id,
    by_hand, stored_lat, stored_lon, stored_fields (map of text by name); stored: as for match().
    """
    both = records.join(links, ["source", "external_id"], "left")
    linked = F.col("stored_id").isNotNull()
    text = lambda name: F.col(name).cast("string")

    def compared(name: str) -> Column:
        was = F.try_element_at(F.col("stored_fields"), F.lit(name))
        given = F.lit(True) if name not in optional else F.array_contains("provided", name)
        return change.substituted(text(name), was, ~linked | given)

    pinned = linked & F.coalesce("by_hand", F.lit(False))
    point = {axis: F.format_string("%.6f", change.substituted(F.col(axis).cast("double"), F.col(f"stored_{axis}").cast("double"), F.lit(True), pinned)) for axis in ("lat", "lon")}
    was_point = {axis: F.format_string("%.6f", F.col(f"stored_{axis}").cast("double")) for axis in ("lat", "lon")}
    was = {name: F.try_element_at(F.col("stored_fields"), F.lit(name)) for name in fields}
    both = both.withColumns({
        "content_hash": change.content_hash({name: compared(name) for name in fields} | point),
        "stored_hash": F.when(linked, change.content_hash(was | was_point)),
    })

    every = records.withColumn("incoming_id", F.concat_ws("/", "source", "external_id"))
    asked = every.where("outcome = 'ok'")
    # Kept for the record that owns it, whatever becomes of that record.
    reserved = stored.join(every.select("source", "external_id", F.col("incoming_id").alias("owner")), ["source", "external_id"]).select("venue_id", "owner")
    found = cut(match.edges(asked, stored, reserved=reserved))
    kinds = match.decide(found, asked)
    owners = links.select("source", "external_id", F.lit(0).alias("turn"))
    order = asked.join(owners, ["source", "external_id"], "left").select("incoming_id", "city", F.struct(F.coalesce("turn", F.lit(1)), "external_id").alias("position"))
    wanted = found.where("venue_id is not null").join(kinds.where("kind = 'match'").select("incoming_id"), "incoming_id", "left_semi").join(order, "incoming_id")
    won = match.claim(wanted.select("city", "position", "incoming_id", "tier", "venue_id")).select("incoming_id", F.col("venue_id").alias("matched_id"))
    decided = kinds.select("incoming_id", "kind").join(won, "incoming_id", "left")
    decision = F.when(F.col("kind") == "skip", "ambiguous").when(F.col("matched_id").isNotNull(), "matched").otherwise("new_candidate")
    decided = decided.select("incoming_id", "matched_id", decision.alias("decision"))
    both = both.withColumn("incoming_id", F.concat_ws("/", "source", "external_id")).join(decided, "incoming_id", "left")
    return plan.plan(both.withColumn("decision", F.coalesce("decision", F.lit("new_candidate"))))


def upsert_counts(planned: DataFrame) -> DataFrame:
    """(key, n): planned writes by kind:operation."""
    return planned.where("operation <> 'review'").groupBy(F.concat_ws(":", "kind", "operation").alias("key")).agg(F.count("*").alias("n"))


def category_breakdown(found: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """(position, category, n): every category in its fixed order, those nothing fell into with 0."""
    spark = found.sparkSession
    fixed = spark.createDataFrame(list(enumerate(categories)), "position int, category string")
    return fixed.join(found.groupBy("category").agg(F.count("*").alias("n")), "category", "left").select("position", "category", F.coalesce("n", F.lit(0)).alias("n"))


def observed(df: DataFrame, name: str, **counters: Column):
    """(df, its Observation): counters are taken while df is written, by the same job."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *(c.alias(k) for k, c in counters.items())), seen


def commit_run(log: CommitLog, after: DataFrame, parent: int, counters: DataFrame, run_id: str) -> int:
    """Publish the table a run leaves behind, with its counters (event_counters()) as the version's note.

    A failed or unhealthy run is refused before anything is written, a run that started
    from a version that is no longer current once it is known.
    """
    c = counters.first().asDict()
    return log.commit(after, parent, c.pop("status"), c.pop("healthy"), {"run_id": run_id} | c)
