"""Queries over whole runs: the ladder through several runs, plans from pages to counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.functions.text import name_key
from placemark.operators import apply, classify, config, plan, predicates, runs, snapshots
from placemark.plans import overlay
from placemark.plans.sql import TAG_RESULT, TAGS, query
from placemark.sources import landed
from placemark.sources.tables import table
from placemark.streaming import lifecycle

# What each run sees of the stored keys; the second sees too little.
SEEN = ("k % 5 <> 0", "k % 20 = 0", "k % 3 <> 0")


def _ladder_sql() -> str:
    steps = ["""s0 AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 = 0 THEN 'venue' ELSE 'event' END AS kind, ['active', 'stale', 'missing', 'gone'][c_custkey % 4 + 1] AS status,
  c_custkey % 4 AS misses, c_custkey % 11 = 0 AS frozen, c_custkey % 13 = 0 AS cancelled FROM customer WHERE c_custkey % 10 <> 3)"""]
    for r, seen in enumerate(SEEN):
        held = f"NOT ok OR frozen OR cancelled OR (status = 'gone' AND NOT (kind = 'venue' AND {seen}))"
        steps.append(f"""g{r} AS (SELECT count(*) FILTER (WHERE o) = 0 OR count(*) FILTER (WHERE o AND {seen}) >= 0.4 * count(*) FILTER (WHERE o) AS ok FROM (SELECT *, NOT frozen AND NOT cancelled AND status <> 'gone' AS o FROM s{r}))""")
        steps.append(f"""s{r + 1} AS (SELECT k, kind, CASE WHEN {held} THEN status WHEN {seen} THEN 'active' WHEN misses >= 2 THEN 'gone' WHEN misses = 1 THEN 'missing' ELSE 'stale' END AS status,
  CASE WHEN {held} THEN misses WHEN {seen} THEN 0 ELSE misses + 1 END AS misses, frozen, cancelled FROM s{r}, g{r})""")
    return f"WITH {', '.join(steps)} SELECT CAST(k AS VARCHAR) AS key, kind, status AS source_status, CAST(misses AS INTEGER) AS misses FROM s{len(SEEN)}"


@query(_ladder_sql())
def lifecycle_after_runs(spark: SparkSession, d: str) -> DataFrame:
    """Three runs up the ladder, each behind its guard; the stream form gives the same (tests)."""
    state = overlay.snapshot(spark, d).select(F.col("venue_id").cast("string").alias("key"), *lifecycle.STORED[1:])
    for seen in SEEN:
        keys = state.where(F.expr(seen.replace("k ", "cast(key as long) "))).select("key")
        # A run's state is what the next one starts from; here it is kept, in production it is a version of the log.
        state = lifecycle.advance(state, keys, lifecycle.guard(state, keys).select("healthy")).persist()
    return state.select("key", "kind", "source_status", "misses")


# ---- a run over event pages ---------------------------------------------------

_DATE = "'2026-10-' || lpad(CAST(k % 28 + 1 AS VARCHAR), 2, '0')"
_ITEMS = f"""c AS (SELECT c_custkey AS k, c_name AS n, n_name AS town FROM customer JOIN nation ON n_nationkey = c_nationkey),
s AS (SELECT *, CASE WHEN k % 23 = 0 THEN 'fetch-failed' WHEN k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0 THEN 'parse-failed' WHEN k % 4 >= 2 THEN 'rejected' ELSE 'accepted' END AS stage FROM c),
i AS (SELECT k, stage, CASE stage WHEN 'parse-failed' THEN CASE WHEN k % 7 = 0 THEN 'missing-title' WHEN k % 11 = 0 THEN 'not-found-page' WHEN k % 13 = 0 THEN 'missing-details' WHEN k % 17 = 0 THEN 'unparseable-date' ELSE 'missing-location' END
   WHEN 'rejected' THEN CASE WHEN k % 4 = 2 THEN 'category' ELSE 'no signal' END END AS reason,
 CASE WHEN stage = 'accepted' THEN CASE WHEN k % 4 = 0 THEN 'primary' ELSE 'secondary' END END AS tier,
 CASE WHEN stage <> 'accepted' THEN NULL WHEN k % 5 = 0 THEN 'needs_review:city-unknown' WHEN k % 24 = 0 THEN 'needs_review:ambiguous-existing-match' WHEN k % 12 = 0 THEN 'matched_existing:matched-tier-2'
   WHEN k % 4 = 1 THEN 'needs_review:secondary-relevance-only' WHEN k % 8 = 4 THEN 'safe_new_venue:safe-new-venue' ELSE 'needs_review:location-confidence-insufficient' END AS venue,
 CASE WHEN stage = 'accepted' AND k % 12 = 0 AND k % 24 <> 0 AND k % 5 <> 0 THEN k END AS venue_id,
 CASE WHEN stage = 'accepted' THEN 'src:' || CAST(k AS VARCHAR) END AS source_key,
 CASE WHEN stage = 'accepted' THEN CASE WHEN k % 3 = 0 THEN 'cancelled' ELSE 'scheduled' END END AS event_status,
 CASE WHEN stage = 'accepted' THEN sha1('["' || CASE WHEN k % 12 = 0 AND k % 24 <> 0 AND k % 5 <> 0 THEN 'venue:' || CAST(k AS VARCHAR) ELSE 'name:' || CAST(k AS VARCHAR) END || '","' || {_DATE} || '"]') END AS identity FROM s)"""


def _fetched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers with their towns, and a fetched event page of each."""
    k, key = F.col("c_custkey"), F.col("c_custkey").cast("string")
    part = lambda *x: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in x])
    row = lambda cls, label, *inner: part(f"<li class='{cls}'><div class='gt-title'>{label}</div><div class='gt-inner'>", *inner, "</div></li>")
    town = F.when(k % 5 == 0, "Nigde").otherwise(F.col("n_name"))
    title = F.when(k % 11 == 0, "Page not found").otherwise(F.concat("c_name", F.when(k % 3 == 0, " OTKAZANO").otherwise("")))
    date = F.when(k % 17 == 0, "uskoro").otherwise(part((k % 28 + 1).cast("string"), ". oktobra 2026. 20:30"))
    place = F.when(k % 19 == 0, "").otherwise(part(row("gt-venue", "Lokacija", "<a href='/venue/klub-", key, "/'>Klub ", key, "</a>"), row("gt-locations", "Mesto", town)))
    box = F.when(k % 13 == 0, "").otherwise(part("<div class='gt-detail-box'><ul>", row("gt-start-date", "Datum", date), place, "</ul></div>"))
    kind = F.when(k % 4 == 0, " eventcat-koncert").when(k % 4 == 1, " eventcat-stand-up").when(k % 4 == 2, " eventcat-sport").otherwise("")
    page = part(F.when(k % 7 == 0, "").otherwise(part("<title>", title, " | Site</title>")), "<body class='postid-", key, kind, "'>", box, "</body>")
    towns = table(spark, d, "nation").select("n_nationkey", "n_name")
    # One small file is one task: rows are dealt out before pages are made and parsed.
    dealt = table(spark, d, "customer").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    people = dealt.join(towns, F.col("c_nationkey") == F.col("n_nationkey"))
    fetched = people.select(key.alias("url"), (k % 23 != 0).alias("fetched"), F.when(k % 23 != 0, page).alias("html"))
    return people, fetched


def _event_items(spark: SparkSession, d: str) -> DataFrame:
    k, key = F.col("c_custkey"), F.col("c_custkey").cast("string")
    people, fetched = _fetched(spark, d)
    none = F.lit(None).cast("string")
    known = people.where(k % 12 == 0)
    known = known.select(k.alias("venue_id"), k.alias("at"), "c_nationkey").union(known.where(k % 24 == 0).select(-k, k, "c_nationkey"))
    stored = known.select(
        "venue_id", F.col("c_nationkey").alias("city"), F.lit("other").alias("source"), F.concat(F.lit("x"), F.col("venue_id").cast("string")).alias("external_id"), none.alias("wikidata"), none.alias("website"),
        name_key(F.concat(F.lit("Klub "), F.col("at").cast("string"))).alias("name_key"), F.lit(45.0).alias("lat"), F.lit(20.0).alias("lon"),
    )
    cities = overlay.cities(spark, d).select("city_id", "city", F.lit(True).alias("enabled"))
    aliases = cities.where("false").select(F.col("city_id").alias("city"), F.col("city").alias("alias_key"), F.col("city").alias("canonical_key"))
    found = people.where(k % 8 == 4).select(F.concat(F.lit("klub-"), key).alias("source_venue_id"), F.concat(F.lit("Klub "), key).alias("page_name"), F.lit(44.5).alias("lat"), F.lit(20.5).alias("lon"), none.alias("address"))
    return runs.event_run(fetched, stored, cities, aliases, found, "src", (" | Site",))


@query(f"WITH {_ITEMS} SELECT CAST(k AS VARCHAR) AS url, stage, reason, tier, venue, venue_id, source_key, event_status, identity FROM i")
def event_run_items(spark: SparkSession, d: str) -> DataFrame:
    """A whole run over event pages: fetched, parsed, judged, its venues resolved in two passes, its keys made."""
    found = _event_items(spark, d)
    venue = F.when(F.col("venue_status").isNotNull(), F.concat_ws(":", "venue_status", "venue_code"))
    return found.select("url", "stage", "reason", "tier", venue.alias("venue"), "venue_id", "source_key", "event_status", "identity")


@query(f"""WITH {_ITEMS}, n AS (SELECT count(*) AS discovered, count(*) FILTER (WHERE stage = 'fetch-failed') AS fetch_failed, count(*) FILTER (WHERE stage = 'parse-failed') AS parse_failed, count(*) FILTER (WHERE stage = 'rejected') AS rejected,
 count(*) FILTER (WHERE stage = 'accepted') AS accepted, count(*) FILTER (WHERE tier = 'primary') AS "primary", count(*) FILTER (WHERE tier = 'secondary') AS secondary, count(DISTINCT source_key) AS planned_inserts FROM i)
SELECT *, CASE WHEN discovered = 0 THEN 'failed' WHEN fetch_failed >= 0.5 * discovered OR parse_failed >= 0.3 * (discovered - fetch_failed) THEN 'degraded' ELSE 'ok' END AS status,
 NOT (discovered = 0 OR fetch_failed >= 0.5 * discovered OR parse_failed >= 0.3 * (discovered - fetch_failed)) AS healthy FROM n""")
def event_run_counters(spark: SparkSession, d: str) -> DataFrame:
    return runs.event_counters(_event_items(spark, d))


@query(f"""WITH {_ITEMS} SELECT 'svid:src:klub-' || CAST(k AS VARCHAR) AS candidate_key, CASE WHEN venue LIKE 'safe%' AND row_number() OVER (PARTITION BY venue LIKE 'safe%' ORDER BY town, 'Klub ' || CAST(k AS VARCHAR)) > 50 THEN 'needs_review' ELSE split_part(venue, ':', 1) END AS status, CAST(1 AS BIGINT) AS event_count
FROM i JOIN c USING (k) WHERE stage = 'accepted' AND venue NOT LIKE 'matched%'""")
def event_run_candidates(spark: SparkSession, d: str) -> DataFrame:
    return runs.event_candidates(_event_items(spark, d)).select("candidate_key", "status", "event_count")


# ---- a run over venue records ----------------------------------------------------

_SYNC = """r AS (SELECT c_custkey AS k, c_nationkey AS city, c_mktsegment AS segment, CASE WHEN c_custkey % 31 = 0 THEN 'REJECTED' WHEN c_custkey % 37 = 0 THEN 'NEEDS_REVIEW' WHEN c_custkey % 10 = 3 THEN 'NEW'
   WHEN (c_custkey % 7 = 0 AND c_custkey % 21 <> 0 AND c_mktsegment <> 'OTHER') OR (c_custkey % 14 = 0 AND c_custkey % 9 <> 0) THEN 'UPDATED' ELSE 'UNCHANGED' END AS status FROM customer WHERE c_custkey % 20 <> 2),
p AS (SELECT *, CASE WHEN status IN ('REJECTED', 'NEEDS_REVIEW') THEN 'review' WHEN status = 'NEW' THEN CASE WHEN k % 20 = 3 THEN 'link-only' ELSE 'insert' END WHEN status = 'UNCHANGED' THEN 'link-only' ELSE 'update' END AS operation FROM r)"""


def _sync_plan(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    named = lambda n: F.concat(F.lit("house "), n.cast("string"))
    phone = F.concat(F.lit("+381 "), k.cast("string"))
    rows = table(spark, d, "customer")
    optional = F.array_compact(F.array(F.when(k % 21 != 0, "segment"), F.when(k % 4 != 0, "phone")))
    records = rows.where(k % 20 != 2).select(
        F.lit(1).alias("city"), F.lit("osm").alias("source"), k.cast("string").alias("external_id"), F.lit("venue").alias("kind"),
        # A new record bears the name of the stored venue before it: free where that one's own record is missing, else kept for it.
        named(F.when(k % 10 == 3, k - 1).otherwise(k)).alias("name_key"), none.alias("wikidata"), none.alias("website"), F.expr(overlay.LAT).alias("lat"), F.expr(overlay.LON).alias("lon"),
        F.when(k % 31 == 0, "rejected").when(k % 37 == 0, "needs_review").otherwise("ok").alias("outcome"), optional.alias("provided"), F.col("c_name").alias("name"),
        F.when(k % 21 != 0, F.col("c_mktsegment")).alias("segment"), F.when(k % 4 != 0, phone).alias("phone"),
    )
    old = rows.where(k % 10 != 3)
    fields = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.when(k % 7 == 0, "OTHER").otherwise(F.col("c_mktsegment")), F.lit("phone"), phone)
    moved = F.expr(overlay.LAT) + F.when((k % 9 == 0) | (k % 14 == 0), 0.5).otherwise(0.0)
    links = old.select(F.lit("osm").alias("source"), k.cast("string").alias("external_id"), k.alias("stored_id"), (k % 9 == 0).alias("by_hand"), moved.alias("stored_lat"), F.expr(overlay.LON).alias("stored_lon"), fields.alias("stored_fields"))
    # The stored venue of a record that is missing belongs to another source, so that it may be linked.
    free = k % 20 == 2
    stored = old.select(
        k.alias("venue_id"), F.lit(1).alias("city"), F.when(free, "other").otherwise("osm").alias("source"), k.cast("string").alias("external_id"), none.alias("wikidata"), none.alias("website"), named(k).alias("name_key"), moved.alias("lat"), F.expr(overlay.LON).alias("lon")
    )
    return runs.venue_sync(records, links.where("cast(external_id as long) % 20 <> 2"), stored, ("name", "segment", "phone"), ("segment", "phone"))


@query(f"WITH {_SYNC} SELECT CAST(k AS VARCHAR) AS external_id, status, operation, CASE WHEN operation IN ('review', 'insert') THEN NULL WHEN status = 'NEW' THEN k - 1 ELSE k END AS canonical_id FROM p")
def venue_sync_plan(spark: SparkSession, d: str) -> DataFrame:
    """A whole run over venue records: stored values stand in for what a source leaves out, then hash, identity, claims and plan."""
    return _sync_plan(spark, d).select("external_id", "status", "operation", "canonical_id")


@query(f"WITH {_SYNC} SELECT 'venue:' || operation AS key, count(*) AS n FROM p WHERE operation <> 'review' GROUP BY operation")
def venue_sync_counts(spark: SparkSession, d: str) -> DataFrame:
    return runs.upsert_counts(_sync_plan(spark, d))


@query(f"""WITH {_SYNC} SELECT count(*) AS records, count(*) FILTER (WHERE operation = 'review') AS reviews, count(*) FILTER (WHERE status = 'NEW') AS new, count(*) FILTER (WHERE status = 'UPDATED') AS updated,
 count(*) FILTER (WHERE status = 'UNCHANGED') AS unchanged FROM p""")
def venue_sync_observed(spark: SparkSession, d: str) -> DataFrame:
    """The run's counters as they are taken while its plan is written, by the same job."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    planned, seen = runs.observed(_sync_plan(spark, d), "sync", records=F.count("*"), reviews=F.count_if(F.col("operation") == "review"), new=is_("NEW"), updated=is_("UPDATED"), unchanged=is_("UNCHANGED"))
    planned.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([seen.get], "records long, reviews long, new long, updated long, unchanged long")


# ---- what a source is asked for ----------------------------------------------------

_VALUES = ", ".join(f"({i}, '{k}', '{v}')" for i, tags in enumerate(TAGS) for k, v in tags.items())
_BASES = "('restaurant', 'cafe', 'theatre', 'arts_centre', 'community_centre', 'social_centre', 'events_venue')"


@query(f"""WITH t(kind, k, v) AS (VALUES {_VALUES}), e AS (SELECT event_id, event_id % {len(TAGS)} AS kind FROM events WHERE event_type <> 'error'),
g AS (SELECT kind, map_from_entries(list((k, v))) AS m FROM t GROUP BY kind),
x AS (SELECT kind, coalesce(m['amenity'], '') AS a, coalesce(m['name'], '') AS n, m FROM g),
l AS (SELECT kind, a IN ('nightclub', 'bar', 'pub', 'biergarten', 'music_venue', 'karaoke_box') OR coalesce(m['club'] IN ('music', 'nightlife'), FALSE) OR coalesce(m['karaoke'] = 'yes', FALSE) OR coalesce(m['leisure'] IN ('dance', 'karaoke'), FALSE) AS by_definition,
 (a IN ('restaurant', 'bar', 'pub', 'cafe') AND regexp_matches(lower(n), 'kafana')) OR (a IN ('restaurant', 'bar', 'pub', 'nightclub') AND regexp_matches(lower(n), 'splav')) AS by_name,
 (a IN {_BASES} AND (m['live_music'] IS NOT NULL OR coalesce(m['theatre:type'] IN ('concert_hall', 'music', 'cabaret'), FALSE) OR coalesce(m['stage'] = 'yes', FALSE) OR coalesce(m['microbrewery'] = 'yes', FALSE)))
   OR coalesce(m['craft'] = 'brewery', FALSE) OR coalesce(m['club'] = 'social', FALSE) OR (a IN ('restaurant', 'cafe') AND coalesce(m['bar'] = 'yes', FALSE)) AS by_signal FROM x)
SELECT CAST(count(*) FILTER (WHERE by_definition) AS BIGINT) AS by_definition, count(*) FILTER (WHERE by_name) AS by_name, count(*) FILTER (WHERE by_signal) AS by_signal, count(*) FILTER (WHERE by_definition OR by_name OR by_signal) AS any_layer FROM e JOIN l USING (kind)""")
def layer_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many elements each layer of the source query asks for."""
    kinds = F.array(*[F.create_map(*[F.lit(x) for kv in t.items() for x in kv]) for t in TAGS])
    value = predicates.of_map(F.element_at(kinds, (F.col("event_id") % len(TAGS) + 1).cast("int")))
    rows = table(spark, d, "events").where("event_type <> 'error'")
    names = dict(zip(("by_definition", "by_name", "by_signal"), predicates.LAYERS, strict=True))
    return rows.agg(*(F.count_if(layer.column(value)).alias(n) for n, layer in names.items()), F.count_if(predicates.predicate(predicates.LAYERS, value)).alias("any_layer"))


# ---- an adapter over landed pages -----------------------------------------------------


@query(f"""WITH {_ITEMS} SELECT k AS external_id, n || CASE WHEN k % 3 = 0 THEN ' OTKAZANO' ELSE '' END AS title, {_DATE} || 'T20:30' AS start_local, CASE WHEN k % 3 = 0 THEN 'cancelled' ELSE 'scheduled' END AS status,
 'klub-' || CAST(k AS VARCHAR) AS slug, CASE WHEN k % 5 = 0 THEN 'Nigde' ELSE town END AS city, CASE WHEN k % 4 = 3 THEN NULL ELSE ['koncert', 'stand-up', 'sport'][CAST(k % 4 AS INTEGER) + 1] END AS category, CAST(k % 28 + 1 AS VARCHAR) || '. oktobra 2026. 20:30' AS said
FROM i JOIN c USING (k) WHERE i.stage IN ('rejected', 'accepted') AND k % 29 <> 0""")
def landed_page_records(spark: SparkSession, d: str) -> DataFrame:
    """Sitemaps to references, landed responses to sync records, and what the pages reported, read by path."""
    _, fetched = _fetched(spark, d)
    url = F.concat(F.lit("https://example.org/event/"), "url", F.lit("/"))
    # References that no sitemap names are not asked for.
    maps = fetched.where("cast(url as long) % 29 <> 0").select(F.concat(F.lit("<urlset><url><loc>"), url, F.lit("</loc><lastmod>2026-01-01</lastmod></url></urlset>")).alias("body"))
    source = landed.LandedPages(maps, fetched.select(url.alias("url"), F.col("fetched").alias("ok"), "html"), "src", "Europe/Belgrade", (" | Site",))
    said = lambda path: landed.variant_text(F.col("reported"), path)
    return source.records(source.raw(source.refs())).select(
        F.col("external_id").cast("long").alias("external_id"), "title", "start_local", "status", said("$.venue.slug").alias("slug"), said("$.venue.city").alias("city"), said("$.categories[0]").alias("category"), said("$.dates.start").alias("said")
    )


# ---- what is stored, and of what a run may speak ----------------------------------------


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Every order is a version of its customer's record."""
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("venue_id"), F.col("o_orderdate").cast("timestamp").alias("written_at"), F.col("o_orderkey").alias("version"), (F.col("o_orderkey") % 7 == 0).alias("removed"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))


@query("""SELECT o_custkey AS venue_id, o_orderkey AS version, o_totalprice AS price, o_orderstatus AS status FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders WHERE o_orderdate <= DATE '1996-06-30')
WHERE n = 1 AND o_orderkey % 7 <> 0""")
def stored_as_of(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.as_of(_versions(spark, d), F.lit("1996-06-30").cast("timestamp"), "venue_id").select("venue_id", "version", "price", "status")


@query("""WITH l AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'venue' ELSE 'event' END AS kind, o_custkey, o_orderstatus, o_orderdate, o_orderkey % 5 < 2 AS seen FROM orders)
SELECT 's:' || CAST(id AS VARCHAR) AS key, kind, kind = 'event' AND id % 11 <> 0 AND o_orderdate < DATE '1995-01-01' AS frozen, kind = 'event' AND id % 11 <> 0 AND o_orderstatus = 'F' AS cancelled, seen FROM l WHERE kind <> 'venue' OR seen OR o_custkey % 4 = 0""")
def run_scope(spark: SparkSession, d: str) -> DataFrame:
    """Stored links with frozen and cancelled as of an instant, cut to what a run of some cities may find missing."""
    k = F.col("o_orderkey")
    orders = table(spark, d, "orders")
    kind = F.when(k % 3 == 0, "venue").otherwise("event")
    links = orders.select(F.lit("s").alias("source"), k.cast("string").alias("external_id"), kind.alias("kind"), k.alias("canonical_id"), F.lit("active").alias("source_status"), F.lit(0).alias("misses"))
    events = orders.where(k % 11 != 0).select(k.alias("event_id"), F.col("o_orderdate").cast("timestamp").alias("start_at"), F.when(F.col("o_orderstatus") == "F", "cancelled").otherwise("scheduled").alias("status"))
    stored = snapshots.source_snapshot(links, events, F.lit("1995-01-01").cast("timestamp"))
    seen = orders.where(k % 5 < 2).select(F.concat(F.lit("s:"), k.cast("string")).alias("key"))
    scope = orders.where(F.col("o_custkey") % 4 == 0).select(k.alias("canonical_id"))
    return snapshots.in_scope(stored, seen, scope).select("key", "kind", "frozen", "cancelled", "seen")


# ---- reports, scope, rescues ------------------------------------------------------------

_KIND_OF = "[" + ", ".join("NULL" if r.startswith("-") else f"'{r.rstrip('?')}'" for r in TAG_RESULT) + "]"


@query(f"""WITH o(position, category) AS (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(runs.CATEGORIES))}), f AS (SELECT {_KIND_OF}[CAST(event_id % {len(TAGS)} AS INTEGER) + 1] AS category FROM events WHERE event_type = 'click')
SELECT position, o.category, count(f.category) AS n FROM o LEFT JOIN f USING (category) GROUP BY ALL""")
def category_breakdown(spark: SparkSession, d: str) -> DataFrame:
    """Accepted elements by category, in the report's order, categories without any at 0."""
    kinds = F.array(*[F.create_map(*[F.lit(x) for kv in t.items() for x in kv]) for t in TAGS])
    rows = table(spark, d, "events").where("event_type = 'click'")
    verdict = rows.select(classify.classified(F.element_at(kinds, (F.col("event_id") % len(TAGS) + 1).cast("int"))).alias("v"))
    return runs.category_breakdown(verdict.where("v.accepted").select(F.col("v.category").alias("category")))


@query("""SELECT c_custkey AS row_id, CASE WHEN c_custkey % 50 = 0 THEN 'concert_hall!' WHEN c_custkey % 3 = 1 THEN '-excluded amenity' WHEN c_custkey % 5 = 1 AND c_nationkey < 10 THEN 'nightclub!' WHEN c_custkey % 3 = 2 THEN 'bar' ELSE '-not in scope' END AS verdict FROM customer""")
def curated_rescues(spark: SparkSession, d: str) -> DataFrame:
    """Elements that no rule accepts, taken in by a curated table: by the object itself, past an exclusion it names, or by name within a city."""
    k = F.col("c_custkey")
    amenity = F.when(k % 3 == 1, "conference_centre").when(k % 3 == 2, "bar").otherwise("fountain")
    name = F.when(k % 5 == 1, "Old Mill").otherwise(F.col("c_name"))
    rows = table(spark, d, "customer").select(
        k.alias("row_id"), F.concat(F.lit("node/"), k.cast("string")).alias("ref"), F.create_map(F.lit("amenity"), amenity, F.lit("name"), name).alias("tags"), F.lit("RS").alias("country"), (F.col("c_nationkey") < 10).cast("string").alias("city"),
    )
    # The curated table: every fiftieth object is pinned, with the exclusion it may pass; one name is rescued in one city.
    none = F.lit(None).cast("string")
    pinned = rows.where("row_id % 50 = 0").select(F.col("row_id").cast("int").alias("ordinal"), "country", "city", F.col("ref").alias("osm_ref"), none.alias("alias_key"), F.lit("concert_hall").alias("category"), F.lit("conference_centre").alias("allowed_amenity"))
    named = spark.createDataFrame([(1_000_000, "RS", "true", None, "old mill", "nightclub", None)], "ordinal int, country string, city string, osm_ref string, alias_key string, category string, allowed_amenity string")
    met = classify.with_rescues(rows, pinned.union(named))
    v = met.select("row_id", classify.classified(F.col("tags"), F.col("rescue_category"), F.col("bypass")).alias("v"))
    return v.select("row_id", F.when(F.col("v.accepted"), F.concat("v.category", F.when(F.col("v.rescued"), "!").otherwise(""))).otherwise(F.concat(F.lit("-"), "v.via")).alias("verdict"))


@query("""SELECT n_nationkey AS city_id, r_name AS country FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 0 AND r_name IN ('EUROPE', 'ASIA') AND n_nationkey < 20""")
def city_scope(spark: SparkSession, d: str) -> DataFrame:
    """The enabled cities a source is configured for, by country and by folded name."""
    cities = overlay.cities(spark, d).withColumn("enabled", F.col("city_id") % 4 != 0)
    return config.in_scope(cities, ("europe", "Asia"), tuple(f"Nation-{i} " for i in range(20))).select("city_id", "country")


@query("""SELECT c_custkey AS venue_id, c_custkey % 3 <> 0 AS filled, CASE WHEN c_custkey % 3 = 0 THEN 'kept' ELSE trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) END AS name_key FROM customer""")
def name_backfill(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    stored = table(spark, d, "customer").select(k.alias("venue_id"), F.col("c_name").alias("name"), F.when(k % 3 == 0, "kept").when(k % 3 == 1, "").alias("name_key"))
    return apply.backfilled(stored).select("venue_id", "filled", "name_key")


@query(f"""WITH {_SYNC} SELECT CAST(row_number() OVER (ORDER BY CASE operation WHEN 'insert' THEN 1 WHEN 'update' THEN 2 ELSE 3 END, CAST(k AS VARCHAR)) AS INTEGER) AS position, operation, CAST(k AS VARCHAR) AS external_id FROM p WHERE operation <> 'review'
QUALIFY position <= 100""")
def first_upserts(spark: SparkSession, d: str) -> DataFrame:
    """The first hundred writes of a plan, in the order they are applied."""
    first = plan.upserts(_sync_plan(spark, d)).limit(100).select("operation", "external_id")
    return first.withColumn("position", F.row_number().over(W.orderBy(F.array_position(F.array(*map(F.lit, plan.OPERATION_ORDER)), F.col("operation")), "external_id")))

