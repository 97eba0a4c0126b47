"""Every query over the provided tables, with its DuckDB oracle.

A query builds its DataFrame from the operators; the oracle says the same in
plain SQL, on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemark.functions import geo, html, text, urls
from placemark.operators import classify, config, discovery, match, relevance, validate
from placemark.plans import overlay
from placemark.plans.sql import _LAT, _LON, ORACLES, QUERIES, TAG_RESULT, TAGS, _metres, _whole, query  # noqa: F401
from placemark.sources import pages, sitemap
from placemark.sources.tables import table

COUNTRY, CITY, GENRES = "EUROPE", "NATION_3", ["Brand#12", "Brand#23", "Brand#4"]
CENTRE = (44.8, 20.45)

_ACTIVE = f"""
SELECT c_custkey AS venue_id, c_name AS name, r_name AS country, n_name AS city,
       lpad(CAST(c_custkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') AS closes,
       coalesce(g.genres, []) AS genres, {_LAT} AS lat, {_LON} AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT o_custkey, list_sort(list(DISTINCT p_brand)) AS genres FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1) g ON g.o_custkey = c_custkey
WHERE c_acctbal > 0"""


# ---- discovery -----------------------------------------------------------


@query(f"""WITH a AS ({_ACTIVE})
SELECT venue_id, name, closes, array_to_string(genres, ',') AS genres, {_whole(_metres(str(CENTRE[0]), str(CENTRE[1]), 'lat', 'lon'))} AS metres
FROM a WHERE country = '{COUNTRY}' AND city = '{CITY}' AND list_has_any(genres, ['{"', '".join(GENRES)}'])""")
def discovery_search(spark: SparkSession, d: str) -> DataFrame:
    found = discovery.search(discovery.active_venues(overlay.venues(spark, d), overlay.cities(spark, d), overlay.genres(spark, d)), COUNTRY, CITY, GENRES)
    metres = geo.whole_metres(geo.haversine(F.lit(CENTRE[0]), F.lit(CENTRE[1]), F.col("lat"), F.col("lon")))
    return discovery.by_distance(found, metres).select("venue_id", "name", "closes", F.array_join("genres", ",").alias("genres"), "metres")


@query(f"WITH a AS ({_ACTIVE}) SELECT venue_id, name, country, city, closes, array_to_string(genres, ',') AS genres FROM a ORDER BY name")
def active_venues_with_genres(spark: SparkSession, d: str) -> DataFrame:
    found = discovery.active_venues(overlay.venues(spark, d), overlay.cities(spark, d), overlay.genres(spark, d))
    return found.select("venue_id", "name", "country", "city", "closes", F.array_join("genres", ",").alias("genres")).orderBy("name")


@query(f"""WITH m AS (SELECT c_custkey AS venue_id, {_metres(str(CENTRE[0]), str(CENTRE[1]), _LAT, _LON)} AS x FROM customer)
SELECT venue_id, {_whole('x')} AS metres, CASE WHEN x < 1000 THEN {_whole('x')} || ' m away'
  ELSE CAST(CAST(CAST(floor(x / 100 + 0.5) AS BIGINT) / 10 AS DECIMAL(12,1)) AS VARCHAR) || ' km away' END AS label FROM m""")
def haversine_near_city(spark: SparkSession, d: str) -> DataFrame:
    x = geo.haversine(F.lit(CENTRE[0]), F.lit(CENTRE[1]), F.col("lat"), F.col("lon"))
    return overlay.venues(spark, d).select("venue_id", geo.whole_metres(x).alias("metres"), geo.distance_label(x).alias("label"))


@query("""SELECT 'part' AS selector, p_type AS shown, count(*) AS n FROM part WHERE contains(lower(p_type), lower('Sma')) GROUP BY 2
UNION ALL SELECT 'nation', n_name, count(*) FROM nation WHERE contains(lower(n_name), lower('n_1')) GROUP BY 2""")
def selector_search(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").where(discovery.containing(F.col("p_type"), "Sma")).groupBy(F.lit("part").alias("selector"), F.col("p_type").alias("shown")).agg(F.count("*").alias("n"))
    nation = table(spark, d, "nation").where(discovery.containing(F.col("n_name"), "n_1")).groupBy(F.lit("nation").alias("selector"), F.col("n_name").alias("shown")).agg(F.count("*").alias("n"))
    return part.unionByName(nation)


@query(f"""WITH a AS ({_ACTIVE}), r AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey * 7 % 5000 END AS metres FROM customer)
SELECT venue_id, name, array_to_string(genres, ',') AS genres, CAST(metres AS BIGINT) AS metres FROM a LEFT JOIN r ON id = venue_id AND metres IS NOT NULL""")
def road_distance_attach(spark: SparkSession, d: str) -> DataFrame:
    found = discovery.active_venues(overlay.venues(spark, d), overlay.cities(spark, d), overlay.genres(spark, d))
    roads = table(spark, d, "customer").select(F.col("c_custkey").alias("venue_id"), F.when(F.col("c_custkey") % 9 != 0, F.col("c_custkey") * 7 % 5000).alias("metres"))
    return discovery.with_road_distance(found, roads).select("venue_id", "name", F.array_join("genres", ",").alias("genres"), "metres")


# ---- text ------------------------------------------------------------------

_FOLD = "trim(regexp_replace(strip_accents(lower({})), '[^a-z0-9]+', ' ', 'g'))"
_FIRST_LINE = "split_part(text, chr(10), 1)"


@query("""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct, t[1] AS first_token FROM
(SELECT doc_id, list_filter(string_split(trim(regexp_replace(strip_accents(replace(lower(text), 'ß', ' ')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '') AS t FROM documents)""")
def tokenize_documents(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", text.tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct("t")).cast("long").alias("n_distinct"), F.try_element_at("t", F.lit(1)).alias("first_token"))


@query(f"""SELECT doc_id, trim(regexp_replace(strip_accents(replace(lower({_FIRST_LINE}), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g')) AS folded FROM documents""")
def normalize_names_latin(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.profile_name(F.lit("latin"), F.split("text", "\n")[0]).alias("folded"))


_SR = """WITH f AS (SELECT {id} AS id, regexp_replace(regexp_replace(trim(regexp_replace(strip_accents(replace(lower({raw}), 'ß', 'ss')), '[^a-z0-9]+', ' ', 'g')),
 '^((beograd|belgrade) )+(.)', '\\3'), '(.)( (beograd|belgrade))+$', '\\1') AS s, {raw} AS raw FROM {table}),
t AS (SELECT id, raw, s, list_filter(string_split(s, ' '), lambda x: x NOT IN ('the', 'club', 'klub', 'bar')) AS kept FROM f)
SELECT id, CASE WHEN s = '' THEN trim(regexp_replace(lower(raw), '\\s+', ' ', 'g')) WHEN len(kept) > 0 THEN array_to_string(kept, ' ') ELSE s END AS name_key FROM t"""


@query(_SR.format(id="doc_id", raw=_FIRST_LINE, table="documents"))
def normalize_names_sr(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), text.profile_name(F.lit("sr"), F.split("text", "\n")[0]).alias("name_key"))


@query(f"""WITH c AS (SELECT n_nationkey AS city_id, upper(r_name) AS country, {_FOLD.format('n_name')} AS key FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION SELECT n_nationkey, upper(r_name), {_FOLD.format("'old ' || n_name")} FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION SELECT n_nationkey, upper(r_name), 'twin ' || CAST(n_nationkey % 12 AS VARCHAR) FROM nation JOIN region ON n_regionkey = r_regionkey),
q AS (SELECT c_custkey AS row_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE (SELECT lower(r_name) FROM region WHERE r_regionkey = c_custkey % 5) END AS country,
  CASE c_custkey % 4 WHEN 0 THEN n_name WHEN 1 THEN ' Old-' || lower(n_name) || '! ' WHEN 2 THEN 'Twin ' || CAST(c_custkey % 12 AS VARCHAR) ELSE 'nowhere' END AS city_text FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT row_id, CASE WHEN country IS NOT NULL THEN (SELECT min(city_id) FROM c WHERE c.country = upper(q.country) AND c.key = {_FOLD.format('q.city_text')})
  ELSE (SELECT CASE WHEN count(DISTINCT city_id) = 1 THEN min(city_id) END FROM c WHERE c.key = {_FOLD.format('q.city_text')}) END AS city_id FROM q""")
def city_resolution(spark: SparkSession, d: str) -> DataFrame:
    cities = overlay.cities(spark, d).withColumn("aliases", F.array(F.concat(F.lit("old "), F.col("city")), F.concat(F.lit("twin "), (F.col("city_id") % 12).cast("string"))))
    regions = table(spark, d, "region").select(F.col("r_regionkey").alias("rk"), F.lower("r_name").alias("rn"))
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(regions, k % 5 == F.col("rk")).select(
        k.alias("row_id"), F.when(k % 3 != 0, F.col("rn")).alias("country"),
        F.when(k % 4 == 0, F.col("n_name")).when(k % 4 == 1, F.concat(F.lit(" Old-"), F.lower("n_name"), F.lit("! "))).when(k % 4 == 2, F.concat(F.lit("Twin "), (k % 12).cast("string"))).otherwise("nowhere").alias("city_text"),
    )
    return config.resolve_city(rows, cities)


_WORDS = "list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) > 1 AND w NOT IN ('" + "', '".join(text.TITLE_STOPWORDS) + "')))"


@query(f"""WITH t AS (SELECT p_partkey AS id, p_type, p_brand, {_WORDS} AS w FROM part)
SELECT a.id AS left_id, b.id AS right_id, CASE WHEN len(a.w) = 0 OR len(b.w) = 0 THEN 0.0 ELSE round(len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 6) END AS similarity
FROM t a JOIN t b ON a.p_type = b.p_type AND a.p_brand = b.p_brand AND a.id < b.id""")
def title_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "part").select(F.col("p_partkey").alias("id"), text.title_tokens(F.col("p_name")).alias("w"), "p_type", "p_brand")
    return match.title_pairs(t, "p_type", "p_brand")


# ---- decision lists --------------------------------------------------------

_LISTS = {"hard": ("stupid", "idiot"), "strong": ("whening", "therea", "hation", "anen"), "secondary": ("fest", "thea", "night", "est", "docek"), "nonmusic": ("erre", "onan"), "kids": ("moron",), "festival": ("fest", "est"), "night": ("night",)}
_NAMES = {"music": "src1", "festival": "src2", "standup": "src3", "newyear": "src4", "theatre": "src5", "sport": "src6"}


def _hit(words) -> str:
    return "list_filter([" + ", ".join(f"'{w}'" for w in words) + "], lambda k: list_contains(t, k))[1]"


@query(f"""WITH x AS (SELECT doc_id, source, list_filter(string_split(trim(regexp_replace(strip_accents(replace(lower(text), 'ß', ' ')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda k: k <> '') AS t FROM documents),
h AS (SELECT doc_id, source, {_hit(_LISTS['hard'])} AS hard, {_hit(_LISTS['strong'])} AS strong, {_hit(_LISTS['secondary'])} AS second, {_hit(_LISTS['nonmusic'])} AS nonmusic, {_hit(_LISTS['kids'])} AS kids,
  {_hit(('fest', 'thea', 'est'))} AS party, {_hit(('thea', 'night', 'docek'))} AS beyond FROM x)
SELECT doc_id, CASE
 WHEN source = 'src1' THEN 'primary|category|'
 WHEN source = 'src2' THEN CASE WHEN strong IS NOT NULL THEN 'primary|festival with music|' || strong WHEN nonmusic IS NOT NULL THEN 'reject|festival of something else|' || nonmusic WHEN kids IS NOT NULL THEN 'reject|kids|' || kids ELSE 'secondary|festival|' END
 WHEN source = 'src3' THEN CASE WHEN kids IS NOT NULL THEN 'reject|kids|' || kids ELSE 'secondary|category|' END
 WHEN source = 'src4' THEN CASE WHEN kids IS NOT NULL THEN 'reject|kids|' || kids WHEN coalesce(party, strong) IS NOT NULL THEN 'secondary|new year party|' || coalesce(party, strong) ELSE 'reject|new year without a party|' END
 WHEN source IN ('src5', 'src6') THEN 'reject|category|'
 WHEN coalesce(hard, kids) IS NOT NULL THEN 'reject|hard negative|' || coalesce(hard, kids)
 WHEN strong IS NOT NULL THEN 'primary|music|' || strong
 WHEN second IS NOT NULL AND nonmusic IS NOT NULL AND beyond IS NULL THEN 'reject|festival of something else|' || nonmusic
 WHEN second IS NOT NULL THEN 'secondary|nightlife|' || second ELSE 'reject|no signal|' END AS verdict FROM h""")
def relevance_classify(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.array("source").alias("categories"), text.tokens(F.col("text")).alias("t"))
    rows = rows.select("doc_id", relevance.relevance(F.col("categories"), F.col("t"), _LISTS, _NAMES).alias("r"))
    return rows.select("doc_id", F.concat_ws("|", F.coalesce("r.tier", F.lit("reject")), "r.reason", F.coalesce("r.keyword", F.lit(""))).alias("verdict"))


@query(f"""SELECT event_id, CASE WHEN event_type = 'error' THEN '-not in scope' ELSE ['{"', '".join(TAG_RESULT)}'][CAST(event_id % 24 AS INTEGER) + 1] END AS verdict FROM events""")
def tag_classify(spark: SparkSession, d: str) -> DataFrame:
    choices = F.array(*[F.create_map(*[F.lit(x) for kv in t.items() for x in kv]) for t in TAGS])
    tags = F.when(F.col("event_type") == "error", F.create_map(F.lit("error"), F.lit("yes"))).otherwise(F.element_at(choices, (F.col("event_id") % 24 + 1).cast("int")))
    v = table(spark, d, "events").select("event_id", tags.alias("tags")).select("event_id", classify.classified(F.col("tags")).alias("v"))
    return v.select("event_id", F.when(F.col("v.accepted"), F.concat("v.category", F.when(F.col("v.review"), "?").otherwise(""))).otherwise(F.concat(F.lit("-"), F.col("v.via"))).alias("verdict"))


_ODD_NAMES = ["TBA", " ", "x", "???", "Online event", "To be announced", "Various locations", "n/a"]


@query(f"""WITH v AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 17 = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS ext,
  CASE WHEN c_custkey % 5 = 0 THEN ['{"', '".join(_ODD_NAMES)}'][CAST(c_custkey // 5 % 8 AS INTEGER) + 1] ELSE c_name END AS name,
  CASE WHEN c_custkey % 19 = 0 THEN 999.0 ELSE {_LAT} END AS lat, {_LON} AS lon, CASE WHEN c_nationkey % 9 = 0 THEN NULL ELSE c_nationkey END AS city, c_nationkey % 4 <> 0 AS enabled FROM customer)
SELECT k AS venue_id, CASE WHEN ext = '' THEN 'rejected:missing-external-id' WHEN trim(name) = '' THEN 'rejected:missing-name' WHEN length(trim(name)) < 2 THEN 'rejected:name-too-short'
 WHEN regexp_matches(lower(trim(name)), '^(tba|n/a|[?]+|online event|to be announced|various locations)$') THEN 'rejected:placeholder-venue-name'
 WHEN lat > 90 THEN 'rejected:invalid-coordinates' WHEN lat > 44.88 THEN 'needs_review:coordinates-out-of-region'
 WHEN city IS NOT NULL AND NOT enabled THEN 'needs_review:city-disabled' WHEN city IS NULL THEN 'needs_review:city-unresolved' ELSE 'ok:' END AS verdict FROM v""")
def record_validation(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    odd = F.element_at(F.array(*map(F.lit, _ODD_NAMES)), (F.floor(k / 5) % 8 + 1).cast("int"))
    v = table(spark, d, "customer").select(
        k, F.when(k % 17 == 0, "").otherwise(k.cast("string")).alias("ext"), F.when(k % 5 == 0, odd).otherwise(F.col("c_name")).alias("name"), F.when(k % 19 == 0, 999.0).otherwise(F.expr(overlay.LAT)).alias("lat"),
        F.expr(overlay.LON).alias("lon"), F.when(F.col("c_nationkey") % 9 != 0, F.col("c_nationkey")).alias("city"), (F.col("c_nationkey") % 4 != 0).alias("enabled"),
    )
    box = tuple(map(F.lit, (44.0, 44.88, 20.0, 21.0)))
    out = validate.venue_validation(F.col("ext"), F.col("name"), F.lit("key"), F.col("lat"), F.col("lon"), box, F.col("city"), F.col("enabled"))
    return v.select(k.alias("venue_id"), out.alias("v")).select("venue_id", F.concat_ws(":", "v.outcome", F.coalesce("v.code", F.lit(""))).alias("verdict"))


# ---- URLs and pages --------------------------------------------------------

_HOST = "regexp_replace(lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '^www\\.', '')"


@query(f"""WITH h AS (SELECT page_id, {_HOST} AS host FROM pages), l AS (SELECT page_id, string_split(host, '.') AS x FROM h)
SELECT page_id, CASE WHEN len(x) < 2 THEN NULL ELSE array_to_string(x[-2:], '.') END AS apex FROM l""")
def apex_domain(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", urls.apex_domain(F.col("url")).alias("apex"))


@query(r"""SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, CAST(length(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<svg.*?</svg>|<!--.*?-->', ' ', 'g')) AS BIGINT) AS clean_chars FROM pages""")
def page_title_meta(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", html.page_title(F.col("html")).alias("title"), F.length(html.strip_noise(F.col("html"))).cast("long").alias("clean_chars"))


@query(r"""SELECT page_id, link FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '(?i)<a[^>]+href=["'']([^"''#]+)', 1))) AS link FROM pages)""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.explode(pages.links(F.col("html"))).alias("link"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<svg.*?</svg>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_inline_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", html.inline_text(html.strip_noise(F.col("html"))).alias("text"))


@query()
def event_page_records(spark: SparkSession, d: str) -> DataFrame:
    return pages.events(table(spark, d, "pages")).select("url", "ok", "code", "title", "start_local", "venue", "city", "status")


@query("""SELECT 'https://example.org/event/u' || CAST(user_id AS VARCHAR) || '/' AS url, 'u' || CAST(user_id AS VARCHAR) AS ref, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS lastmod FROM events WHERE user_id % 7 <> 0 GROUP BY user_id""")
def latest_ref_per_url(spark: SparkSession, d: str) -> DataFrame:
    base = F.when(F.col("user_id") % 7 == 0, "https://example.org/event/").otherwise(F.concat(F.lit("https://example.org/event/u"), F.col("user_id").cast("string"), F.lit("/")))
    rows = table(spark, d, "events").select(base.alias("url"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("lastmod"))
    return sitemap.event_refs(rows).select("url", "ref", "lastmod")


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) WHERE k = 1 OR event_type = 'error'""")
def dedup_first_seen(spark: SparkSession, d: str) -> DataFrame:
    from placemark.sources.elements import once

    ref = F.when(F.col("event_type") == "error", "(unknown)").otherwise(F.concat_ws("/", F.col("user_id").cast("string"), "event_type"))
    return once(table(spark, d, "events").select("event_id", "user_id", "event_type", ref.alias("ref"), F.col("event_id").alias("position"))).select("event_id", "user_id", "event_type")


from placemark.plans import sync_queries  # noqa: E402, F401  registers its queries
from placemark.plans import function_queries  # noqa: E402, F401  registers its queries
from placemark.plans import run_queries  # noqa: E402, F401  registers its queries
