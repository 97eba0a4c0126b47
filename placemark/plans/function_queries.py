"""Column functions and page parsers over values built from the provided tables, with their oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemark.functions import html, text, timeutil, urls
from placemark.plans.sql import query
from placemark.sources import adapter, elements, pages, sitemap
from placemark.sources.tables import table

_HOSTS = ["www.klub.example", "facebook.com", "m.facebook.com", "linktr.ee", "a.b.com.rs", "hala.rs"]
_PATHS = ["/e/{}", "/event/{}", "/x/sectionGroup/index/{}/y", "/about", "/event/none", ""]


@query(f"""WITH u AS (SELECT o_orderkey AS k, ['{"', '".join(_HOSTS)}'][CAST(o_orderkey % 6 AS INTEGER) + 1] AS h, replace(['{"', '".join(_PATHS)}'][CAST(o_orderkey // 6 % 6 AS INTEGER) + 1], '{{}}', CAST(o_orderkey AS VARCHAR)) AS p FROM orders)
SELECT k AS row_id, CASE h WHEN 'www.klub.example' THEN 'klub.example' WHEN 'a.b.com.rs' THEN 'b.com.rs' WHEN 'hala.rs' THEN 'hala.rs' END AS domain, CASE WHEN k // 6 % 6 < 3 THEN CAST(k AS VARCHAR) END AS ticket FROM u""")
def ticket_and_domain(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    pick = lambda of, n: F.element_at(F.array(*map(F.lit, of)), (n % 6 + 1).cast("int"))
    url = F.concat(F.lit("https://"), pick(_HOSTS, k), F.replace(pick(_PATHS, F.floor(k / 6)), F.lit("{}"), k.cast("string")))
    rows = table(spark, d, "orders").select(k.alias("row_id"), url.alias("url"))
    return rows.select("row_id", urls.dedicated_domain(F.col("url")).alias("domain"), urls.ticket_id(F.col("url")).alias("ticket"))


_ZONE = "Etc/GMT-2"  # two hours before UTC all year


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) AS t, CAST(o_orderdate AS TIMESTAMP) AS day FROM orders)
SELECT k AS row_id, strftime(t + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M') AS shown, strftime(CASE k % 3 WHEN 0 THEN t - INTERVAL 2 HOUR WHEN 1 THEN t - INTERVAL 3 HOUR ELSE day END, '%Y-%m-%d %H:%M') AS past_test,
 strftime(CASE k % 3 WHEN 0 THEN t - INTERVAL 2 HOUR WHEN 1 THEN t - INTERVAL 3 HOUR ELSE day - INTERVAL 2 HOUR END, '%Y-%m-%d %H:%M') AS compared, CASE WHEN k % 3 = 2 THEN NULL ELSE strftime(t, '%H:%M') END AS clock FROM o""")
def clock_readings(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    at = F.expr("cast(o_orderdate as timestamp) + make_dt_interval(0, int(o_orderkey % 24), int(o_orderkey % 60))")
    rows = table(spark, d, "orders").select(k.alias("row_id"), at.alias("at"), F.to_date("o_orderdate").cast("string").alias("day"))
    local = F.when(k % 3 == 0, F.date_format("at", "yyyy-MM-dd'T'HH:mm")).when(k % 3 == 1, F.date_format("at", "yyyy-MM-dd'T'HH:mm'+03:00'")).otherwise(F.col("day"))
    rows = rows.withColumn("o_orderkey", F.col("row_id")).withColumn("local", local)
    minute = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    zone = F.lit(_ZONE)
    return rows.select(
        "row_id", timeutil.instant_to_local(F.col("at"), zone).alias("shown"), minute(timeutil.to_instant(F.col("local"), zone)).alias("past_test"), minute(timeutil.comparison_instant(F.col("local"), zone)).alias("compared"),
        timeutil.time_of_day(F.when(k % 3 != 2, F.date_format("at", "H:mm"))).alias("clock"),
    )


_MONTHS = ["januar", "februara", "mart", "april", "maja", "juni", "jul", "avgusta", "septembar", "oktobra", "novembar", "decembra"]


@query(f"""WITH o AS (SELECT o_orderkey AS k, o_orderdate AS t FROM orders)
SELECT k AS row_id, CASE k % 4 WHEN 0 THEN strftime(t, '%Y-%m-%d') WHEN 1 THEN strftime(t, '%Y-%m-%d') || 'T21:05' END AS local, CASE k % 4 WHEN 0 THEN 'date' WHEN 1 THEN 'datetime' END AS precision FROM o""")
def serbian_dates(spark: SparkSession, d: str) -> DataFrame:
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    month = F.element_at(F.array(*map(F.lit, _MONTHS)), F.month(at))
    date = F.concat(F.dayofmonth(at).cast("string"), F.lit(". "), F.initcap(month), F.lit(" "), F.year(at).cast("string"), F.lit("."))
    raw = F.when(k % 4 == 0, date).when(k % 4 == 1, F.concat(F.lit("Petak, "), date, F.lit(" u 21.05h"))).when(k % 4 == 2, F.concat(date, F.lit(" 25:10"))).otherwise("uskoro")
    s = table(spark, d, "orders").select(k.alias("row_id"), timeutil.serbian_datetime(raw).alias("s"))
    return s.select("row_id", "s.local", "s.precision")


@query("""WITH c AS (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s FROM customer)
SELECT k AS row_id, 'ulica ' || CASE WHEN k % 2 = 0 THEN 'cara dusana' ELSE lower(s) END AS address_key, k % 3 = 0 AS shares FROM c""")
def address_and_shared_words(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    address = F.concat(F.lit("Ulica "), F.when(k % 2 == 0, "Cara Dušana").otherwise(F.col("c_mktsegment")), F.lit(" "), k.cast("string"))
    a = F.concat(F.lit("Veliki Klub "), F.col("c_mktsegment"))
    b = F.when(k % 3 == 0, F.concat(F.lit("x klúb "), k.cast("string"))).otherwise(F.concat(F.lit("x dom "), k.cast("string")))
    return table(spark, d, "customer").select(k.alias("row_id"), text.address_key(address).alias("address_key"), text.shares_token(a, b).alias("shares"))


@query("""SELECT c_custkey AS row_id, CASE WHEN c_custkey % 3 < 2 THEN c_name END AS title, CASE WHEN c_custkey % 5 = 0 THEN 'x' || CAST(c_custkey AS VARCHAR) END AS image,
 CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_name || ' - Other' END AS page_title, c_mktsegment || chr(10) || 'second & last' AS lines FROM customer""")
def page_meta_and_blocks(spark: SparkSession, d: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    title = F.when(k % 3 == 0, F.concat(F.lit('<meta property="og:title" content="'), name, F.lit('">'))).when(k % 3 == 1, F.concat(F.lit("<meta content='"), name, F.lit("' name='og:title' />"))).otherwise("")
    image = F.when(k % 5 == 0, F.concat(F.lit('<meta charset="utf-8"><meta name="og:image" content="x'), k.cast("string"), F.lit('">'))).otherwise("")
    head = F.concat(F.lit("<title> "), name, F.when(k % 2 == 0, " | Site").otherwise(" - Other"), F.lit("</title>"), title, image)
    page = F.concat(head, F.lit("<body>"))
    body = F.concat(F.lit("<div><p>"), F.col("c_mktsegment"), F.lit("</p><p> <br/> </p><p>second   &amp; <b>last</b></p></div>"))
    return table(spark, d, "customer").select(
        k.alias("row_id"), html.meta_content(page, "og:title").alias("title"), html.meta_content(page, "og:image").alias("image"), html.page_title(page, (" | Site",)).alias("page_title"), html.block_text(body).alias("lines")
    )


def _page(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


@query("""WITH c AS (SELECT c_custkey AS k, c_name AS n, lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') AS dd FROM customer)
SELECT k AS row_id, CASE WHEN k % 7 = 0 THEN 'missing-title' WHEN k % 11 = 0 THEN 'not-found-page' WHEN k % 13 = 0 THEN 'missing-details' WHEN k % 17 = 0 THEN 'unparseable-date' WHEN k % 19 = 0 THEN 'missing-location' END AS code,
 CASE WHEN k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0 THEN NULL ELSE CAST(k AS VARCHAR) || '|' || n || CASE WHEN k % 3 = 0 THEN ' OTKAZANO' ELSE '' END || '|2026-10-' || dd || 'T20:30|Klub ' || CAST(k AS VARCHAR) || '|klub-' || CAST(k AS VARCHAR) || '|Novi Sad|'
  || CASE WHEN k % 3 = 0 THEN 'cancelled' WHEN k % 5 = 0 THEN 'postponed' ELSE '' END || '|' || CASE WHEN k % 2 = 0 THEN 'About ' || n || chr(10) || 'Doors & more' ELSE 'short text' END END AS record FROM c""")
def event_pages_parsed(spark: SparkSession, d: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    key = k.cast("string")
    title = F.when(k % 7 == 0, "").when(k % 11 == 0, "Page not found").otherwise(F.concat(name, F.when(k % 3 == 0, " OTKAZANO").otherwise("")))
    row = lambda cls, label, *inner: _page(f"<li class='{cls}'><div class='gt-title'>{label}</div><div class='gt-inner'>", *inner, "</div></li>")
    date = F.when(k % 17 == 0, "uskoro").otherwise(_page((k % 28 + 1).cast("string"), ". oktobra 2026. 20:30"))
    place = F.when(k % 19 == 0, "").otherwise(_page(row("gt-venue", "Lokacija", "<a href='/venue/klub-", key, "/'>Klub ", key, "</a>"), row("gt-locations", "Mesto", "<a href='/location/novi-sad/'>Novi Sad</a>")))
    box = F.when(k % 13 == 0, "").otherwise(_page("<div class='gt-detail-box'><ul>", row("gt-start-date", "Datum", date), place, "</ul></div>"))
    about = F.when(k % 2 == 0, _page("<div class='gt-section-title'> O događaju</div><div class='gt-content'><p>About ", name, "</p><p>Doors &amp; <b>more</b></p></div></div></div>")).otherwise("")
    page = _page("<title>", title, " | Site</title><meta content='short text' property='og:description'><body class='postid-", key, F.when(k % 5 == 0, " eventcat-odlozeno-otkazano").otherwise(""), "'><script>var x='<title>no</title>'</script>", box, about, "</body>")
    page = F.when(k % 7 == 0, F.regexp_replace(page, "<title>.*?</title>", "")).otherwise(page)
    parsed = pages.events(table(spark, d, "customer").select(key.alias("url"), page.alias("html")), (" | Site",))
    record = F.concat_ws("|", "external_id", "title", "start_local", "venue", "venue_slug", "city", F.coalesce("status", F.lit("")), "description")
    return parsed.select(F.col("url").cast("long").alias("row_id"), "code", F.when(F.col("ok"), record).alias("record"))


@query("""SELECT c_custkey AS row_id, CASE WHEN c_custkey % 7 = 0 THEN 'missing-name' WHEN c_custkey % 11 = 0 THEN 'not-a-venue-page' END AS code, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN c_name END AS name,
 CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 3 > 0 THEN 'Ulica ' || CAST(c_custkey AS VARCHAR) END AS address, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN CASE WHEN c_custkey % 3 > 0 THEN 'Novi Sad' ELSE 'Beograd' END END AS city,
 CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 5 > 1 THEN 44.0 + CAST(c_custkey % 10 AS DOUBLE) END AS lat FROM customer""")
def venue_pages_parsed(spark: SparkSession, d: str) -> DataFrame:
    k, key = F.col("c_custkey"), F.col("c_custkey").cast("string")
    detail = lambda label, value: _page(f"<div class='gt-title'>{label}</div><div class='gt-inner'>", value, "</div>")
    details = F.when(k % 3 > 0, _page(detail("Adresa", _page("Ulica ", key)), detail("Mesto", "Novi Sad"))).otherwise("")
    point = F.when(k % 5 == 0, "<div data-lat='0' data-lng='0'></div>").when(k % 5 == 1, "<div data-lat='999' data-lng='20.5'></div>").otherwise(_page("<div data-lat='", (F.lit(44) + k % 10).cast("string"), ".0' data-lng='20.5'></div>"))
    head = F.when(k % 7 == 0, "").otherwise(_page("<title>", F.col("c_name"), "</title>"))
    page = _page(head, "<meta property='og:description' content='Beograd, Srbija'><body class='", F.when(k % 11 == 0, "page").otherwise("single-venue"), " postid-", key, "'>", point, details, "</body>")
    parsed = pages.venue_pages(table(spark, d, "customer").select(key.alias("url"), page.alias("html")))
    return parsed.select(F.col("url").cast("long").alias("row_id"), "code", "name", "address", "city", "lat")


# ---- elements and sitemaps ---------------------------------------------------------

_ELEMENTS = """x AS (SELECT c_custkey AS k, c_nationkey AS city, c_custkey % 5 = 4 AS way, c_custkey % 7 = 0 AS nameless, c_custkey % 11 = 0 AS lost, ['bar', 'school', 'nightclub'][CAST(c_custkey % 3 AS INTEGER) + 1] AS am, c_name AS n FROM customer),
v AS (SELECT *, CASE WHEN nameless OR lost THEN 'invalid' WHEN am = 'school' THEN 'excluded' ELSE 'venue' END AS bucket FROM x)"""


def _elements(spark: SparkSession, d: str) -> DataFrame:
    """Customers as map elements, each of them twice; the second of a pair is never seen."""
    k = F.col("c_custkey")
    lat, lon = F.when(k % 11 == 0, 95.0).otherwise(44.5), F.lit(20.5)
    way = k % 5 == 4
    amenity = F.element_at(F.array(F.lit("bar"), F.lit("school"), F.lit("nightclub")), (k % 3 + 1).cast("int"))
    name = F.when(k % 7 == 0, F.lit(" ")).otherwise(F.col("c_name"))
    place = F.struct(lat.alias("lat"), lon.alias("lon"))
    rows = table(spark, d, "customer").select(
        "c_nationkey", (k * 2).alias("position"), F.when(way, "way").otherwise("node").alias("type"), k.alias("id"), F.when(~way, lat).alias("lat"), F.when(~way, lon).alias("lon"), F.when(way, place).alias("center"),
        F.create_map(F.lit("amenity"), amenity, F.when(k % 2 == 0, "name").otherwise("name:en"), name, F.lit("addr:street"), F.lit("Ulica"), F.lit("addr:housenumber"), k.cast("string"), F.lit("addr:city"), F.when(k % 4 == 0, "Grad").otherwise(""), F.lit("wikidata"), F.when(k % 6 == 0, "Q1").otherwise(" ")).alias("tags"),
    )
    later = rows.withColumns({"position": F.col("position") + 1, "tags": F.create_map(F.lit("name"), F.lit("second sight"))})
    return rows.unionByName(later)


@query(f"""WITH {_ELEMENTS} SELECT CASE WHEN way THEN 'way/' ELSE 'node/' END || CAST(k AS VARCHAR) AS ref, bucket, CASE WHEN nameless THEN 'missing name' WHEN lost THEN 'missing or invalid coordinates' WHEN am = 'school' THEN 'institution' END AS reason,
 CASE WHEN nameless THEN NULL ELSE n END AS name, 'Ulica ' || CAST(k AS VARCHAR) || CASE WHEN k % 4 = 0 THEN ', Grad' ELSE '' END AS address FROM v""")
def element_venues(spark: SparkSession, d: str) -> DataFrame:
    return elements.venues(_elements(spark, d).drop("c_nationkey"), "RS", "x").select("ref", "bucket", "reason", "name", "address")


@query(f"""WITH {_ELEMENTS} SELECT CASE WHEN way THEN 'way/' ELSE 'node/' END || CAST(k AS VARCHAR) AS external_id, CASE WHEN k % 6 = 0 THEN 'address,wikidata' ELSE 'address' END AS provided FROM v WHERE bucket = 'venue'""")
def element_records(spark: SparkSession, d: str) -> DataFrame:
    records = elements.records(elements.venues(_elements(spark, d).drop("c_nationkey"), "RS", "x"), "osm")
    return records.select("external_id", F.array_join(F.array_sort(F.map_keys("provided")), ",").alias("provided"))


@query(f"""WITH {_ELEMENTS} SELECT city, count(*) AS fetched, count(*) FILTER (bucket = 'venue') AS kept, count(*) FILTER (bucket = 'invalid') AS invalid, count(*) FILTER (bucket = 'excluded') AS excluded FROM v GROUP BY 1""")
def collected_by_target(spark: SparkSession, d: str) -> DataFrame:
    rows = _elements(spark, d)
    town = rows.select(elements.reference(F.col("type"), F.col("id")).alias("ref"), F.col("c_nationkey").alias("city")).distinct()
    return adapter.collected(elements.venues(rows.drop("c_nationkey"), "RS", "x").join(town, "ref"), "city")


@query("""SELECT n_nationkey AS ref, CASE WHEN n_nationkey % 5 = 0 THEN 'invalid-json' WHEN n_nationkey % 3 = 0 OR c.n IS NULL THEN 'empty-result' WHEN c.kept = 0 THEN 'no-accepted-venues' END AS code FROM nation
 LEFT JOIN (SELECT c_nationkey, count(*) AS n, count(*) FILTER (c_acctbal > 9900) AS kept FROM customer GROUP BY 1) c ON c.c_nationkey = n_nationkey WHERE code IS NOT NULL""")
def target_failure_codes(spark: SparkSession, d: str) -> DataFrame:
    refs = table(spark, d, "nation").select(F.col("n_nationkey").alias("ref"))
    counts = table(spark, d, "customer").where("c_nationkey % 3 <> 0").groupBy(F.col("c_nationkey").alias("ref")).agg(F.count("*").alias("fetched"), F.count_if(F.col("c_acctbal") > 9900).alias("kept"))
    return adapter.target_failures(refs, counts, refs.where("ref % 5 = 0"))


@query("""SELECT 'https://s.example/event/e' || CAST(o_orderkey AS VARCHAR) || '/?a=1&b=2' AS url, strftime(o_orderdate, '%Y-%m-%d') AS lastmod, 'e' || CAST(o_orderkey AS VARCHAR) AS ref FROM orders WHERE o_orderkey % 4 <> 0""")
def sitemap_refs(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    loc = F.concat(F.lit("https://s.example/"), F.when(k % 4 == 0, "venue/e").otherwise("event/e"), k.cast("string"), F.lit("/?a=1&amp;b=2"))
    one = F.concat(F.lit("<url>\n <loc> "), loc, F.lit(" </loc><lastmod>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</lastmod></url>"))
    xml = table(spark, d, "orders").groupBy(F.col("o_custkey")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(one), ""), F.lit("</urlset>")).alias("body"))
    return sitemap.event_refs(sitemap.entries(xml)).select("url", "lastmod", "ref")


@query("SELECT count(*) = 50 AS partial FROM (SELECT o_orderkey FROM orders ORDER BY 1 LIMIT 50)")
def limited_discovery(spark: SparkSession, d: str) -> DataFrame:
    return adapter.limited(table(spark, d, "orders").select("o_orderkey").orderBy("o_orderkey"), 50)[1]

