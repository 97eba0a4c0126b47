"""Decision lists, matching, change, lifecycle and apply on small cases."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from placemark.operators import apply, change, classify, config, events, match, reconcile, relevance, validate
from placemark.sources import elements, pages, sitemap
from placemark.streaming import lifecycle, reroute


def test_classifier(spark):
    cases = [
        ({"amenity": "bar"}, (True, "bar")), ({"amenity": "bar", "shop": "no"}, (True, "bar")), ({"amenity": "cafe", "music": "live"}, (True, "nightlife_venue")), ({"amenity": "theatre", "concert": "yes"}, (True, "concert_hall")),
        ({"amenity": "restaurant", "name": "Кафана Код Мике"}, (True, "kafana")), ({"amenity": "restaurant", "name": "Splav Bar X"}, (True, "other_nightlife")), ({"amenity": "restaurant", "name": "Splav čbarX"}, (False, None)),
        ({"amenity": "library", "live_music": "yes"}, (False, None)), ({"leisure": "dance"}, (True, "other_nightlife")), ({"was:amenity": "bar", "amenity": "bar"}, (False, None)), ({}, (False, None)),
        ({"amenity": "conference_centre"}, (False, None)), ({"craft": "brewery", "taproom": "yes"}, (True, "pub_brewery")), ({"amenity": "bar", "access": "private"}, (False, None)),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, tags map<string,string>")
    got = rows.select("i", classify.classified(F.col("tags")).alias("v"), classify.pushdown(F.col("tags")).alias("p")).orderBy("i").collect()
    assert [(r.v.accepted, r.v.category) for r in got] == [want for _, want in cases]
    assert all(r.p for r in got if r.v.accepted)  # the source-side predicate loses nothing


def test_rescue_and_bypass(spark):
    rows = spark.createDataFrame([("node/1", {"amenity": "conference_centre", "name": "Hall"}), ("node/2", {"amenity": "conference_centre", "name": "Hall"}), ("node/3", {"name": "Old Mill", "amenity": "cafe"})], "ref string, tags map<string,string>")
    rows = rows.withColumns({"country": F.lit("RS"), "city": F.lit("x")})
    rescues = spark.createDataFrame([(1, "RS", "x", "node/1", None, "concert_hall", "conference_centre"), (2, "RS", "x", None, "old mill", "nightclub", None)], "ordinal int, country string, city string, osm_ref string, alias_key string, category string, allowed_amenity string")
    got = {r.ref: (r.v.accepted, r.v.category) for r in classify.with_rescues(rows, rescues).select("ref", classify.classified(F.col("tags"), F.col("rescue_category"), F.col("bypass")).alias("v")).collect()}
    assert got == {"node/1": (True, "concert_hall"), "node/2": (False, None), "node/3": (True, "nightclub")}


def test_relevance(spark):
    cases = [
        (["koncert"], [], ("primary", "category")), (["festival"], ["wine"], (None, "festival of something else")), (["festival"], ["wine", "jazz"], ("primary", "festival with music")), (["docek"], ["noc"], (None, "new year without a party")),
        (["docek"], ["zurka"], ("secondary", "new year party")), ([], ["sajam", "koncert"], (None, "hard negative")), ([], ["festival", "film"], (None, "festival of something else")), ([], ["festival", "film", "party"], ("secondary", "nightlife")), ([], [], (None, "no signal")),
    ]
    rows = spark.createDataFrame([(i, c, t) for i, (c, t, _) in enumerate(cases)], "i int, c array<string>, t array<string>")
    got = rows.select("i", relevance.relevance(F.col("c"), F.col("t")).alias("r")).orderBy("i").collect()
    assert [(r.r.tier, r.r.reason) for r in got] == [w for *_, w in cases]


def test_placeholders(spark):
    cases = {"TBA": True, "​tba": True, "— …": True, "Live Stream": True, "": True, None: True, "🎵": False, "Zoom Club": False, "n/a": True}
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v string")
    assert [r.x for r in rows.select("i", validate.placeholder(F.col("v")).alias("x")).orderBy("i").collect()] == list(cases.values())


def test_event_times(spark):
    cases = [
        ("2026-10-30T23:00", None, "Europe/Belgrade", None), ("2026-02-30T23:00", None, "Europe/Belgrade", "invalid-start"), ("2026-03-29T02:30", None, "Europe/Belgrade", "invalid-start"), ("2026-10-30T23:00", "2026-10-30T22:00", "Europe/Belgrade", "end-before-start"),
        ("2026-10-30T23:00", "2026-10-30", "Europe/Belgrade", None), ("2026-10-30T23:00", "x", None, "invalid-end"), ("2026-10-30T23:00", None, "Mars/X", "invalid-time-zone"), ("2026-10-30T23:00Z", None, None, None),
    ]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s string, e string, z string, w string")
    got = rows.select("i", validate.event_instants(F.col("s"), F.col("e"), F.col("z"), ("Europe/Belgrade",)).alias("t")).orderBy("i").collect()
    assert [r.t.code for r in got] == [c[3] for c in cases]


IN = "incoming_id int, city string, source string, external_id string, wikidata string, website string, name_key string, lat double, lon double"
ST = IN.replace("incoming_id", "venue_id")


def test_match_tiers(spark):
    stored = spark.createDataFrame([
        (1, "b", "osm", "node/1", None, None, "kst", 44.8, 20.47), (2, "b", None, None, "Q1", "https://a.rs", "drugstore", 44.81, 20.48), (3, "b", None, None, None, None, "twin", None, None), (4, "b", None, None, None, None, "twin", None, None),
        (5, "b", None, None, None, None, "20 44", None, None), (6, "z", None, None, None, None, "kst", None, None),
    ], ST)
    incoming = spark.createDataFrame([
        (1, "b", "osm", "node/1", None, None, "x", 44.8, 20.47), (2, "b", "osm", "node/2", "Q1", None, "x", 44.8, 20.47), (3, "b", "osm", "node/3", None, "http://www.a.rs/q", "x", 44.8, 20.47), (4, "b", "osm", "node/4", None, None, "kst", 44.8, 20.47),
        (5, "b", "osm", "node/5", None, None, "twin", 44.8, 20.47), (6, "b", "osm", "node/6", None, None, "ds", 44.811, 20.48), (7, "b", "osm", "node/7", None, None, "ds far", 44.817, 20.48), (8, "b", "osm", "node/8", None, None, "ds away", 44.9, 20.48),
        (9, "b", "osm", "node/9", None, None, "raft", 44.9, 20.48), (10, "b", "osm", "node/10", None, None, "none", 44.9, 20.48), (11, "b", "osm", "node/11", None, None, "lost", 44.9, 20.48),
    ], IN)
    aliases = spark.createDataFrame([("b", "ds", "drugstore"), ("b", "ds far", "drugstore"), ("b", "ds away", "drugstore"), ("b", "raft", "20 44"), ("b", "lost", "gone")], "city string, alias_key string, canonical_key string")
    want = {1: ("match", 0, 1, False), 2: ("match", 1, 2, False), 3: ("match", 1, 2, False), 4: ("new", None, None, True), 5: ("skip", None, None, False), 6: ("match", 3, 2, False), 7: ("match", 3, 2, True), 8: ("new", None, None, True),
            9: ("match", 3, 5, False), 10: ("new", None, None, False), 11: ("new", None, None, True)}
    for parts in (1, 5):  # the set of rows decides, not their order or place
        got = match.match(incoming.repartition(parts), stored.repartition(parts), aliases)
        assert {r.incoming_id: (r.kind, r.tier, r.venue_id, r.review) for r in got.collect()} == want


def test_claims_in_order(spark):
    rows = spark.createDataFrame([("b", 1, 1, 2, 10), ("b", 2, 2, 2, 10), ("b", 2, 2, 2, 11), ("b", 3, 3, 2, 12), ("b", 4, 4, 2, 10)], "city string, position int, incoming_id int, tier int, venue_id int")
    assert {(r.incoming_id, r.venue_id) for r in match.claim(rows).collect()} == {(1, 10), (2, 11), (3, 12)}


def test_bands_and_identity(spark):
    row = lambda *a: spark.range(1).select(events.band(*[F.lit(x) for x in a]).alias("b")).first().b
    none = None
    assert row(True, False, 80, True, 0.7, False) == "automatic"
    assert row(True, False, 200, False, 0.5, False) == "probable"
    assert row(True, False, 300, False, 0.9, True) == "separate"
    assert row(True, False, 300, True, 0.1, False) == "ambiguous"
    assert row(False, True, 0, True, 1.0, True) == "separate"
    assert row(True, True, 9999, False, 0.0, False) == "automatic"
    new = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "event_id int")
    pairs = [(1, 10, "automatic"), (1, 11, "probable"), (2, 10, "automatic"), (2, 11, "automatic"), (3, 12, "separate"), (4, 13, "ambiguous")]
    for order in itertools.islice(itertools.permutations(pairs), 0, 720, 240):
        bands = spark.createDataFrame(list(order), "event_id int, other_id int, band string")
        empty = spark.createDataFrame([(5, 99)], "event_id int, canonical_id int")
        got = {r.event_id: (r.decision, r.tier, r.canonical_id) for r in events.identity(new, bands, empty, empty.limit(0)).collect()}
        assert got == {1: ("matched", 2, 10), 2: ("ambiguous", none, none), 3: ("new_candidate", 3, none), 4: ("ambiguous", none, none), 5: ("matched", 0, 99)}


def test_hash_agrees_with_deltas(spark):
    rows = spark.createDataFrame([(0.0, "a", -0.0, "a"), (1.0, None, 1.0, None), (1.0, None, 1.0, ""), (float("nan"), "a", None, "a")], "x double, y string, u double, v string")
    h = lambda a, b: change.content_hash({"n": change.number(F.col(a)), "t": F.col(b)})
    assert [r.same for r in rows.select((h("x", "y") == h("u", "v")).alias("same")).collect()] == [True, True, False, True]
    m = spark.createDataFrame([({"a": "1", "b": None}, {"b": None, "c": None, "a": "2"})], "o map<string,string>, n map<string,string>")
    got = m.select(change.field_deltas(F.col("o"), F.col("n")).alias("d")).first().d
    assert [(x.field, x.has_from, x.old, x.has_to, x.new) for x in got] == [("a", True, "1", True, "2"), ("c", False, None, True, None)]


def test_three_misses_then_return(spark):
    state = spark.createDataFrame([("v", "venue", "active", 0, False, False), ("e", "event", "active", 0, False, False), ("f", "event", "active", 0, True, False)], "key string, kind string, source_status string, misses int, frozen boolean, cancelled boolean")
    ok = spark.createDataFrame([(True,)], "healthy boolean")
    nothing = spark.createDataFrame([], "key string")
    seen = []
    for _ in range(3):
        state = spark.createDataFrame(lifecycle.advance(state, nothing, ok).collect(), state.schema)
        seen.append({r.key: r.source_status for r in state.collect()})
    assert seen == [{"v": "stale", "e": "stale", "f": "active"}, {"v": "missing", "e": "missing", "f": "active"}, {"v": "gone", "e": "gone", "f": "active"}]
    back = lifecycle.advance(state, spark.createDataFrame([("v",), ("e",)], "key string"), ok)
    assert {r.key: (r.source_status, r.misses) for r in back.collect()} == {"v": ("active", 0), "e": ("gone", 3), "f": ("active", 0)}
    sick = lifecycle.advance(state, nothing, spark.createDataFrame([(False,)], "healthy boolean"))
    assert {r.key: r.misses for r in sick.collect()} == {"v": 3, "e": 3, "f": 0}


def test_run_health(spark):
    rows = spark.createDataFrame([(0, 0, 0), (10, 5, 0), (10, 0, 3), (10, 0, 2)], "discovered int, fetch_failed int, parse_failed int")
    assert [r.status for r in reconcile.run_health(rows).collect()] == ["failed", "degraded", "degraded", "ok"]


def test_apply_then_nothing_changes(spark):
    stored = spark.createDataFrame([(1, "b", "s", "1", "A", None, None, None, None, 1.0, 2.0, "manual"), (2, "b", "t", "2", "B", "x", None, None, None, 1.0, 2.0, "source")], "venue_id long, city string, source string, external_id string, name string, address string, website string, description string, opening_hours string, lat double, lon double, coordinates_source string")
    plan = spark.createDataFrame([("update", 1, "s", "1", "b", "A2", "addr", None, None, None, 9.0, 9.0, "source"), ("update", 2, "s", "9", "b", "B2", None, None, None, None, 9.0, 9.0, "source"), ("insert", None, "s", "3", "b", "C", None, None, None, None, 3.0, 3.0, "source"), ("insert", None, "s", "4", "nowhere", "D", None, None, None, None, 3.0, 3.0, "source")], "operation string, venue_id long, source string, external_id string, city string, name string, address string, website string, description string, opening_hours string, lat double, lon double, coordinates_source string")
    cities = spark.createDataFrame([("b",)], "city string")
    after = apply.next_venues(stored, plan, cities)
    rows = {r.external_id: (r.name, r.address, r.lat) for r in after.collect()}
    assert rows == {"1": ("A2", "addr", 1.0), "2": ("B", "x", 1.0), "3": ("C", None, 3.0)}
    again = apply.next_venues(after, plan, cities)
    assert sorted(again.collect()) == sorted(after.collect())
    assert {(r.external_id, r.reason) for r in apply.deferred(stored, plan, cities).collect()} == {("9", "owned by another source"), ("4", "unknown city")}
    assert apply.commit_refusal("failed", True) and apply.commit_refusal("ok", False) and apply.commit_refusal("ok", True) is None


def test_preflight(spark):
    batch = spark.createDataFrame([(1, "a", "s", "READY", None, 7, "x", "x", "c"), (2, "a", "s", "READY", None, 7, "x", "x", "c"), (3, "b", "s", "REVIEW", None, 7, "x", "x", "c"), (4, " c", "s", "READY", None, 7, "x", "x", "c"), (5, "d", "s", "READY", None, 8, "x", "x", "c"), (6, "e", "s", "READY", None, 7, "x", "y", "c"), (7, "f", "s", "READY", None, 7, "x", "x", "c")], "position int, external_id string, source string, action string, contract_code string, venue_id int, planned_start string, own_start string, content string")
    venues, there = spark.createDataFrame([(7,)], "venue_id int"), spark.createDataFrame([("f",)], "external_id string")
    got = {r.position: r.reason for r in events.preflight(batch, venues, there, "s").collect()}
    assert got == {2: "duplicate", 3: "not ready", 4: "missing or untrimmed external id", 5: "unknown venue", 6: "planned start differs", 7: "exists"}


def test_elements(spark):
    rows = [(0, "node", 1, 44.8, 20.4, None, {"amenity": "bar", "name:sr": " Ime ", "addr:street": "S", "addr:housenumber": "1", "addr:city": "B"}), (1, "node", 1, 44.8, 20.4, None, {"amenity": "bar", "name": "again"}), (2, "way", 2, None, None, (44.8, 20.4), {"amenity": "school", "name": "S"}), (3, "node", 3, None, None, None, {"amenity": "bar", "name": "n"}), (4, "node", None, 1.0, 1.0, None, {}), (5, "node", None, 1.0, 1.0, None, {})]
    df = spark.createDataFrame(rows, "position int, type string, id long, lat double, lon double, center struct<lat: double, lon: double>, tags map<string,string>")
    got = elements.venues(df, "RS", "x").orderBy("ref").collect()
    assert [(r.ref, r.bucket) for r in got] == [("(unknown)", "invalid"), ("(unknown)", "invalid"), ("node/1", "venue"), ("node/3", "invalid"), ("way/2", "excluded")]
    assert (got[2].name, got[2].address) == ("Ime", "S 1, B")


def test_sitemap(spark):
    xml = "<urlset><url><loc> https://x/event/a/?q=1&amp;lt; </loc><lastmod>2026-01-01</lastmod></url><url><loc>https://x/event/a/?q=1&amp;lt;</loc><lastmod>2026-02-01</lastmod></url><url><loc>https://x/event/</loc></url><url><loc>https://x/event/b</loc></url></urlset>"
    got = sitemap.event_refs(sitemap.entries(spark.createDataFrame([(xml,)], "body string"))).collect()
    assert [(r.url, r.lastmod, r.ref) for r in got] == [("https://x/event/a/?q=1&lt;", "2026-02-01", "a"), ("https://x/event/b", None, "b")]


PAGE = """<html><head><title>Bend X &#8211; ODLOŽENO | Site</title><meta property="og:image" content="i.jpg"></head><body class="single postid-77"><!-- <li class="gt-venue"> -->
<div class="gt-detail-box"><ul><li class="gt-start-date"><div class="gt-title">Datum</div><div class="gt-inner">petak 30. oktobra 2026. 23.00</div></li>
<li class="gt-venue"><div class="gt-title">Lokacija</div><div class="gt-inner"><div class="icon"></div><a href="/venue/klub-x/">Klub X</a></div></li>
<li class="gt-locations"><div class="gt-title">Mesto</div><div class="gt-inner"><a href="/location/beograd/">Beograd</a></div></li></ul></div></body></html>"""


def test_event_page(spark):
    df = spark.createDataFrame([("https://s/event/x/", PAGE), ("https://s/event/y/", "<title>Page not found</title>"), ("https://s/event/z/", "<title>T</title>"), ("https://s/q", None)], "url string, html string")
    got = {r.url[-2]: r for r in pages.events(df, (" | Site",)).collect()}
    x = got["x"]
    assert (x.ok, x.external_id, x.title, x.start_local, x.venue, x.venue_slug, x.city, x.city_slug, x.status) == (True, "77", "Bend X – ODLOŽENO", "2026-10-30T23:00", "Klub X", "klub-x", "Beograd", "beograd", "postponed")
    assert (got["y"].code, got["z"].code, got["/"].code) == ("not-found-page", "missing-details", "missing-title")


def test_venue_page(spark):
    html = '<title>Hala</title><body class="single-venue postid-5"><div data-lat="44.8" data-lng="20.4"></div><div class="gt-title">Adresa</div><div class="gt-inner">Ulica 1</div></body>'
    got = pages.venue_pages(spark.createDataFrame([("u", html), ("v", html.replace("44.8", "0").replace("20.4", "0")), ("w", html.replace("single-venue", "page"))], "url string, html string")).orderBy("url").collect()
    assert [(r.ok, r.code, r.lat, r.address) for r in got] == [(True, None, 44.8, "Ulica 1"), (True, None, None, "Ulica 1"), (False, "not-a-venue-page", None, None)]


def test_config_checks():
    with pytest.raises(ValueError):
        config.SyncConfig((config.City("RS", "A"), config.City("rs", " a ")))
    with pytest.raises(ValueError):
        config.SyncConfig((), config.Thresholds(stale=3, missing=2))


def test_reroute_measures_from_the_last_accepted(spark):
    step = 0.0003  # about 33 m
    pts = [(1, i, i, 44.8 + i * step, 20.4, 0) for i in range(5)]
    df = spark.createDataFrame(pts, "user_id long, event_id long, ts long, lat double, lon double, result_set long")
    assert [r.routed for r in reroute.throttled(df).orderBy("event_id").collect()] == [True, False, True, False, True]


def test_reroute_stream_keeps_its_state(spark, tmp_path):
    step = 0.0003
    source = str(tmp_path / "in")
    schema = "user_id long, event_id long, ts long, lat double, lon double, result_set long"
    for i in range(5):
        spark.createDataFrame([(1, i, i, 44.8 + i * step, 20.4, 0)], schema).coalesce(1).write.mode("append").parquet(source)
        run = reroute.throttled_stream(spark.readStream.schema(schema).parquet(source)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        run.awaitTermination(120)
    assert [r.routed for r in spark.read.parquet(str(tmp_path / "out")).orderBy("event_id").collect()] == [True, False, True, False, True]


def claims_by_hand(rows):
    """rows: (city, position, incoming, tier, venue) -> what serving one row after another gives."""
    by = {}
    for city, position, incoming, tier, venue in rows:
        by.setdefault((city is None, city, position, incoming), []).append((tier, venue))
    taken, out = set(), set()
    for (_, city, _, incoming), options in sorted(by.items(), key=lambda x: (x[0][0], str(x[0][1]), *x[0][2:])):
        free = [v for _, v in sorted(options) if (city, v) not in taken]
        if free:
            taken.add((city, free[0]))
            out.add((city, incoming, free[0]))
    return out


@pytest.mark.parametrize("cities,venues,options", [(3, 40, 4), (1, 15, 3), (1, 3, 2)])
def test_claims_are_those_of_one_after_another(spark, cities, venues, options):
    r = random.Random(venues)
    rows = []
    for k in range(90):
        city, position = r.choice(["a", "b", None][:cities]), r.randint(0, 500)
        rows += [(city, position, k, r.randint(0, 3), v) for v in r.sample(range(venues), r.randint(1, options))]
    rows += [("a", 1, 900 + k, 0, 7) for k in range(30)]  # a venue that very many want
    df = spark.createDataFrame(rows, "city string, position int, incoming_id int, tier int, venue_id int")
    assert {tuple(x) for x in match.claim(df).collect()} == claims_by_hand(rows)


def test_claims_in_a_chain(spark):
    """Each row waits for the one before it; and nothing to claim at all."""
    rows = [("a", k, k, t, k - 1 + t) for k in range(1, 7) for t in (0, 1)]
    df = spark.createDataFrame(rows, "city string, position int, incoming_id int, tier int, venue_id int")
    assert {tuple(x) for x in match.claim(df).collect()} == claims_by_hand(rows)
    none = match.claim(df.where("false"))
    assert none.columns == ["city", "incoming_id", "venue_id"] and none.count() == 0


def test_near_grid_finds_all_and_stays_small(spark):
    """Rows with one hot word: near ones meet at any latitude and over the date line, far ones share no cell."""
    r = random.Random(4)
    rows = []
    for lat, lon in ((44.8, 20.45), (0.0, 0.0), (69.6, 179.9995), (-89.9999, 10.0), (60.0, -180.0)):
        for _ in range(60):
            rows.append((len(rows), "x", "hot spot", max(-90.0, min(90.0, lat + r.uniform(-3, 3) / 1000)), (lon + r.uniform(-4, 4) / 1000 + 180) % 360 - 180))
    strip = [(1000 + k, "x", "hot spot", 44.5, 20.0 + k * 0.003) for k in range(400)]  # one band of latitude, as wide as a city
    df = spark.createDataFrame(rows + strip, "incoming_id int, city string, name_key string, lat double, lon double")

    def metres(a, b):
        la, lb = math.radians(a[3]), math.radians(b[3])
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[4] - a[4]) / 2) ** 2
        return math.floor(2 * 6_371_000 * math.asin(min(1.0, math.sqrt(h))) + 0.5)

    every = rows + strip
    want = {(a[0], b[0]) for a in every for b in every if a[0] != b[0] and metres(a, b) <= match.NEAR_NEW_METRES}
    assert {(x.incoming_id, x.other_id) for x in match.near_new(df).collect()} == want and len(want) > 500
    cells = df.where("incoming_id >= 1000").select(F.explode(match.near_grid(F.col("lat"), F.col("lon"), match.NEAR_NEW_METRES)).alias("at"))
    assert cells.groupBy("at").count().agg(F.max("count")).first()[0] <= 8


def test_window_join_has_no_residual(spark):
    """A venue with very many events: as many pairs leave the join as are in the window."""
    rows = spark.range(4000).selectExpr("id as event_id", "id % 2 as venue_id", "timestamp_seconds(1700000000 + id * 3600) as start_at")
    new = rows.where("event_id % 10 = 0")
    pairs = events.window_pairs(new, rows)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert ">=" not in join and "<" not in join and join.count("=") == 2
    day = lambda k: (1700000000 + k * 3600) // 86400
    want = {(a, b) for a in range(0, 4000, 10) for b in range(max(0, a - 80), min(4000, a + 80)) if a % 2 == b % 2 and -1 <= day(b) - day(a) <= 1}
    assert {(x[0], x[1]) for x in pairs.select(F.col("i.event_id"), F.col("s.event_id").alias("other")).collect()} == want


def _claimed_in_turn(candidates):
    best: dict = {}
    for city, position, row, tier, venue in candidates:
        best.setdefault((city, position, row), set()).add((tier, venue))
    taken, out = set(), []
    for (city, _, row), venues in sorted(best.items()):
        free = [v for _, v in sorted(venues) if (city, v) not in taken]
        if free:
            taken.add((city, free[0]))
            out.append((city, row, free[0]))
    return sorted(out)


@pytest.mark.parametrize("together", [0, 50_000])
def test_claims_of_one_name_take_few_rounds(spark, monkeypatch, together):
    """Rows that wait for one another in long lists, some of which push others on, are served as one by one, in few rounds or in one task."""
    monkeypatch.setattr(match, "TOGETHER", together)
    r = random.Random(5)
    lists = [(c, r.sample(range(60), r.randint(1, 40))) for c in (1, 2) for _ in range(6)] + [(3, list(range(80)))]
    each = [r.choice(lists) if k < 400 else lists[-1] for k in range(500)]
    candidates = [(c, k, k, v % 3, v) for k, (c, vs) in enumerate(each) for v in vs]
    cuts = []
    monkeypatch.setattr(match, "cut", lambda df, cut=match.cut: cuts.append(1) or cut(df))
    got = match.claim(spark.createDataFrame(candidates, "city int, position int, incoming_id int, tier int, venue_id int"))
    assert sorted(map(tuple, got.collect())) == _claimed_in_turn(candidates)
    assert len(cuts) < 50  # a round cuts twice; row by row there are 80 rounds and more


def test_claims_by_first_tier_keys(spark):
    """Brought together by their keys, rows are served as by the edges of their pairs."""
    r = random.Random(6)
    kind = "city int, source string, external_id string, wikidata string, website string, name_key string, lat double, lon double"
    of = lambda: (r.choice([1, 2, None]), r.choice(["a", "b", None]), r.choice([None, "", *map(str, range(30))]), r.choice([None, "", "Q1", "Q2"]), r.choice([None, "https://www.x.example/a", "http://y.example"]), r.choice([None, "", *"pqr"]), None, None)
    incoming = spark.createDataFrame([(k, 100 - k, *of()) for k in range(80)] + [(None, 1, *of())], "incoming_id int, position int, " + kind)
    stored = spark.createDataFrame([(k, *of()) for k in range(90)] + [(None, *of())], "venue_id int, " + kind)
    edges = match.edges(incoming, stored).join(incoming.select("incoming_id", "city", "position"), "incoming_id")
    want = match.claim(edges.select("city", "position", "incoming_id", "tier", "venue_id"))
    got = sorted(map(tuple, match.claim_first(incoming, stored).collect()))
    assert len(got) > 30 and got == sorted(map(tuple, want.collect()))
