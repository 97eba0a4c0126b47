"""Source predicates, landed adapters, whole runs and stored snapshots on small cases."""

import json
import re

from pyspark.sql import functions as F

from placemark.operators import classify, predicates, runs, snapshots
from placemark.sources import landed

TAGS = [
    {"amenity": "bar"}, {"amenity": "Bar"}, {"amenity": "restaurant", "name": "Stara KAFANA"}, {"amenity": "restaurant"}, {"amenity": "theatre", "theatre:type": "music"}, {"club": "musical"},
    {"club": "music"}, {"craft": "brewery"}, {"amenity": "cafe", "shisha": "yes"}, {"amenity": "restaurant", "name": "Open Mic Place"}, {"leisure": "park"}, {}, {"amenity": "cafe", "live_music": ""},
    {"amenity": "pub", "name": "сплав Река"}, {"amenity": "community_centre", "community_centre": "youth_centre"}, {"name": "Curated One", "amenity": "library"}, {"amenity": "library"},
]


def by_text(query, tags, ref):
    """Whether a query text returns an element, read clause by clause."""
    for line in query.splitlines():
        ids = re.fullmatch(r"\s*(node|way|relation)\(id:([\d,]+)\);", line)
        if ids and ref.split("/")[0] == ids[1] and ref.split("/")[1] in ids[2].split(","):
            return True
        if not line.startswith("  nwr"):
            continue
        ok = True
        for key, op, value, flag in re.findall(r'\["([^"]+)"(?:(=|~)"([^"]*)"(,i)?)?\]', line):
            own = tags.get(key)
            ok &= own is not None and (op == "" or (own == value if op == "=" else bool(re.search(value, own, re.I if flag else 0))))
        if ok:
            return True
    return False


def test_predicate_is_the_query_text(spark):
    rescue = predicates.rescue_layer(("Curated One",), ("node/116", "way/9"))
    text = predicates.query_text(2728438, rescue=rescue)
    assert text.startswith("[out:json][timeout:240];\narea(id:3602728438)->.bg;\n(\n  // Layer A") and text.endswith("  node(id:116);\n  way(id:9);\n);\nout tags center;")
    assert '  nwr["amenity"="nightclub"](area.bg);' in text and '  nwr["amenity"~"^(restaurant|cafe)$"]["bar"="yes"](area.bg);' in text
    assert "curated" not in predicates.query_text(1) and "//" not in predicates.query_text(1, (), predicates.rescue_layer((), ("node/1",)))
    df = spark.createDataFrame([(f"node/{100 + i}", t) for i, t in enumerate(TAGS)], "ref string, tags map<string,string>")
    got = df.select("ref", predicates.predicate((*predicates.LAYERS, rescue), predicates.of_map(F.col("tags")), F.col("ref")).alias("hit")).collect()
    want = [by_text(text, t, f"node/{100 + i}") for i, t in enumerate(TAGS)]
    assert [r.hit for r in got] == want and {True, False} <= set(want)


def test_predicate_covers_the_classifier(spark):
    df = spark.createDataFrame([(t,) for t in TAGS], "tags map<string,string>")
    rows = df.select(predicates.predicate(predicates.LAYERS, predicates.of_map(F.col("tags"))).alias("asked"), classify.classified(F.col("tags"))["accepted"].alias("accepted"), F.element_at("tags", "amenity").alias("a")).collect()
    assert all(r.asked for r in rows if r.accepted and r.a != "Bar")


def test_predicate_reaches_the_scan(spark, tmp_path):
    names = {k: k.replace(":", "_") for t in TAGS for k in t}
    df = spark.createDataFrame([tuple(t.get(k) for k in names) for t in TAGS], ", ".join(f"`{n}` string" for n in names.values()))
    df.write.parquet(str(tmp_path / "t"))
    asked = spark.read.parquet(str(tmp_path / "t")).where(predicates.predicate(predicates.LAYERS, predicates.of_columns(names)))
    plan = asked._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("]")[0] if "PushedFilters" in plan else ""
    assert "amenity" in pushed and "Or(" in pushed
    assert asked.count() == sum(by_text(predicates.query_text(1), t, "node/1") for t in TAGS)


def element(n, **tags):
    return {"type": "node", "id": n, "lat": 44.8, "lon": 20.4, "tags": tags}


def test_landed_elements(spark, tmp_path):
    responses = {
        ("RS", "Belgrade"): [{"elements": [element(1, amenity="bar", name="A"), element(1, amenity="bar", name="again"), element(2, amenity="library", name="B")]}],
        ("RS", "Nis"): [{"elements": [element(1, amenity="pub", name="Other town, same number"), element(3, amenity="bar")]}],
        ("RS", "Novi Sad"): ["{not json"], ("HR", "Zagreb"): [{"remark": "timed out", "elements": [element(9, amenity="bar", name="Z")]}], ("HR", "Split"): [{"elements": []}], ("HR", "Rijeka"): [{"elements": [element(5, shop="books", name="S")]}],
    }
    for (country, city), parts in responses.items():
        folder = tmp_path / f"country={country}" / f"city={city}"
        folder.mkdir(parents=True)
        for k, part in enumerate(parts):
            (folder / f"{k}.json").write_text(part if isinstance(part, str) else json.dumps(part))
    source = landed.LandedElements(spark, str(tmp_path), "osm")
    refs = source.refs()
    assert {r.ref for r in refs.collect()} == {"/".join(k) for k in responses}
    raw = source.raw(refs)
    assert {(r.ref, r.ok) for r in raw.collect()} == {("RS/Belgrade", True), ("RS/Nis", True), ("RS/Novi Sad", False), ("HR/Zagreb", False), ("HR/Split", True), ("HR/Rijeka", True)}
    assert {(r.target, r.ref, r.bucket) for r in source.found(raw).collect()} == {
        ("RS/Belgrade", "node/1", "venue"), ("RS/Belgrade", "node/2", "excluded"), ("RS/Nis", "node/1", "venue"), ("RS/Nis", "node/3", "invalid"), ("HR/Rijeka", "node/5", "excluded")
    }
    assert sorted(r.name for r in source.records(raw).collect()) == ["A", "Other town, same number"]
    assert {tuple(r) for r in source.failures(refs, raw).collect()} == {("RS/Novi Sad", "invalid-json"), ("HR/Zagreb", "invalid-json"), ("HR/Split", "empty-result"), ("HR/Rijeka", "no-accepted-venues")}
    one = source.raw(refs.where("city = 'Nis'"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan and one.count() == 1


def test_landed_pages(spark):
    loc = lambda u: f"<url><loc>{u}</loc><lastmod>2026-01-0{len(u) % 9 + 1}</lastmod></url>"
    urls = [f"https://e.org/event/{n}/" for n in ("one", "gone", "broken")]
    maps = spark.createDataFrame([("<urlset>" + "".join(map(loc, [*urls, "https://e.org/event/"])) + "</urlset>",)], "body string")
    page = "<title>Night</title><body class='postid-7 eventcat-koncert'><div class='gt-detail-box'><ul><li class='gt-start-date'><div class='gt-title'>Datum</div><div class='gt-inner'>5. maja 2026. 21:00</div></li><li class='gt-venue'><div class='gt-title'>Lokacija</div><div class='gt-inner'><a href='/venue/hall/'>Hall</a></div></li></ul></div></body>"
    got = spark.createDataFrame([(urls[0], True, page), (urls[2], True, "<title>x</title>"), ("https://e.org/event/unasked/", True, page)], "url string, ok boolean, html string")
    source = landed.LandedPages(maps, got, "src", "Europe/Belgrade")
    assert source.refs().count() == 3 and source.refs(2).count() == 2
    raw = source.raw(source.refs())
    assert {(r.ref, r.ok) for r in raw.collect()} == {("one", True), ("gone", False), ("broken", True)}
    said = lambda path: landed.variant_text(F.col("reported"), path)
    rows = source.records(raw).select("external_id", "title", "start_local", "status", "time_zone", said("$.venue.slug").alias("slug"), said("$.categories[0]").alias("kind"), said("$.nothing.here").alias("none")).collect()
    assert [tuple(r) for r in rows] == [("7", "Night", "2026-05-05T21:00", "scheduled", "Europe/Belgrade", "hall", "koncert", None)]


def test_event_run_end_to_end(spark):
    """Seven pages: one gone, one without a date, one of no interest, four accepted; two unknown venues become candidates."""

    def page(n, title, venue, slug, city, kind="koncert", date="30. oktobra 2026. 21:00"):
        row = lambda cls, label, inner: f"<li class='{cls}'><div class='gt-title'>{label}</div><div class='gt-inner'>{inner}</div></li>"
        rows = row("gt-start-date", "Datum", date) + row("gt-venue", "Lokacija", f"<a href='/venue/{slug}/'>{venue}</a>") + row("gt-locations", "Mesto", city)
        return f"<title>{title} | Site</title><body class='postid-{n} eventcat-{kind}'><div class='gt-detail-box'><ul>{rows}</ul></div></body>"

    fetched = [
        ("u/intercell", True, page(25772, "Intercell", "Drugstore", "drugstore", "Beograd")), ("u/kamelot", True, page(23280, "Kamelot", "Hangar Luka", "hangar", "Beograd")),
        ("u/kamelot-2", True, page(23281, "Kamelot OTKAZANO", "Hangar Luka", "hangar", "Beograd")), ("u/standup", True, page(4, "Stand up", "Radnički dom", "radnicki", "Selo", "stand-up")),
        ("u/cars", True, page(5, "Supercar show", "Sajam", "sajam", "Beograd", "sport")), ("u/no-date", True, page(6, "Soon", "Hall", "hall", "Beograd", date="uskoro")), ("u/gone", False, None),
    ]
    none = F.lit(None).cast("string")
    stored = spark.createDataFrame([(1, 10, "osm", "node/1", "drugstore", 44.8, 20.5)], "venue_id int, city int, source string, external_id string, name_key string, lat double, lon double").withColumns({"wikidata": none, "website": none})
    cities = spark.createDataFrame([(10, "Beograd", True), (11, "Niš", True)], "city_id int, city string, enabled boolean")
    aliases = spark.createDataFrame([], "city int, alias_key string, canonical_key string")
    venue_pages = spark.createDataFrame([("hangar", "Hangar Luka", 44.83, 20.44, None)], "source_venue_id string, page_name string, lat double, lon double, address string")
    items = runs.event_run(spark.createDataFrame(fetched, "url string, fetched boolean, html string"), stored, cities, aliases, venue_pages, "src", (" | Site",))
    by = {r.url[2:]: r for r in items.collect()}
    assert {u: r.stage for u, r in by.items()} == {"intercell": "accepted", "kamelot": "accepted", "kamelot-2": "accepted", "standup": "accepted", "cars": "rejected", "no-date": "parse-failed", "gone": "fetch-failed"}
    assert by["no-date"].reason == "unparseable-date" and by["cars"].venue_status is None and by["gone"].title is None
    assert (by["intercell"].venue_status, by["intercell"].venue_id, by["intercell"].source_key) == ("matched_existing", 1, "src:25772")
    assert (by["kamelot"].venue_status, by["kamelot"].confidence, by["kamelot-2"].event_status) == ("safe_new_venue", "coordinates", "cancelled")
    assert by["kamelot"].identity == by["kamelot-2"].identity != by["intercell"].identity
    assert (by["standup"].tier, by["standup"].venue_code) == ("secondary", "city-unknown")
    c = runs.event_counters(items).first()
    assert (c.discovered, c.fetch_failed, c.parse_failed, c.rejected, c.accepted, c.primary, c.secondary, c.planned_inserts, c.status, c.healthy) == (7, 1, 1, 1, 4, 3, 1, 4, "ok", True)
    found = {r.candidate_key: r for r in runs.event_candidates(items).collect()}
    assert set(found) == {"svid:src:hangar", "svid:src:radnicki"}
    assert (found["svid:src:hangar"].status, found["svid:src:hangar"].event_count) == ("safe_new_venue", 2)
    assert (found["svid:src:radnicki"].status, found["svid:src:radnicki"].reason_codes) == ("needs_review", ["city-unknown"])
    assert runs.event_candidates(items, 0).where("status = 'safe_new_venue'").count() == 0


def test_venue_sync(spark):
    """What a source leaves out and what was pinned by hand are no changes; an owned venue is kept for its owner."""
    record = "city int, source string, external_id string, kind string, name_key string, lat double, lon double, outcome string, provided array<string>, name string, website_text string"
    rows = [
        (1, "osm", "same", "venue", "same", 44.0, 20.0, "ok", [], "Same", None), (1, "osm", "pinned", "venue", "pinned", 44.5, 20.0, "ok", [], "Pinned", None), (1, "osm", "moved", "venue", "moved", 44.5, 20.0, "ok", [], "Moved", None),
        (1, "osm", "erased", "venue", "erased", 44.0, 20.0, "ok", ["website_text"], "Erased", None), (1, "osm", "bad", "venue", "bad", 44.0, 20.0, "rejected", [], "Bad", None),
        (1, "osm", "new", "venue", "same", 44.0, 20.0, "ok", [], "Same", None), (1, "osm", "free", "venue", "free", 44.0, 20.0, "ok", [], "Free", None), (1, "osm", "twin", "venue", "twin", 44.0, 20.0, "ok", [], "Twin", None),
    ]
    none = F.lit(None).cast("string")
    records = spark.createDataFrame(rows, record).withColumns({"wikidata": none, "website": none})
    keep = lambda name: {"name": name.title(), "website_text": f"{name}.org"}
    links = spark.createDataFrame([("osm", n, k, n == "pinned", 44.0, 20.0, keep(n)) for k, n in enumerate(("same", "pinned", "moved", "erased", "bad"), 1)], "source string, external_id string, stored_id int, by_hand boolean, stored_lat double, stored_lon double, stored_fields map<string,string>")
    venues = [(k, 1, "osm", n, n) for k, n in enumerate(("same", "pinned", "moved", "erased", "bad"), 1)] + [(6, 1, "other", "f", "free"), (7, 1, "other", "t1", "twin"), (8, 1, "other", "t2", "twin")]
    stored = spark.createDataFrame([(*v, 44.0, 20.0) for v in venues], "venue_id int, city int, source string, external_id string, name_key string, lat double, lon double").withColumns({"wikidata": none, "website": none})
    planned = runs.venue_sync(records, links, stored, ("name", "website_text"), ("website_text",))
    assert {r.external_id: (r.status, r.operation, r.canonical_id) for r in planned.collect()} == {
        "same": ("UNCHANGED", "link-only", 1), "pinned": ("UNCHANGED", "link-only", 2), "moved": ("UPDATED", "update", 3), "erased": ("UPDATED", "update", 4), "bad": ("REJECTED", "review", None),
        "new": ("NEW", "insert", None), "free": ("NEW", "link-only", 6), "twin": ("NEW", "review", None),
    }
    assert {r.key: r.n for r in runs.upsert_counts(planned).collect()} == {"venue:link-only": 3, "venue:update": 2, "venue:insert": 1}
    df, seen = runs.observed(planned, "n", rows=F.count("*"), reviews=F.count_if(F.col("operation") == "review"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 8, "reviews": 2}
    shown = runs.category_breakdown(spark.createDataFrame([("b",), ("b",), ("z",)], "category string"), ("a", "b", "c")).orderBy("position").collect()
    assert [tuple(r) for r in shown] == [(0, "a", 0), (1, "b", 2), (2, "c", 0)]


def test_stored_snapshots(spark):
    at = lambda day: f"2026-01-{day:02} 00:00:00"
    rows = [("a", at(1), 1, False, "x"), ("a", at(3), 2, False, "y"), ("a", at(3), 3, False, "z"), ("b", at(2), 1, False, "x"), ("b", at(4), 2, True, None), ("c", at(9), 1, False, None)]
    v = spark.createDataFrame(rows, "key string, written string, version int, removed boolean, value string").withColumn("written_at", F.col("written").cast("timestamp")).drop("written")
    state = lambda day: {(r.key, r.version, r.value) for r in snapshots.as_of(v, F.lit(at(day)).cast("timestamp"), "key").collect()}
    assert state(2) == {("a", 1, "x"), ("b", 1, "x")} and state(3) == {("a", 3, "z"), ("b", 1, "x")} and state(4) == {("a", 3, "z")} and state(9) == {("a", 3, "z"), ("c", 1, None)}
    links = spark.createDataFrame([("s", str(i), k, i, "active", 0) for i, k in enumerate(("event", "event", "event", "venue", "venue", "venue"))], "source string, external_id string, kind string, canonical_id int, source_status string, misses int")
    ev = spark.createDataFrame([(0, at(1), "cancelled"), (1, at(8), "scheduled"), (3, at(1), "cancelled")], "event_id int, start string, status string").withColumn("start_at", F.col("start").cast("timestamp"))
    snap = snapshots.source_snapshot(links, ev, F.lit(at(5)).cast("timestamp"))
    assert {r.key: (r.frozen, r.cancelled) for r in snap.collect()} == {"s:0": (True, True), "s:1": (False, False), "s:2": (False, False), "s:3": (False, False), "s:4": (False, False), "s:5": (False, False)}
    seen = spark.createDataFrame([("s:1",), ("s:4",), ("s:9",)], "key string")
    scope = spark.createDataFrame([(3,)], "canonical_id int")
    assert {r.key for r in snapshots.in_scope(snap, seen, scope).collect()} == {"s:0", "s:1", "s:2", "s:3", "s:4"}
    assert {r.key for r in snapshots.in_scope(snap, seen, scope, partial=True).collect()} == {"s:1", "s:4"}
    assert snapshots.in_scope(snap, seen).count() == 6
