"""Value tables of the column functions."""

from pyspark.sql import functions as F

from placemark.functions import geo, html, text, timeutil, urls


def values(spark, cases, make):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, v string")
    return [r.x for r in rows.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strict_name(spark):
    cases = {
        "Klub Drugstore": "drugstore", "The Bar": "the bar", "Đorđe's Place Beograd": "dorde s place", "Ћуприја": "cuprija", "Belgrade Beograd": "beograd", "Čarobni BAR": "carobni",
        "straße": "strasse", "ﬁne ½": "fine 1 2", "Šljivić Њ": "sljivic nj", "☆": "", "": "",
    }
    assert values(spark, cases, text.strict_name) == list(cases.values())


def test_name_key_never_empty_for_symbols(spark):
    assert values(spark, ["☆  ☆", None], text.name_key) == ["☆ ☆", ""]


def test_folds_differ(spark):
    assert values(spark, ["Đurđevo"], text.strict_name) == ["durdevo"]
    assert values(spark, ["Đurđevo Ø"], text.latin_name) == ["djurdjevo o"]
    assert values(spark, ["Đurđevo"], text.city_key) == ["djurdjevo"]
    assert values(spark, ["Đak-čaj! Ћ x"], text.tokens) == [["djak", "caj", "x"]]


def test_jaccard_and_first_listed(spark):
    row = spark.range(1).select(
        text.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))).alias("j"), text.jaccard(F.array().cast("array<string>"), F.array(F.lit("b"))).alias("z"),
        text.first_listed(("q", "b", "a"), F.array(F.lit("a"), F.lit("b"))).alias("f"), text.first_listed(("q",), F.array(F.lit("a"))).alias("n"),
    ).first()
    assert (round(row.j, 6), row.z, row.f, row.n) == (round(1 / 3, 6), 0.0, "b", None)


def test_apex_domain(spark):
    cases = {
        " https://WWW.Foo.Bar.Example.com/x ": "example.com", "https://tvornica.com.hr/a": "tvornica.com.hr", "http://com.hr": "com.hr", "nonsense": None, "http://localhost/": None, None: None,
    }
    assert values(spark, cases, urls.apex_domain) == list(cases.values())
    assert values(spark, ["https://facebook.com/a", "https://a.rs"], urls.dedicated_domain) == [None, "a.rs"]
    assert values(spark, ["http://t/event/12", "http://t/e/7?x", "http://t/x/1"], urls.ticket_id) == ["12", "7", None]


def test_local_time_at_the_edges(spark):
    def at(local, zone):
        c = timeutil.local_to_instant(F.lit(local), F.lit(zone))
        return spark.range(1).select(F.date_format(c, "yyyy-MM-dd'T'HH:mm").alias("x"), timeutil.in_gap(F.lit(local), F.lit(zone)).alias("g")).first()

    assert tuple(at("2026-07-01T22:00", "Europe/Zagreb")) == ("2026-07-01T20:00", False)
    assert tuple(at("2026-10-25T02:30", "Europe/Zagreb")) == ("2026-10-25T01:30", False)
    assert tuple(at("2026-03-29T02:30", "Europe/Zagreb")) == ("2026-03-29T00:30", True)
    assert at("2026-02-30T10:00", "Europe/Zagreb").x is None
    assert at("2026-07-01", "Europe/Zagreb").x == "2026-06-30T22:00"


def test_instants_and_minutes(spark):
    z, none = F.lit("Europe/Belgrade"), F.lit(None).cast("string")
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    row = spark.range(1).select(
        show(timeutil.to_instant(F.lit("2026-07-01"), z)).alias("a"), show(timeutil.comparison_instant(F.lit("2026-07-01"), z)).alias("b"), show(timeutil.to_instant(F.lit("2026-07-01T10:00+0200"), z)).alias("c"),
        show(timeutil.to_instant(F.lit("2026-07-01T10:00:30"), none)).alias("d"), timeutil.minutes_between(F.lit("2026-07-01T23:50"), F.lit("2026-07-02T00:05")).alias("e"), timeutil.minutes_between(F.lit("2026-07-01"), F.lit("2026-07-02T00:05")).alias("f"),
        timeutil.time_of_day(F.lit("4:05:00")).alias("g"),
    ).first()
    assert tuple(row) == ("2026-07-01 00:00", "2026-06-30 22:00", "2026-07-01 08:00", "2026-07-01 10:00", 15, None, "04:05")


def test_serbian_dates(spark):
    cases = {
        "petak 30. oktobra 2026. 23.00": ("2026-10-30T23:00", "datetime"), "subota 9. maja 2026. u 10h30": ("2026-05-09T10:30", "datetime"), "30. oktobra 2026.": ("2026-10-30", "date"),
        "30. februara 2026.": None, "30. oktobra 2026. 25.00": None, "sutra": None,
    }
    assert [tuple(x) if x else None for x in values(spark, cases, timeutil.serbian_datetime)] == list(cases.values())


def test_html_helpers(spark):
    cases = {"<p>a&amp;b &#38;amp; &unknown; &nbsp;x</p>": "a&b &amp; &unknown; x", "<b>x</b><i>y</i>": "x y", None: None}
    assert values(spark, cases, html.inline_text) == list(cases.values())
    assert values(spark, ["<p>a</p><p> b  c</p><br/>d"], html.block_text) == ["a\nb c\nd"]
    page = "<meta content='x' property='og:title'><title> T - Site </title>"
    assert values(spark, [page], lambda c: html.meta_content(c, "og:title")) == ["x"]
    assert values(spark, [page], lambda c: html.page_title(c, (" - Site",))) == ["T"]


def test_distance(spark):
    d = geo.haversine(F.lit(44.8185264), F.lit(20.488357), F.lit(44.8055631), F.lit(20.4762304))
    row = spark.range(1).select(geo.whole_metres(d).alias("m"), geo.distance_label(F.lit(999.4)).alias("a"), geo.distance_label(F.lit(1250.0)).alias("b")).first()
    assert (1700 < row.m < 1760, row.a, row.b) == (True, "999 m away", "1.3 km away")
