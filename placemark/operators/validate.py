"""Record validation: the first failing rule names the outcome."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemark.functions.geo import physical, within
from placemark.functions.timeutil import absolute, has_offset, in_gap, local_to_instant, wall_clock

# Names that name no venue (compared case-insensitively, whole).
PLACEHOLDERS = (
    "unknown|n/?a|none|null|tbd|tba|tbc",
    "to be (?:announced|confirmed|determined)",
    "location (?:tba|tbd|tbc|unknown|to be announced)",
    "various(?: locations?)?|multiple locations?|different venues?",
    "online(?: event)?|virtual(?: event)?|live ?stream(?:ing)?|webinar|zoom|youtube|twitch",
    "[\\s\\p{P}\\p{M}\\p{Cc}\\p{Cs}$+<=>^`|~]+",
)


def placeholder(name: Column, extra: tuple[str, ...] = ()) -> Column:
    shown = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), "\\p{Cf}", ""))
    return (shown == "") | shown.rlike("(?iU)^(?:" + "|".join([*PLACEHOLDERS, *extra]) + ")$")


def first_of(rules: list[tuple[Column, str, str]]) -> Column:
    """struct(outcome, code) of the first rule (test, outcome, code) that holds; ok if none does."""
    out = F
    for test, outcome, code in rules:
        out = out.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(outcome).alias("outcome"), F.lit(code).alias("code")))
    return out.otherwise(F.struct(F.lit("ok").alias("outcome"), F.lit(None).cast("string").alias("code")))


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def venue_validation(external_id: Column, name: Column, normalized: Column, lat: Column, lon: Column, box: tuple[Column, Column, Column, Column], city: Column, city_enabled: Column, extra: tuple[str, ...] = ()) -> Column:
    placed = lat.isNotNull() & lon.isNotNull()
    return first_of([
        (F.coalesce(external_id, F.lit("")) == "", "rejected", "missing-external-id"),
        (blank(name), "rejected", "missing-name"),
        (F.length(F.trim(name)) < 2, "rejected", "name-too-short"),
        (blank(normalized), "rejected", "empty-normalized-name"),
        (placeholder(name, extra), "rejected", "placeholder-venue-name"),
        (placed & ~physical(lat, lon), "rejected", "invalid-coordinates"),
        (placed & ~within(lat, lon, *box), "needs_review", "coordinates-out-of-region"),
        (city.isNotNull() & ~city_enabled, "needs_review", "city-disabled"),
        (city.isNull(), "needs_review", "city-unresolved"),
    ])


def event_instants(start: Column, end: Column, zone: Column, known_zones: tuple[str, ...]) -> Column:
    """struct(code, start_at, end_at): code is null where the times are sound; a local time without a zone has no instant."""
    wrong_zone = zone.isNotNull() & ~zone.isin(*known_zones)
    usable = F.when(zone.isin(*known_zones), zone).otherwise("UTC")

    def parsed(c: Column) -> tuple[Column, Column, Column]:
        t = F.trim(c)
        wall = wall_clock(t)
        readable = F.when(has_offset(t), absolute(t).isNotNull()).otherwise(t.rlike("^\\d{4}-\\d{2}-\\d{2}(?:[T ]\\d{1,2}:\\d{2}(?::\\d{2})?)?$") & wall.isNotNull())
        gap = ~has_offset(t) & zone.isNotNull() & in_gap(t, usable)
        at = F.when(has_offset(t), absolute(t)).when(zone.isNotNull(), local_to_instant(t, usable))
        return F.coalesce(readable, F.lit(False)), F.coalesce(gap, F.lit(False)), at

    start_ok, start_gap, start_at = parsed(start)
    end_ok, end_gap, end_at = parsed(end)
    given = ~blank(end)
    dated = lambda c: ~F.trim(c).rlike("\\d{1,2}:\\d{2}")
    local = ~has_offset(F.trim(start)) & ~has_offset(F.trim(end))
    days = F.substring(F.trim(end), 1, 10) < F.substring(F.trim(start), 1, 10)
    before = F.when(local & (dated(start) | dated(end)), days).when(start_at.isNotNull() & end_at.isNotNull(), end_at < start_at).when(local, wall_clock(F.trim(end)) < wall_clock(F.trim(start)))
    code = (
        F.when(wrong_zone, "invalid-time-zone")
        .when(~start_ok, "invalid-start")
        .when(given & ~end_ok, "invalid-end")
        .when(start_gap, "invalid-start")
        .when(given & end_gap, "invalid-end")
        .when(given & before, "end-before-start")
    )
    return F.struct(code.alias("code"), start_at.alias("start_at"), F.when(given, end_at).alias("end_at"))


def event_contract(source: Column, external_id: Column, title: Column, start: Column, times: Column, venue_name: Column, source_venue_id: Column) -> Column:
    """The code of the first broken rule, or null. times: event_instants()."""
    return (
        F.when(blank(source), "missing-source")
        .when(blank(external_id), "missing-external-id")
        .when(blank(title), "missing-title")
        .when(blank(start), "missing-start")
        .when(times["code"].isNotNull(), times["code"])
        .when(blank(venue_name) & blank(source_venue_id), "missing-venue-identity")
    )


def event_validation(contract: Column, venue_name: Column, lat: Column, lon: Column, city: Column, city_enabled: Column) -> Column:
    broken = F.when(contract.isNotNull(), F.struct(F.lit("rejected").alias("outcome"), contract.alias("code")))
    return F.coalesce(broken, first_of([
        (blank(venue_name), "needs_review", "event-no-venue-named"),
        (placeholder(venue_name), "rejected", "placeholder-venue-name"),
        (lat.isNotNull() & lon.isNotNull() & ~physical(lat, lon), "rejected", "invalid-coordinates"),
        (city.isNotNull() & ~city_enabled, "needs_review", "city-disabled"),
        (city.isNull(), "needs_review", "city-unresolved"),
    ]))
