"""Venue classification: an ordered decision list over a tag map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemark.functions.text import name_key

# Fixed values of the tag model.
LIFECYCLE = ("disused:", "abandoned:", "was:", "removed:", "razed:", "demolished:", "construction:", "proposed:")
INSTITUTIONS = {
    "amenity": ("place_of_worship", "school", "university", "hospital", "clinic", "library"),
    "healthcare": ("hospital", "clinic"),
    "office": ("government",),
}
EXCLUDED = (
    "fast_food", "food_court", "ice_cream", "bbq", "cinema", "conference_centre", "exhibition_centre", "events_centre", "casino", "gambling",
    "adult_gaming_centre", "stripclub", "swingerclub", "brothel", "love_hotel", "social_facility", "vending_machine",
)
LODGING = ("hotel", "hostel", "guest_house", "motel", "apartment", "chalet", "resort", "camp_site", "caravan_site")
CARE = ("for_the_elderly", "senior", "senior_citizens", "retirement", "refugee", "child_care")
PRIVATE = ("private", "no", "members", "permit")
NEGATIVE = ("no", "none", "never", "0", "false")
GATED = ("restaurant", "cafe", "theatre", "arts_centre", "community_centre", "social_centre", "events_venue")
STAGES = ("theatre", "arts_centre", "events_venue")
KAFANA = ("kafana", "кафана", "mehana", "meana", "механа", "birtija", "биртија", "krčma", "krcma", "крчма", "taverna", "таверна", "čarda", "carda", "чарда")
RIVER = ("splav", "сплав")
SHISHA = ("shisha", "hookah", "nargila", "nargile", "narghile", "наргил")
PERFORMANCE = ("jazz club", "blues club", "music club", "live music", "open mic", "comedy club", "stand[- ]?up", "kabare", "cabaret", "koncert", "nastup")
DRINKING = ("bar", "club", "klub", "cocktail", "koktel", "caffe")
BYPASSABLE = ("conference_centre",)
#: Word edges as ASCII knows them: a letter with a mark does not continue a word.
_EDGE = ("(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])")


def named(name: Column, words: tuple[str, ...], whole: bool = False) -> Column:
    one = "|".join(words)
    return name.rlike(f"(?i){_EDGE[0]}(?:{one}){_EDGE[1]}" if whole else f"(?iu)(?:{one})")


def tag(tags: Column, key: str) -> Column:
    """A tag's value, trimmed and lower-cased; empty where absent."""
    return F.lower(F.trim(F.coalesce(F.try_element_at(tags, F.lit(key)), F.lit(""))))


def holds(tags: Column, key: str) -> Column:
    value = tag(tags, key)
    return (value != "") & ~value.isin(*NEGATIVE)


def signal(tags: Column, amenity: Column, name: Column) -> Column:
    """struct(strength 0-3, kind): the strongest nightlife signal, the first listed of equals."""
    yes = lambda *keys: reduce(Column.__or__, [tag(tags, k) == "yes" for k in keys])
    rules = [
        (3, "music", holds(tags, "live_music") | (tag(tags, "music") == "live") | yes("music:live") | (tag(tags, "music") == "dj") | yes("dj", "karaoke")),
        (3, "performance", yes("concert", "concerts") | tag(tags, "theatre:type").isin("concert_hall", "music", "cabaret") | tag(tags, "community_centre").isin("music", "arts")),
        (3, "dance", yes("dancing", "disco")),
        (3, "brewery", yes("microbrewery") | holds(tags, "brewery") | yes("real_ale") | ((tag(tags, "craft") == "brewery") & yes("taproom"))),
        (2, "bar", yes("bar") & (amenity == "restaurant")),
        (2, "dance", yes("dancefloor")),
        (2, "music", yes("nightclub")),
        (2, "performance", yes("stage") | tag(tags, "theatre:genre").isin("comedy", "cabaret", "stand_up") | named(name, PERFORMANCE, whole=True)),
        (2, "shisha", named(name, SHISHA) & amenity.isin("cafe", "pub", "bar")),
        (1, "bar", yes("bar") & (amenity == "cafe")),
        (1, "shisha", holds(tags, "shisha") | holds(tags, "hookah") | (tag(tags, "smoking") == "shisha")),
        (1, "bar", yes("alcohol", "cocktails", "outdoor_seating") | holds(tags, "smoking")),
    ]
    found = [F.when(test, F.struct(F.lit(rank).alias("strength"), F.lit(kind).alias("kind"))) for rank, kind, test in rules]
    return F.coalesce(*found, F.struct(F.lit(0).alias("strength"), F.lit(None).cast("string").alias("kind")))


def _verdict(accepted: bool, category, via: str, review=False, rescued=False) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit(accepted).alias("accepted"), lit(category).cast("string").alias("category"), F.lit(via).alias("via"), lit(review).alias("review"), F.lit(rescued).alias("rescued"))


def classified(tags: Column, rescue: Column | None = None, bypass: Column | None = None) -> Column:
    """struct(accepted, category, via, review, rescued) of one element.

    rescue: the category of a curated rescue that applies, or null; bypass: the
    excluded amenity that a rescue pinned to this very object allows, or null.
    """
    name = F.coalesce(F.try_element_at(tags, F.lit("name")), F.lit(""))
    amenity, club, craft, leisure = (tag(tags, k) for k in ("amenity", "club", "craft", "leisure"))
    sig = signal(tags, amenity, name)
    strength, kind = sig["strength"], sig["kind"]
    no = lambda why: _verdict(False, None, why)
    lifecycle = F.exists(F.map_keys(tags), lambda k: reduce(Column.__or__, [k.startswith(p) for p in LIFECYCLE]))
    institution = reduce(Column.__or__, [tag(tags, k).isin(*v) for k, v in INSTITUTIONS.items()])
    allowed = F.lit(False) if bypass is None else F.coalesce((bypass == amenity) & amenity.isin(*BYPASSABLE), F.lit(False))
    by_kind = F.when(kind == "brewery", "pub_brewery").when(kind.isin("dance", "shisha"), "other_nightlife").when(kind.isin("performance", "music") & amenity.isin(*STAGES), "concert_hall").otherwise("nightlife_venue")
    river, gated = named(name, RIVER), amenity.isin(*GATED) | (craft == "brewery") | (club == "social")
    rules = [
        (lifecycle, no("lifecycle")),
        ((tag(tags, "disused") == "yes") | (tag(tags, "abandoned") == "yes"), no("disused")),
        (institution, no("institution")),
        (holds(tags, "shop"), no("shop")),
        (holds(tags, "office"), no("office")),
        (amenity.isin(*EXCLUDED) & ~allowed, no("excluded amenity")),
        (tag(tags, "tourism").isin(*LODGING) & (amenity == "") & (club == ""), no("lodging")),
        ((amenity == "community_centre") & tag(tags, "community_centre").isin(*CARE), no("care")),
        (tag(tags, "access").isin(*PRIVATE) & (strength < 2) & ~club.isin("music", "nightlife"), no("private")),
        (F.lit(False) if rescue is None else rescue.isNotNull(), _verdict(True, F.lit(None) if rescue is None else rescue, "rescue", True, True)),
        (amenity.isin("restaurant", "bar", "pub", "cafe") & named(name, KAFANA), _verdict(True, "kafana", "traditional name")),
        (river & amenity.isin("bar", "pub", "nightclub"), _verdict(True, F.when(amenity == "nightclub", "nightclub").otherwise("other_nightlife"), "river boat")),
        (river & (amenity == "restaurant") & ((strength >= 2) | named(name, DRINKING, whole=True)), _verdict(True, "other_nightlife", "river boat restaurant", True)),
        (river & (amenity == "restaurant"), no("river boat restaurant")),
        (amenity.isin("nightclub", "music_venue") | (club == "music"), _verdict(True, "nightclub", "automatic")),
        (amenity == "bar", _verdict(True, F.when(kind == "brewery", "pub_brewery").otherwise("bar"), "automatic")),
        (amenity.isin("pub", "biergarten"), _verdict(True, "pub_brewery", "automatic")),
        ((club == "nightlife") | (tag(tags, "karaoke") == "yes") | (amenity == "karaoke_box") | (leisure == "karaoke"), _verdict(True, "other_nightlife", "automatic")),
        ((leisure == "dance") & (tag(tags, "dance:teaching") == "yes"), no("teaching")),
        (leisure == "dance", _verdict(True, "other_nightlife", "automatic")),
        (gated & (strength == 3), _verdict(True, by_kind, "strong signal")),
        (gated & (strength == 2), _verdict(True, by_kind, "medium signal", True)),
        (gated & (strength == 1), no("weak signal")),
        (gated, no("no signal")),
    ]
    out = None
    for test, then in rules:
        test = F.coalesce(test, F.lit(False))
        out = F.when(test, then) if out is None else out.when(test, then)
    return out.otherwise(no("not in scope"))


def pushdown(tags: Column, rescued_refs: tuple[str, ...] = (), ref: Column | None = None) -> Column:
    """The source-side predicate: a superset of what classified() can accept, cheap to evaluate on a scan."""
    value = lambda k: F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit(""))
    amenity = F.lower(F.trim(value("amenity")))
    automatic = amenity.isin("nightclub", "music_venue", "bar", "pub", "biergarten", "karaoke_box") | (value("club") != "") | (value("karaoke") != "") | (value("leisure") != "")
    regional = named(value("name"), KAFANA + RIVER)
    base = amenity.isin(*GATED) | (F.lower(F.trim(value("craft"))) == "brewery")
    pinned = F.lit(False) if ref is None or not rescued_refs else ref.isin(*rescued_refs)
    return automatic | regional | base | pinned


def with_rescues(elements: DataFrame, rescues: DataFrame) -> DataFrame:
    """elements (ref, tags, country, city) with rescue_category and bypass from the curated table.

    rescues: ordinal, country, city, osm_ref or null, alias_key or null, category,
    allowed_amenity or null; an entry with osm_ref is met by that alone. The
    first entry wins. Entries with osm_ref are met by it, the others by name: two
    equi-joins, so that the table may be as large as the elements. Rows of one ref share their rescue.
    """
    e = elements.select("ref", "country", "city", name_key(F.try_element_at("tags", F.lit("name"))).alias("alias_key"))
    rescues = rescues.where("ordinal is not null")
    entry = F.struct("ordinal", "category", "allowed_amenity")
    # Of entries that are met alike the first alone can win: one a key, before any row meets it.
    pins = rescues.where("osm_ref is not null").groupBy("country", "city", F.col("osm_ref").alias("ref")).agg(F.min(entry).alias("pin"))
    names = rescues.where("osm_ref is null").groupBy("country", "city", "alias_key").agg(F.min(entry).alias("name"))
    met = e.join(pins, ["country", "city", "ref"], "left").join(names, ["country", "city", "alias_key"], "left")
    first = met.where("pin is not null or name is not null").groupBy("ref").agg(
        F.min(F.least("pin", "name"))["category"].alias("rescue_category"), F.min("pin")["allowed_amenity"].alias("bypass")
    )
    return elements.join(first, "ref", "left")
