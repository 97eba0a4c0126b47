"""The registry itself, and SQL fragments that oracles share."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_LAT, _LON = "(44.7 + (c_custkey % 200) * 0.001)", "(20.3 + (c_custkey % 300) * 0.001)"


def _metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"(2 * 6371000 * asin(least(1.0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"


def _whole(m: str) -> str:
    return f"CAST(floor({m} + 0.5) AS BIGINT)"


# One choice of tags for each of 24 kinds of events rows, by event id.
TAGS = [
    {"amenity": "bar"}, {"amenity": "pub", "microbrewery": "yes"}, {"amenity": "restaurant"}, {"amenity": "restaurant", "live_music": "yes"}, {"amenity": "restaurant", "bar": "yes"},
    {"amenity": "cafe", "bar": "yes"}, {"amenity": "nightclub"}, {"amenity": "bar", "disused": "yes"}, {"disused:amenity": "bar"}, {"amenity": "school", "live_music": "yes"},
    {"amenity": "restaurant", "name": "Kafana Stara"}, {"amenity": "restaurant", "name": "Splav Reka"}, {"amenity": "restaurant", "name": "Splav Club"}, {"amenity": "theatre", "theatre:type": "cabaret"},
    {"amenity": "theatre"}, {"leisure": "dance", "dance:teaching": "yes"}, {"leisure": "dance"}, {"club": "social", "stage": "yes"}, {"amenity": "bar", "access": "private"},
    {"amenity": "fast_food"}, {"amenity": "bar", "shop": "no"}, {"shop": "books"}, {"tourism": "hotel"}, {"craft": "brewery", "taproom": "yes"},
]
TAG_RESULT = [
    "bar", "pub_brewery", "-no signal", "nightlife_venue", "nightlife_venue?", "-weak signal", "nightclub", "-disused", "-lifecycle", "-institution", "kafana", "-river boat restaurant", "other_nightlife?",
    "concert_hall", "-no signal", "-teaching", "other_nightlife", "nightlife_venue?", "-private", "-excluded amenity", "bar", "-shop", "-lodging", "pub_brewery",
]
