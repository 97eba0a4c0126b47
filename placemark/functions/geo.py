"""Distances and bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean radius of the Earth in metres.
RADIUS = 6_371_000


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def whole_metres(distance: Column) -> Column:
    return F.floor(distance + 0.5).cast("long")


def distance_label(metres: Column) -> Column:
    km = F.floor(metres / 100 + 0.5).cast("long")
    return F.when(metres < 1000, F.concat(whole_metres(metres).cast("string"), F.lit(" m away"))).otherwise(
        F.concat((km / 10).cast("decimal(12,1)").cast("string"), F.lit(" km away"))
    )


def physical(lat: Column, lon: Column) -> Column:
    fine = lambda c, most: ~F.isnan(c) & c.between(-most, most)
    return F.coalesce(fine(lat, 90) & fine(lon, 180), F.lit(False))


def within(lat: Column, lon: Column, min_lat: Column, max_lat: Column, min_lon: Column, max_lon: Column) -> Column:
    """Inside the box; true where a point or a box is missing."""
    return F.coalesce(lat.between(min_lat, max_lat) & lon.between(min_lon, max_lon), F.lit(True))
