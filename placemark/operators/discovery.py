"""The read path: active venues of a city by genre and distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_venues(venues: DataFrame, cities: DataFrame, genres: DataFrame) -> DataFrame:
    """venue_id, name, country, city, closes, genres, lat, lon of active venues.

    venues: venue_id, name, city_id, is_active, closing_time, lat, lon; cities: city_id,
    city, country; genres: venue_id, genre. The filter reaches the scan.
    """
    own = genres.groupBy("venue_id").agg(F.array_sort(F.collect_set("genre")).alias("genres"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    return venues.where("is_active").join(cities, "city_id", "left").join(own, "venue_id", "left").select(
        "venue_id", "name", blank("country").alias("country"), blank("city").alias("city"), blank(F.substring("closing_time", 1, 5)).alias("closes"),
        F.coalesce("genres", F.array().cast("array<string>")).alias("genres"), "lat", "lon",
    )


def search(found: DataFrame, country: str, city: str, genres: list[str]) -> DataFrame:
    """All three choices are needed; any of the genres will do."""
    if not (country and city and genres):
        return found.limit(0)
    return found.where((F.col("country") == country) & (F.col("city") == city) & F.arrays_overlap("genres", F.array(*map(F.lit, genres))))


def by_distance(found: DataFrame, metres: Column) -> DataFrame:
    """Nearest first, unknown last, then by name and id."""
    return found.withColumn("metres", metres).orderBy(F.col("metres").asc_nulls_last(), "name", "venue_id")


def with_road_distance(found: DataFrame, distances: DataFrame) -> DataFrame:
    """Metres by road from a one-to-many table (venue_id, metres); unroutable venues have none."""
    return found.join(distances.where("metres is not null").select("venue_id", "metres"), "venue_id", "left")


def containing(col: Column, typed: str) -> Column:
    return F.lower(col).contains(typed.lower())
