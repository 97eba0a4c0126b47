"""Configured countries and cities: load-time checks, scopes and city resolution."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.functions.text import city_key


@dataclass(frozen=True)
class Thresholds:
    stale: int = 1
    missing: int = 2
    gone: int = 3
    parse_failure: float = 0.3
    least_seen: float = 0.4


@dataclass(frozen=True)
class City:
    country: str
    name: str
    aliases: tuple[str, ...] = ()
    enabled: bool = True
    time_zone: str | None = None


@dataclass(frozen=True)
class SyncConfig:
    cities: tuple[City, ...]
    thresholds: Thresholds = field(default_factory=Thresholds)
    placeholder_patterns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        t = self.thresholds
        if not 0 < t.stale <= t.missing <= t.gone:
            raise ValueError("thresholds must ascend")
        for p in self.placeholder_patterns:
            re.compile(p)
        seen = set()
        for c in self.cities:
            key = (c.country.upper(), c.name.strip().lower())
            if not key[1] or key in seen:
                raise ValueError(f"city name is empty or repeated: {c.country} {c.name!r}")
            seen.add(key)


def in_scope(cities: DataFrame, countries: tuple[str, ...] = (), names: tuple[str, ...] = ()) -> DataFrame:
    """Enabled cities of the named countries and names; an empty choice means all."""
    out = cities.where("enabled")
    if countries:
        out = out.where(F.upper("country").isin(*[c.upper() for c in countries]))
    if names:
        out = out.where(city_key(F.col("city")).isin(*[city_key(F.lit(n)) for n in names]))
    return out


def resolve_city(rows: DataFrame, cities: DataFrame) -> DataFrame:
    """rows (row_id, country or null, city_text) -> (row_id, city_id).

    cities: city_id, country, city, aliases. A stated country must hold the name;
    without one the name must belong to exactly one city.
    """
    names = cities.select("city_id", F.upper("country").alias("country"), F.explode(F.concat(F.array("city"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("n"))
    names = names.select("city_id", "country", city_key(F.col("n")).alias("key")).where("key <> ''").distinct()
    asked = rows.withColumn("key", city_key(F.col("city_text"))).withColumn("country", F.upper("country"))
    within = names.groupBy("country", "key").agg(F.min("city_id").alias("city_id"))
    anywhere = names.groupBy("key").agg(F.count_distinct("city_id").alias("n"), F.min("city_id").alias("only")).where("n = 1")
    stated = asked.where("country is not null").join(within, ["country", "key"], "left").select("row_id", "city_id")
    open_ = asked.where("country is null").join(anywhere, "key", "left").select("row_id", F.col("only").alias("city_id"))
    return stated.union(open_)
