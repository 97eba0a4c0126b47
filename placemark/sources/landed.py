"""Adapters over landing zones: references, raw responses and records of a source, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placemark.sources import elements, pages, sitemap
from placemark.sources.adapter import Capabilities, target_failures
from placemark.sources.tables import ELEMENT

_RESPONSE = f"remark string, elements array<struct<{ELEMENT}>>"


@dataclass(frozen=True)
class LandedElements:
    """Responses of a map source in folder/country=.../city=.../*.json; a city is a reference.

    The targets of refs() choose the folders that raw() reads; a filter on country or city
    of either reaches the scan as a partition filter.
    """

    spark: SparkSession
    folder: str
    key: str
    rescues: DataFrame | None = None
    capabilities: Capabilities = Capabilities(("venue",), snapshot=True)

    def _files(self) -> DataFrame:
        return self.spark.read.option("wholetext", True).schema("value string, country string, city string").text(self.folder)

    def refs(self) -> DataFrame:
        """country, city and ref of every landed target; no response is read for it."""
        return self._files().select("country", "city").distinct().withColumn("ref", F.concat_ws("/", "country", "city"))

    def raw(self, refs: DataFrame) -> DataFrame:
        """ref, country, city, ok, body of each landed response of the references."""
        asked = refs.select("country", "city", "ref")
        found = self._files().withColumnRenamed("value", "body").join(asked, ["country", "city"])
        parsed = F.from_json("body", _RESPONSE, {"mode": "PERMISSIVE"})
        ok = parsed["elements"].isNotNull() & (F.trim(F.coalesce(parsed["remark"], F.lit(""))) == "")
        return found.select("ref", "country", "city", F.coalesce(ok, F.lit(False)).alias("ok"), "body")

    def found(self, raw: DataFrame) -> DataFrame:
        """Every element of the readable responses with its bucket, ref of its target as `target`."""
        each = raw.where("ok").select(F.col("ref").alias("target"), "country", "city", F.posexplode(F.from_json("body", _RESPONSE)["elements"]).alias("position", "e"))
        return elements.venues(each.select("target", "country", "city", "position", "e.*"), F.col("country"), F.col("city"), self.rescues, "target")

    def records(self, raw: DataFrame) -> DataFrame:
        return elements.records(self.found(raw), self.key)

    def failures(self, refs: DataFrame, raw: DataFrame) -> DataFrame:
        """(ref, code) of the targets that gave nothing."""
        bucket = F.count_if(F.col("bucket") == "venue")
        counts = self.found(raw).groupBy(F.col("target").alias("ref")).agg(F.count("*").alias("fetched"), bucket.alias("kept"))
        return target_failures(refs, counts, raw.where("not ok"))


@dataclass(frozen=True)
class LandedPages:
    """Event pages of a site: landed sitemaps (body) name them, landed responses (url, ok, html) hold them."""

    sitemaps: DataFrame
    responses: DataFrame
    key: str
    zone: str
    suffixes: tuple[str, ...] = ()
    capabilities: Capabilities = Capabilities(("event",), snapshot=False, linked_venues=True)

    def refs(self, limit: int = 0) -> DataFrame:
        return sitemap.event_refs(sitemap.entries(self.sitemaps), limit)

    def raw(self, refs: DataFrame) -> DataFrame:
        """ref, url, ok, html; a reference that was never landed is a failed one."""
        return refs.select("ref", "url").join(self.responses.select("url", "ok", "html"), "url", "left").select("ref", "url", F.coalesce("ok", F.lit(False)).alias("ok"), "html")

    def records(self, raw: DataFrame) -> DataFrame:
        return pages.event_records(pages.events(raw.where("ok"), self.suffixes), self.key, self.zone)


def variant_text(reported: Column, path: str) -> Column:
    """What a source reported at a path, as text; null where it is not there."""
    return F.try_variant_get(reported, path, "string")
