"""Sitemaps: entries, event page references, newest first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The XML entities, the ampersand last so that nothing is decoded twice.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#0*39;|&apos;", "'"), ("&amp;", "&"))


def entries(xml: DataFrame, body: str = "body") -> DataFrame:
    """(url, lastmod) of every url and sitemap element of the documents."""
    blocks = F.explode(F.regexp_extract_all(body, F.lit("(?is)<(?:url|sitemap)>(.*?)</(?:url|sitemap)>"), 1)).alias("block")
    inner = lambda t: F.nullif(F.regexp_extract("block", f"(?i)<{t}>\\s*([^<\\s]+)\\s*</{t}>", 1), F.lit(""))
    url = reduce(lambda c, e: F.regexp_replace(c, *e), ENTITIES, inner("loc"))
    return xml.select(blocks).select(url.alias("url"), inner("lastmod").alias("lastmod")).where("url is not null")


def is_event_sitemap(url: Column) -> Column:
    return url.rlike("(?i)/event-sitemap\\d*\\.xml$")


def is_event_page(url: Column) -> Column:
    return url.rlike("(?i)/event/[^/?#]+/?(?:[?#]|$)")


def event_slug(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, "(?i)/event/([^/?#]+)", 1), F.lit(""))


def latest(rows: DataFrame, limit: int = 0) -> DataFrame:
    """(url, lastmod): each URL once with its newest date, newest first, then by URL; limit 0 means all."""
    once = rows.groupBy("url").agg(F.max("lastmod").alias("lastmod")).orderBy(F.col("lastmod").desc_nulls_last(), "url")
    return once.limit(limit) if limit else once


def event_refs(rows: DataFrame, limit: int = 0) -> DataFrame:
    return latest(rows.where(is_event_page(F.col("url"))), limit).withColumn("ref", event_slug(F.col("url")))
