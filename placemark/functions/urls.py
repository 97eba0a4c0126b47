"""URL parts that identity rests on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Domains that host many unrelated venues, and public suffixes of two labels.
PLATFORM_HOSTS = (
    "facebook.com", "fb.com", "fb.me", "instagram.com", "instagr.am", "twitter.com", "x.com", "tiktok.com", "youtube.com", "youtu.be",
    "linktr.ee", "linktree.com", "google.com", "goo.gl", "bit.ly", "blogspot.com", "t.me", "telegram.me", "linkedin.com", "wixsite.com", "wordpress.com",
)
COMPOUND_SUFFIXES = ("com.hr", "com.rs", "co.rs", "org.rs", "edu.rs", "in.rs")


def apex_domain(url: Column) -> Column:
    """The registrable domain, lower-cased; null where the URL has no host of two labels or more.

    Hosts outside ASCII give null: Spark does not parse them.
    """
    host = F.regexp_replace(F.lower(F.try_parse_url(F.trim(url), F.lit("HOST"))), "^www\\.", "")
    labels = F.filter(F.split(host, "\\."), lambda x: x != "")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    return F.when(F.size(labels) < 2, None).when((F.size(labels) >= 3) & two.isin(*COMPOUND_SUFFIXES), F.array_join(F.slice(labels, -3, 3), ".")).otherwise(two)


def dedicated_domain(url: Column) -> Column:
    apex = apex_domain(url)
    return F.when(~apex.isin(*PLATFORM_HOSTS), apex)


def ticket_id(url: Column) -> Column:
    m = "/(?:sectionGroup/index|event|e)/(\\d+)"
    return F.when(url.rlike(m), F.regexp_extract(url, m, 1))
