"""Regex-level HTML helpers; only entity decoding needs Python, in Arrow batches."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from placemark.functions.text import collapsed

# The named entities that are decoded, all others stay.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "laquo": "«", "raquo": "»", "hellip": "…",
    "ndash": "–", "mdash": "—", "rsquo": "’", "lsquo": "‘", "ldquo": "“", "rdquo": "”",
}
_ENTITY = re.compile(r"&(?:#x([0-9a-fA-F]+)|#(\d+)|([a-zA-Z][a-zA-Z0-9]+));")


def decode(text: str) -> str:
    """One pass over named and numeric entities; what a pass puts in is not decoded again."""

    def char(m: re.Match) -> str:
        if m[3]:
            return ENTITIES.get(m[3], m[0])
        code = int(m[1], 16) if m[1] else int(m[2])
        return chr(code) if code <= 0x10FFFF and not 0xD800 <= code < 0xE000 else ""

    return _ENTITY.sub(char, text)


@F.pandas_udf(StringType())
def decode_entities(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else decode(t) if "&" in t else t)


def strip_noise(page: Column) -> Column:
    return F.regexp_replace(page, "(?is)<script.*?</script>|<style.*?</style>|<svg.*?</svg>|<!--.*?-->", " ")


def strip_tags(page: Column) -> Column:
    return F.regexp_replace(page, "<[^>]*>", " ")


def inline_text(page: Column) -> Column:
    return collapsed(decode_entities(strip_tags(page)))


def block_text(page: Column) -> Column:
    """Text with a line a block; lines are tidied and blank ones dropped."""
    broken = F.regexp_replace(page, "(?i)<\\s*br\\s*/?\\s*>|<\\s*/\\s*(?:p|div|li|h[1-6]|section|article|tr)\\s*>", "\n")
    lines = F.split(decode_entities(F.regexp_replace(broken, "<[^>]*>", "")), "\n")
    return F.array_join(F.filter(F.transform(lines, collapsed), lambda x: x != ""), "\n")


def meta_content(page: Column, name: str) -> Column:
    """The content of a meta tag, its attributes in either order; null where there is none."""
    quoted, key = "[\"']", re.escape(name)
    forms = (f"(?i)<meta[^>]+(?:property|name)={quoted}{key}{quoted}[^>]*content={quoted}([^\"']*){quoted}", f"(?i)<meta[^>]+content={quoted}([^\"']*){quoted}[^>]*(?:property|name)={quoted}{key}{quoted}")
    return F.coalesce(*(F.when(page.rlike(f), F.regexp_extract(page, f, 1)) for f in forms))


def page_title(page: Column, site_suffixes: tuple[str, ...] = ()) -> Column:
    """The title without a known site suffix; the first that fits goes."""
    title = F.trim(F.regexp_extract(page, "(?is)<title[^>]*>(.*?)</title>", 1))
    if not site_suffixes:
        return title
    one = "|".join(re.escape(s) for s in site_suffixes)
    return F.trim(F.regexp_replace(title, f"(?iu)(?:{one})$", ""))
