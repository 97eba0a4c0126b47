"""Event and venue pages: html -> one struct; failures are values.

Regular expressions over one page at a time in Arrow batches; the few steps
that Spark has built-ins for (dates, names) are applied to the columns after.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemark.functions.html import decode
from placemark.functions.timeutil import serbian_datetime

# Class names and labels of the detail box, by which its rows are told.
BOX, TITLE, INNER = "gt-detail-box", "gt-title", "gt-inner"
ROWS = {"start": ("gt-start-date", "datum"), "end": ("gt-end-date", "traje do"), "venue": ("gt-venue", "lokacija"), "city": ("gt-locations", "mesto"), "promoter": (None, "organizator"), "type": (None, "vrsta doga")}
NOT_FOUND = ("stranica nije pron", "page not found")
POSTPONED_CATEGORY = "odlozeno-otkazano"
BOX_CHARS = 8000

_NOISE = re.compile(r"<script.*?</script>|<style.*?</style>|<svg.*?</svg>|<!--.*?-->", re.I | re.S)
_CANCELLED = re.compile(r"(?<!\w)otkazan|(?<!\w)otkaz[au]|отказан")
_POSTPONED = re.compile(r"(?<!\w)odlo[žz]|odgo[đd]|одлож|pomeren|novi datum|нови датум")
EVENT = (
    "ok boolean, code string, external_id string, title string, start_text string, end_text string, venue string, venue_slug string, city string, city_slug string, "
    "promoter string, event_type string, categories array<string>, ticket_url string, image string, description string, status string"
)
VENUE = "ok boolean, code string, external_id string, name string, address string, city string, lat double, lon double"


def _one(pattern: str, text: str, flags: int = re.I | re.S) -> str | None:
    m = re.search(pattern, text, flags)
    return m[1] if m else None


def _line(fragment: str | None) -> str:
    return " ".join(decode(re.sub(r"<[^>]*>", " ", fragment or "")).split())


def _meta(page: str, name: str) -> str | None:
    for tag in re.findall(r"<meta\b[^>]*>", page, re.I):
        attrs = {k.lower(): v for k, _, v in re.findall(r"([\w:-]+)\s*=\s*([\"'])(.*?)\2", tag, re.S)}
        if name in (attrs.get("property"), attrs.get("name")) and "content" in attrs:
            return decode(attrs["content"])
    return None


def _title(page: str, suffixes: tuple[str, ...]) -> str:
    title = decode(_one(r"<title[^>]*>(.*?)</title>", page) or _meta(page, "og:title") or "").strip()
    for s in suffixes:
        if title.lower().endswith(s.lower()):
            return title[: -len(s)].strip()
    return title


def _details(page: str) -> list[tuple[set[str], str, str]]:
    """(classes, label, inner html) of the rows of the detail box; a row ends where the next begins."""
    box = re.search(rf"<div[^>]*class=[\"'][^\"']*{BOX}", page, re.I)
    if not box:
        return []
    scope = page[box.start() : box.start() + BOX_CHARS]
    out = []
    for piece in re.split(r"(?=<li[^>]*class=[\"']gt-)", scope, flags=re.I)[1:]:
        div = lambda cls: _one(rf"<div[^>]*class=[\"'][^\"']*{cls}[^\"']*[\"'][^>]*>(?:\s*<div[^>]*>\s*</div>)*(.*?)</div>", piece)  # noqa: B023, E731
        label, inner = div(TITLE), div(INNER)
        if label is not None or inner is not None:
            out.append((set((_one(r"class=[\"']([^\"']*)", piece) or "").split()), _line(label).lower(), inner or ""))
    return out


def _row(rows: list, which: str) -> str | None:
    cls, label = ROWS[which]
    by_class = next((r[2] for r in rows if cls and cls in r[0]), None)
    return by_class if by_class is not None else next((r[2] for r in rows if r[1].startswith(label)), None)


def _anchor(inner: str | None) -> str:
    return _line(_one(r"<a[^>]*>(.*?)</a>", inner or "") or inner)


def _about(page: str) -> str | None:
    """The text of the section about the event, a line a block; None without one."""
    head = re.search(r"<div[^>]*gt-section-title[^>]*>\s*O\s*doga[^<]*</div>\s*<div[^>]*gt-content[^>]*>", page, re.I)
    if not head:
        return None
    rest = page[head.end() :]
    # It ends where the next section does: at its heading, at another box, or where its own boxes close.
    stop = re.search(r"<div[^>]*class=[\"'][^\"']*(?:gt-section(?:-title)?[\"']|gt-event-)|</div>\s*</div>\s*</div>", rest, re.I)
    if not stop:
        return None
    broken = re.sub(r"<br\s*/?>|</(?:p|div|li|ul|ol|h[1-6]|tr)\s*>", "\n", rest[: stop.start()], flags=re.I)
    lines = (" ".join(x.split()) for x in decode(re.sub(r"<[^>]*>", " ", broken)).split("\n"))
    return "\n".join(x for x in lines if x) or None


def parse_event(page: str | None, url: str | None, suffixes: tuple[str, ...] = ()) -> dict:
    """The fields of EVENT; dates are left as text for serbian_datetime()."""
    clean, url = _NOISE.sub(" ", page or ""), url or ""
    fail = lambda code: {"ok": False, "code": code}
    title = _title(clean, suffixes)
    if not title:
        return fail("missing-title")
    if any(m in title.lower() for m in NOT_FOUND):
        return fail("not-found-page")
    body = _one(r"<body[^>]*class=[\"']([^\"']*)", clean) or ""
    soup = body + " " + (_one(r"class=[\"']([^\"']*\bgt-page-content\b[^\"']*)", clean) or "")
    number = _one(r"\bpostid-(\d+)\b", body) or _one(r"wp-json/wp/v2/event/(\d+)", clean) or _one(r"[?&]p=(\d+)\b", clean) or _one(r"/event/([^/?#\"']+)", url)
    if not number:
        return fail("missing-external-id")
    rows = _details(clean)
    if not rows:
        return fail("missing-details")
    venue, city = _row(rows, "venue"), _row(rows, "city")
    slug = lambda inner, kind: _one(rf"/{kind}/([a-z0-9-]+)/", inner or "")
    categories = list(dict.fromkeys(re.findall(r"\beventcat-([a-z0-9-]+)\b", soup) + re.findall(r"/eventcat/([a-z0-9-]+)/", clean)))
    mark = "cancelled" if _CANCELLED.search(title.lower()) else "postponed" if _POSTPONED.search(title.lower()) or POSTPONED_CATEGORY in categories else None
    promoter = _line(_row(rows, "promoter"))
    return {
        "ok": True, "code": None, "external_id": number, "title": title, "start_text": _line(_row(rows, "start")), "end_text": _line(_row(rows, "end")),
        "venue": _anchor(venue), "venue_slug": slug(venue, "venue"), "city": _anchor(city), "city_slug": slug(city, "location") or _one(r"\blocation-([a-z0-9-]+)\b", soup),
        "promoter": re.split(r",|\s{2,}| MB \d| PIB \d", promoter)[0].strip() or None, "event_type": _line(_row(rows, "type")) or None, "categories": categories,
        "ticket_url": _one(r"href=[\"'](https?://[^\"']*/sectionGroup/index/\d+[^\"']*)", clean), "image": _meta(clean, "og:image"), "description": _about(clean) or _meta(clean, "og:description"), "status": mark,
    }


def parse_venue(page: str | None, url: str | None, suffixes: tuple[str, ...] = ()) -> dict:
    clean, url = _NOISE.sub(" ", page or ""), url or ""
    fail = lambda code: {"ok": False, "code": code}
    name = _title(clean, suffixes)
    if not name:
        return fail("missing-name")
    if any(m in name.lower() for m in NOT_FOUND):
        return fail("not-found-page")
    body = _one(r"<body[^>]*class=[\"']([^\"']*)", clean) or ""
    if not re.search(r"\b(?:single-venue|venue-template|type-venue)\b", body, re.I):
        return fail("not-a-venue-page")
    number = _one(r"\bpostid-(\d+)\b", body) or _one(r"[?&]p=(\d+)\b", clean) or _one(r"/venue/([^/?#\"']+)", url)
    if not number:
        return fail("missing-external-id")
    detail = lambda label: _line(_one(rf"<div[^>]*class=[\"'][^\"']*{TITLE}[^\"']*[\"'][^>]*>\s*{label}[^<]*</div>\s*<div[^>]*class=[\"'][^\"']*{INNER}[^\"']*[\"'][^>]*>(?:\s*<div[^>]*>\s*</div>)*(.*?)</div>", clean)) or None

    def coordinate(axis: str, most: float) -> float | None:
        try:
            v = float(_one(rf"data-{axis}=[\"']([-0-9.]+)[\"']", clean) or "x")
        except ValueError:
            return None
        return v if -most <= v <= most else None

    lat, lon = coordinate("lat", 90), coordinate("lng", 180)
    if lat == 0 and lon == 0:
        lat = lon = None
    city = detail("Mesto") or (_meta(clean, "og:description") or "").split(",")[0].strip() or None
    return {"ok": True, "code": None, "external_id": number, "name": name, "address": detail("Adresa"), "city": city, "lat": lat, "lon": lon}


def _udf(parse, kind: str, suffixes: tuple[str, ...]):
    names = [f.split()[0] for f in kind.replace("array<string>", "x").split(", ")]

    @F.pandas_udf(kind)
    def run(page: pd.Series, url: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(p, u, suffixes) for p, u in zip(page, url, strict=True)], columns=names).astype(object).where(lambda d: d.notna(), None)

    return run


def events(pages: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """url, ok, code and the event fields with start_local, start_precision and end_local."""
    e = pages.select("url", _udf(parse_event, EVENT, suffixes)(F.col("html"), F.col("url")).alias("e")).select("url", "e.*")
    start, end = serbian_datetime(F.col("start_text")), serbian_datetime(F.col("end_text"))
    code = F.when(~F.col("ok"), F.col("code")).when(start.isNull(), "unparseable-date").when((F.coalesce("venue", F.lit("")) == "") & (F.coalesce("city", F.lit("")) == ""), "missing-location")
    return e.withColumns({"start_local": start["local"], "start_precision": start["precision"], "end_local": end["local"], "code": code}).withColumn("ok", F.col("code").isNull())


def venue_pages(pages: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    return pages.select("url", _udf(parse_venue, VENUE, suffixes)(F.col("html"), F.col("url")).alias("v")).select("url", "v.*")


def reported(parsed: DataFrame) -> Column:
    """What the page itself says, untouched by any rule, as one variant: a source may say more than the model has columns for."""
    said = F.struct(
        F.struct(F.col("venue").alias("name"), F.col("venue_slug").alias("slug"), F.col("city").alias("city"), F.col("city_slug").alias("citySlug")).alias("venue"),
        F.struct(F.col("start_text").alias("start"), F.col("end_text").alias("end")).alias("dates"), F.col("event_type").alias("type"), F.col("categories").alias("categories"), F.col("image").alias("image"),
    )
    return F.parse_json(F.to_json(said))


def event_records(parsed: DataFrame, source: str, zone: str) -> DataFrame:
    """Parsed pages as sync records; without a mark an event is scheduled."""
    return parsed.where("ok").select(
        F.lit(source).alias("source"), "external_id", F.lit("event").alias("kind"), "title", "start_local", "end_local", F.lit(zone).alias("time_zone"),
        F.coalesce("status", F.lit("scheduled")).alias("status"), F.col("venue").alias("venue_name"), F.col("city").alias("city_text"), "promoter", "ticket_url",
        reported(parsed).alias("reported"),
    )


def links(page: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(page, F.lit("(?i)<a[^>]+href=[\"']([^\"'#]+)"), 1))
