"""Local wall-clock strings, zones and instants (session time zone UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemark.functions.text import once

_WALL = "^(\\d{4})-(\\d{2})-(\\d{2})(?:[T ](\\d{1,2}):(\\d{2})(?::(\\d{2}))?)?"
# Serbian month names, genitive before nominative.
MONTHS = {
    "januara": 1, "februara": 2, "marta": 3, "aprila": 4, "maja": 5, "juna": 6, "jula": 7, "avgusta": 8, "septembra": 9, "oktobra": 10, "novembra": 11, "decembra": 12,
    "januar": 1, "februar": 2, "mart": 3, "april": 4, "maj": 5, "jun": 6, "juni": 6, "jul": 7, "juli": 7, "avgust": 8, "septembar": 9, "oktobar": 10, "novembar": 11, "decembar": 12,
}


def wall_clock(local: Column, seconds: bool = False) -> Column:
    """The timestamp a wall-clock string spells; null where it spells none or an impossible one."""
    part = lambda k: F.regexp_extract(local, _WALL, k)
    or_zero = lambda k: F.when(part(k) == "", F.lit("00")).otherwise(F.lpad(part(k), 2, "0"))
    spelt = F.concat(part(1), F.lit("-"), part(2), F.lit("-"), part(3), F.lit(" "), or_zero(4), F.lit(":"), or_zero(5), F.lit(":"), or_zero(6) if seconds else F.lit("00"))
    return F.when(local.rlike(_WALL), F.try_to_timestamp(spelt, F.lit("yyyy-MM-dd HH:mm:ss")))


def local_to_instant(local: Column, zone: Column) -> Column:
    """The instant of a wall-clock string in an IANA zone: three steps towards the fixed point
    wall = guess + offset(guess), which settles gaps and overlaps the same way everywhere.
    The zone must be known; check it first."""

    def towards(wall: Column, guess: Column, steps: int) -> Column:
        if not steps:
            return F.timestamp_seconds(guess)
        offset = F.from_utc_timestamp(F.timestamp_seconds(guess), zone).cast("long") - guess
        return once(wall - offset, lambda g: towards(wall, g, steps - 1))

    return once(wall_clock(local).cast("long"), lambda wall: towards(wall, wall, 3))


def instant_to_local(instant: Column, zone: Column) -> Column:
    return F.date_format(F.from_utc_timestamp(instant, zone), "yyyy-MM-dd'T'HH:mm")


def has_offset(local: Column) -> Column:
    return F.trim(local).rlike("\\d(?:[zZ]|[+-]\\d{2}:?\\d{2})$")


def absolute(local: Column) -> Column:
    """The instant of a string with an offset of its own."""
    tidy = F.regexp_replace(F.upper(F.trim(local)), "([+-]\\d{2})(\\d{2})$", "$1:$2")
    tidy = F.regexp_replace(tidy, "^([^T ]+[T ]\\d{1,2}:\\d{2})(Z|[+-])", "$1:00$2")
    return F.when(has_offset(local), tidy.try_cast("timestamp"))


def to_instant(local: Column, zone: Column) -> Column:
    """As the past-event test reads it: an offset wins, a time uses the zone, a bare date is UTC midnight."""
    timed = F.trim(local).rlike("^\\d{4}-\\d{2}-\\d{2}[T ]\\d{1,2}:\\d{2}")
    return (
        F.when(has_offset(local), absolute(local))
        .when(timed & zone.isNotNull(), local_to_instant(F.trim(local), F.coalesce(zone, F.lit("UTC"))))
        .otherwise(wall_clock(F.trim(local), seconds=True))
    )


def comparison_instant(local: Column, zone: Column) -> Column:
    """As change detection reads it: like persistence, a bare date is local midnight."""
    here = F.when(zone.isNotNull() & ~has_offset(local), local_to_instant(F.trim(local), F.coalesce(zone, F.lit("UTC"))))
    return F.coalesce(here, to_instant(local, zone))


def in_gap(local: Column, zone: Column) -> Column:
    """A time that the zone's clocks skip: it does not survive the round trip."""
    return instant_to_local(local_to_instant(local, zone), zone) != F.date_format(wall_clock(local), "yyyy-MM-dd'T'HH:mm")


def time_of_day(value: Column) -> Column:
    m = "^(\\d{1,2}):(\\d{2})"
    return F.when(value.rlike(m), F.concat(F.lpad(F.regexp_extract(value, m, 1), 2, "0"), F.lit(":"), F.regexp_extract(value, m, 2)))


def minutes_between(a: Column, b: Column) -> Column:
    """Whole minutes apart; null unless both are full local times."""
    full = "^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}"
    at = lambda c: F.when(c.rlike(full), wall_clock(c)).cast("long")
    return F.floor(F.abs(at(a) - at(b)) / 60 + 0.5).cast("long")


def local_date(local: Column) -> Column:
    return F.substring(local, 1, 10)


def serbian_datetime(raw: Column) -> Column:
    """struct(local, precision) of a Serbian date text; null where it holds no real date or an impossible time."""
    text = F.trim(F.regexp_replace(F.lower(raw), "(?U)\\s+", " "))
    pattern = "(\\d{1,2})\\.\\s*([a-zčćžšđ]+)\\.?\\s+(\\d{4})\\.?(?:\\s*(?:u\\s*)?(\\d{1,2})[.:h](\\d{2}))?"
    part = lambda k: F.regexp_extract(text, pattern, k)
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.try_element_at(months, part(2))
    date = F.try_to_date(F.concat(part(3), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0")), "yyyy-MM-dd").cast("string")
    timed = part(4) != ""
    fits = (part(4).try_cast("int") <= 23) & (part(5).try_cast("int") <= 59)
    local = F.when(timed, F.concat(date, F.lit("T"), F.lpad(part(4), 2, "0"), F.lit(":"), part(5))).otherwise(date)
    ok = text.rlike(pattern) & date.isNotNull() & (~timed | fits)
    return F.when(ok, F.struct(local.alias("local"), F.when(timed, "datetime").otherwise("date").alias("precision")))
