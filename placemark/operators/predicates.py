"""What to ask a map source for: a small tree of clauses with two readings, the source's query text and a Catalyst predicate."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from placemark.operators.classify import KAFANA, PERFORMANCE, RIVER, SHISHA

Value = Callable[[str], Column]


@dataclass(frozen=True)
class Has:
    """The tag is there."""

    key: str

    def text(self) -> str:
        return f'["{self.key}"]'

    def column(self, value: Value) -> Column:
        return value(self.key).isNotNull()

    pushed = column


@dataclass(frozen=True)
class Eq:
    key: str
    value: str

    def text(self) -> str:
        return f'["{self.key}"="{self.value}"]'

    def column(self, value: Value) -> Column:
        return F.coalesce(value(self.key) == self.value, F.lit(False))

    def pushed(self, value: Value) -> Column:
        return value(self.key) == self.value


@dataclass(frozen=True)
class In:
    """One of the values, whole; a source takes it as an anchored alternation."""

    key: str
    values: tuple[str, ...]

    def text(self) -> str:
        return f'["{self.key}"~"^({"|".join(self.values)})$"]'

    def column(self, value: Value) -> Column:
        return F.coalesce(value(self.key).isin(*self.values), F.lit(False))

    def pushed(self, value: Value) -> Column:
        return value(self.key).isin(*self.values)


@dataclass(frozen=True)
class Matches:
    """The pattern occurs in the value."""

    key: str
    pattern: str
    any_case: bool = False

    def text(self) -> str:
        return f'["{self.key}"~"{self.pattern}"{",i" if self.any_case else ""}]'

    def column(self, value: Value) -> Column:
        return F.coalesce(value(self.key).rlike(("(?iu)" if self.any_case else "") + self.pattern), F.lit(False))

    def pushed(self, value: Value) -> Column:
        return value(self.key).isNotNull()  # a file format cannot search; it can tell that there is something to search


Filter = Has | Eq | In | Matches


@dataclass(frozen=True)
class Clause:
    """All of its filters hold."""

    filters: tuple[Filter, ...]

    def text(self) -> str:
        return f"  nwr{''.join(f.text() for f in self.filters)}(area.bg);"

    def column(self, value: Value) -> Column:
        return reduce(Column.__and__, (f.column(value) for f in self.filters))

    def pushed(self, value: Value) -> Column:
        return reduce(Column.__and__, (f.pushed(value) for f in self.filters))


@dataclass(frozen=True)
class Layer:
    """Any of its clauses holds, or the object is one of refs ("node/1")."""

    title: str
    clauses: tuple[Clause, ...] = ()
    refs: tuple[str, ...] = ()

    def text(self) -> list[str]:
        ids = {k: [r.split("/")[1] for r in self.refs if r.startswith(k + "/")] for k in ("node", "way", "relation")}
        return [f"  // {self.title}", *(c.text() for c in self.clauses), *(f"  {k}(id:{','.join(v)});" for k, v in ids.items() if v)]

    def column(self, value: Value, ref: Column | None = None) -> Column:
        tests = [c.column(value) for c in self.clauses] + ([ref.isin(*self.refs)] if self.refs and ref is not None else [])
        return reduce(Column.__or__, tests, F.lit(False)) if not tests else reduce(Column.__or__, tests)

    def pushed(self, value: Value, ref: Column | None = None) -> Column | None:
        tests = [c.pushed(value) for c in self.clauses] + ([ref.isin(*self.refs)] if self.refs and ref is not None else [])
        return reduce(Column.__or__, tests) if tests else None


def literal(words: tuple[str, ...]) -> str:
    return "|".join(re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", w) for w in words)


def _layer(title: str, *clauses: tuple[Filter, ...]) -> Layer:
    return Layer(title, tuple(Clause(c) for c in clauses))


# What a source is asked for. The classifier judges every element again.
BASE = ("restaurant", "cafe", "theatre", "arts_centre", "community_centre", "social_centre", "events_venue")
SIGNALS: tuple[Filter, ...] = (
    Has("live_music"), In("music", ("live", "dj")), Eq("music:live", "yes"), Eq("concert", "yes"), Eq("dancing", "yes"), Eq("dancefloor", "yes"), Eq("stage", "yes"), Eq("karaoke", "yes"), Eq("dj", "yes"),
    Eq("concerts", "yes"), Eq("disco", "yes"), Eq("nightclub", "yes"), In("theatre:type", ("concert_hall", "music", "cabaret")), In("theatre:genre", ("comedy", "cabaret", "stand_up")),
    In("community_centre", ("music", "arts", "youth_centre")), Eq("microbrewery", "yes"), Has("brewery"), Eq("real_ale", "yes"), Matches("name", "|".join(PERFORMANCE), True),
)
BY_DEFINITION = _layer(
    "Layer A — nightlife by definition", *((Eq("amenity", a),) for a in ("nightclub", "bar", "pub", "biergarten", "music_venue", "karaoke_box")),
    (In("club", ("music", "nightlife")),), (Eq("karaoke", "yes"),), (In("leisure", ("dance", "karaoke")),),
)
BY_NAME = _layer(
    "Regional name layers — kafana / splav / shisha", (In("amenity", ("restaurant", "bar", "pub", "cafe")), Matches("name", literal(KAFANA), True)),
    (In("amenity", ("restaurant", "bar", "pub", "nightclub")), Matches("name", literal(RIVER), True)), (In("amenity", ("cafe", "bar", "pub", "restaurant")), Matches("name", literal(SHISHA), True)),
    (In("amenity", ("cafe", "restaurant")), Eq("shisha", "yes")),
)
BY_SIGNAL = _layer(
    "Layer B — base category + a documented signal (server-gated)", *((In("amenity", BASE), s) for s in SIGNALS), (Eq("craft", "brewery"),), (Eq("club", "social"),),
    (In("amenity", ("restaurant", "cafe")), Eq("bar", "yes")),
)
LAYERS = (BY_DEFINITION, BY_NAME, BY_SIGNAL)
AREA, SECONDS = 3_600_000_000, 240


def rescue_layer(names: tuple[str, ...] = (), refs: tuple[str, ...] = ()) -> Layer:
    """A city's curated rescues: by whole name, and the very objects."""
    by_name = (Clause((Matches("name", f"^({literal(names)})$", True),)),) if names else ()
    return Layer("Layer C — curated rescue (by name)", by_name, refs)


def query_text(relation: int, layers: tuple[Layer, ...] = LAYERS, rescue: Layer | None = None) -> str:
    """The query of one city's area; rescues that are objects alone need no heading."""
    last = [] if rescue is None else rescue.text()[0 if rescue.clauses else 1 :]
    lines = [line for layer in layers for line in layer.text()]
    return "\n".join([f"[out:json][timeout:{SECONDS}];", f"area(id:{AREA + relation})->.bg;", "(", *lines, *last, ");", "out tags center;"])


def predicate(layers: tuple[Layer, ...], value: Value, ref: Column | None = None) -> Column:
    """True for the elements that the query text would return.

    value gives a tag's column: a map's entry, or a column of its own. In the second case
    the scan gets a part it can use: its looser reading is put before the exact one.
    """
    exact = reduce(Column.__or__, (layer.column(value, ref) for layer in layers))
    looser = [p for p in (layer.pushed(value, ref) for layer in layers) if p is not None]
    return reduce(Column.__or__, looser) & exact if looser else exact


def of_map(tags: Column) -> Value:
    return lambda key: F.try_element_at(tags, F.lit(key))


def of_columns(names: dict[str, str]) -> Value:
    """Tags that the table keeps in columns of their own; the others are absent."""
    return lambda key: F.col(names[key]) if key in names else F.lit(None).cast("string")
