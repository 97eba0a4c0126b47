"""What a source offers: references, raw responses, records - all as DataFrames - and the counts that describe a run."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Capabilities:
    """Which kinds a source gives, and whether its absence of a row means anything."""

    kinds: tuple[str, ...]
    snapshot: bool = True
    linked_venues: bool = False


class Adapter(Protocol):
    """discover -> fetch -> parse over landed data; fetch_linked gives the pages that records refer to."""

    key: str
    capabilities: Capabilities

    def refs(self) -> DataFrame:
        """(ref, ...) of everything to be fetched."""

    def raw(self, refs: DataFrame) -> DataFrame:
        """(ref, ok, body) of each reference."""

    def records(self, raw: DataFrame) -> DataFrame:
        """Sync records of what could be parsed."""


def limited(refs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The first limit references and one row (partial): true as soon as limit of them were taken, even if there were no more."""
    taken = refs.limit(limit) if limit else refs
    return taken, taken.agg((F.lit(bool(limit)) & (F.count("*") >= limit)).alias("partial"))


def collected(found: DataFrame, *by: str) -> DataFrame:
    """A row a target: fetched = kept + invalid + excluded elements. found: bucket (venue, invalid, excluded)."""
    n = lambda bucket: F.count_if(F.col("bucket") == bucket)
    return found.groupBy(*by).agg(F.count("*").alias("fetched"), n("venue").alias("kept"), n("invalid").alias("invalid"), n("excluded").alias("excluded"))


def target_failures(refs: DataFrame, counts: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(ref, code) of targets that gave nothing: invalid-json, empty-result (no elements) or no-accepted-venues.

    refs: ref; counts: ref, fetched, kept; unreadable: ref.
    """
    bad = unreadable.select("ref", F.lit(True).alias("bad")).distinct()
    rows = refs.select("ref").distinct().join(bad, "ref", "left").join(counts.select("ref", "fetched", "kept"), "ref", "left")
    code = F.when(F.col("bad"), "invalid-json").when(F.coalesce("fetched", F.lit(0)) == 0, "empty-result").when(F.col("kept") == 0, "no-accepted-venues")
    return rows.select("ref", code.alias("code")).where("code is not null")
