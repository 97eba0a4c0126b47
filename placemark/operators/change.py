"""Change detection by content hash and field deltas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: Column) -> Column:
    """A number as the hash sees it: no negative zero, no NaN."""
    return F.when(~F.isnan(c), c + F.lit(0.0))


def content_json(fields: dict[str, Column]) -> Column:
    """Stable text of the comparable fields: sorted by name, nulls kept apart from absent ones."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]), {"ignoreNullFields": "false"})


def content_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(content_json(fields), 256)


def field_deltas(before: Column, after: Column) -> Column:
    """Differences of two maps as array<struct(field, has_from, old, has_to, new)>, by field; absent is not null."""
    keys = F.array_sort(F.array_distinct(F.concat(F.map_keys(before), F.map_keys(after))))
    at = lambda m, k: F.try_element_at(m, k)
    every = F.transform(
        keys,
        lambda k: F.struct(k.alias("field"), F.map_contains_key(before, k).alias("has_from"), at(before, k).alias("old"), F.map_contains_key(after, k).alias("has_to"), at(after, k).alias("new")),
    )
    return F.filter(every, lambda d: (d["has_from"] != d["has_to"]) | ~d["old"].eqNullSafe(d["new"]))


def substituted(incoming: Column, stored: Column, provided: Column, pinned: Column | None = None) -> Column:
    """The incoming value as it is compared: the stored one where the source did not give the field or it is pinned."""
    keep = ~provided if pinned is None else ~provided | F.coalesce(pinned, F.lit(False))
    return F.when(keep, stored).otherwise(incoming)


def change_status(outcome: Column, stored_hash: Column, incoming_hash: Column) -> Column:
    return (
        F.when(outcome == "rejected", "REJECTED")
        .when(outcome == "needs_review", "NEEDS_REVIEW")
        .when(stored_hash.isNull(), "NEW")
        .when(stored_hash == incoming_hash, "UNCHANGED")
        .otherwise("UPDATED")
    )


def operation(status: Column, decision: Column) -> Column:
    """insert, update, link-only, or review for what is held back."""
    return (
        F.when(status.isin("REJECTED", "NEEDS_REVIEW") | (decision == "ambiguous"), "review")
        .when(status == "NEW", F.when(decision == "matched", "link-only").otherwise("insert"))
        .when(status == "UNCHANGED", "link-only")
        .otherwise("update")
    )


def target_id(status: Column, stored_id: Column, matched_id: Column) -> Column:
    """The row an operation concerns: what is stored for the record wins over what matched."""
    return F.when(status != "NEW", F.coalesce(stored_id, matched_id)).otherwise(matched_id)
