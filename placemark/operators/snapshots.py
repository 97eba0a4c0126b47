"""What is stored of a source at an instant, and which of it a run may speak of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of(versions: DataFrame, instant: Column, *keys: str) -> DataFrame:
    """The last version of each key that was written no later than the instant; a key removed by then is left out.

    versions: keys, written_at, version (later of equal times), removed, and what a version holds.
    One aggregation with partial maxima: a key with very many versions is never gathered.
    """
    held = [c for c in versions.columns if c not in keys]
    last = versions.where(F.col("written_at") <= instant).groupBy(*keys).agg(F.max_by(F.struct(*held), F.struct("written_at", "version")).alias("last"))
    return last.where(~F.coalesce(F.col("last.removed"), F.lit(False))).select(*keys, *(F.col(f"last.{c}").alias(c) for c in held if c != "removed"))


def source_snapshot(links: DataFrame, events: DataFrame, now: Column) -> DataFrame:
    """A row a stored link (key, kind, canonical_id, source_status, misses, frozen, cancelled), as reconciliation takes it.

    An event is frozen once its start lies before now and cancelled by its own status; a
    venue is neither. A link whose event is not stored is neither too.
    links: source, external_id, kind, canonical_id, source_status, misses; events: event_id, start_at (an instant), status.
    """
    of_event = events.select(F.col("event_id").alias("canonical_id"), F.lit("event").alias("kind"), "start_at", "status")
    rows = links.join(of_event, ["canonical_id", "kind"], "left")
    flag = lambda test: F.coalesce(test, F.lit(False))
    return rows.select(
        F.concat_ws(":", "source", "external_id").alias("key"), "kind", "canonical_id", "source_status", "misses",
        flag(F.col("start_at") < now).alias("frozen"), flag(F.col("status") == "cancelled").alias("cancelled"),
    )


def in_scope(snapshot: DataFrame, seen: DataFrame, scope: DataFrame | None = None, partial: bool = False) -> DataFrame:
    """The rows that a run may find missing, with the flag seen.

    A venue outside the run's cities was never asked for and stays out unless it was seen
    all the same; a partial run speaks of what it saw alone.
    seen: key; scope: canonical_id of the venues in the run's cities (None: everywhere).
    """
    there = seen.select("key", F.lit(True).alias("seen")).distinct()
    rows = snapshot.join(there, "key", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    if scope is not None:
        inside = scope.select("canonical_id", F.lit(True).alias("inside")).distinct()
        rows = rows.join(inside, "canonical_id", "left").where("kind <> 'venue' or seen or inside").select(*rows.columns)
    return rows.where("seen") if partial else rows
