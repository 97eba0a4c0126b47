"""A plan applied to a stored table: the next snapshot is computed whole and written anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.functions.text import name_key

FIELDS = ("name", "address", "website", "description", "opening_hours")


def next_venues(stored: DataFrame, plan: DataFrame, cities: DataFrame) -> DataFrame:
    """stored with the plan applied.

    plan: operation, venue_id (null for inserts), source, external_id, city and the
    fields. A value never erases one, coordinates set by hand stay, a row of
    another source is left alone, an unowned one is claimed; an insert whose key
    is stored becomes an update; an insert for an unknown city is left out
    (see deferred()).
    """
    own = stored.select("source", "external_id", F.col("venue_id").alias("stored_id")).where("source is not null")
    plan = plan.join(own, ["source", "external_id"], "left").withColumn("venue_id", F.coalesce("venue_id", "stored_id")).drop("stored_id")
    insert = plan.where("operation = 'insert' and venue_id is null")
    change = plan.where("venue_id is not null and operation in ('insert', 'update', 'link-only')")
    s, p = stored.alias("s"), change.alias("p")
    mine = F.col("s.source").isNull() | F.col("s.source").eqNullSafe(F.col("p.source"))
    writes = mine & (F.col("p.operation") != "link-only")
    touched = F.col("p.venue_id").isNotNull()
    pick = lambda c, also=F.lit(True): F.when(touched & writes & also, F.coalesce(F.col(f"p.{c}"), F.col(f"s.{c}"))).otherwise(F.col(f"s.{c}")).alias(c)
    by_hand = ~F.col("s.coordinates_source").eqNullSafe(F.lit("manual"))
    owner = lambda c: F.when(touched & F.col("s.source").isNull(), F.col(f"p.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    changed = s.join(p, F.col("s.venue_id") == F.col("p.venue_id"), "left").select(
        F.col("s.venue_id"), F.col("s.city"), owner("source"), owner("external_id"), *[pick(f) for f in FIELDS], pick("lat", by_hand), pick("lon", by_hand), pick("coordinates_source", by_hand),
    )
    new = insert.join(cities.select("city").distinct(), "city").select(
        F.xxhash64("source", "external_id").alias("venue_id"), "city", "source", "external_id", *FIELDS, "lat", "lon", "coordinates_source"
    )
    return changed.unionByName(new)


def deferred(stored: DataFrame, plan: DataFrame, cities: DataFrame) -> DataFrame:
    """(source, external_id, reason) of what a plan leaves undone."""
    known = cities.select("city", F.lit(True).alias("known")).distinct()
    own = stored.select("venue_id", F.col("source").alias("owner"), F.lit(True).alias("there"))
    rows = plan.join(known, "city", "left").join(own, "venue_id", "left")
    reason = (
        F.when((F.col("operation") == "insert") & F.col("venue_id").isNull() & F.col("known").isNull(), "unknown city")
        .when(F.col("venue_id").isNotNull() & F.col("there").isNull(), "row not found")
        .when(F.col("owner").isNotNull() & (F.col("owner") != F.col("source")), "owned by another source")
    )
    return rows.select("source", "external_id", reason.alias("reason")).where("reason is not null")


def next_events(stored: DataFrame, plan: DataFrame) -> DataFrame:
    """The events table after the plan; a cancelled event stays cancelled, events without venue or start wait."""
    fit = plan.where("venue_id is not null and start_at is not null")
    s, p = stored.alias("s"), fit.alias("p")
    mine = F.col("s.source").eqNullSafe(F.col("p.source"))
    joined = s.join(p, mine & (F.col("s.external_id") == F.col("p.external_id")), "full_outer")
    pick = lambda c: F.coalesce(F.col(f"p.{c}"), F.col(f"s.{c}")).alias(c)
    cancelled = F.coalesce(F.col("s.is_cancelled"), F.lit(False)) | F.coalesce(F.col("p.status") == "cancelled", F.lit(False))
    return joined.select(pick("source"), pick("external_id"), pick("venue_id"), pick("title"), pick("start_at"), cancelled.alias("is_cancelled"))


def lifecycle_write(stored: DataFrame, actions: DataFrame) -> DataFrame:
    """stored (venue_id, is_active, source_status, misses) after reconcile actions; gone closes, a return from gone opens."""
    from placemark.operators.reconcile import status_after

    rows = stored.join(actions.select("venue_id", "action", "new_misses"), "venue_id", "left")
    after = F.when(F.col("action").isNull(), F.col("source_status")).otherwise(status_after(F.col("action"), F.col("source_status")))
    active = F.when(after == "gone", F.lit(False)).when((F.col("source_status") == "gone") & (after == "active"), F.lit(True)).otherwise(F.col("is_active"))
    return rows.select("venue_id", active.alias("is_active"), after.alias("source_status"), F.coalesce("new_misses", "misses").alias("misses"))


def deferred_event_lifecycle(actions: DataFrame) -> DataFrame:
    """(kind, key, transition, note) of the steps that events have no columns for yet: nothing is deleted or cancelled.

    actions: kind, key, action. No-ops and rows kept active need no note.
    """
    steps = actions.where("kind = 'event' and action like 'mark-%'")
    note = F.concat(F.lit("reconciliation "), "action", F.lit(" for event "), F.col("key").cast("string"), F.lit(" not persisted"))
    return steps.select("kind", "key", F.col("action").alias("transition"), note.alias("note"))


def fill_empty(stored: DataFrame, incoming: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The older ingest's update: only empty fields are filled; patch lists them."""
    s, i = stored.alias("s"), incoming.alias("i")
    empty = lambda f: F.coalesce(F.col(f"s.{f}"), F.lit("")) == ""
    takes = {f: empty(f) & (F.coalesce(F.col(f"i.{f}"), F.lit("")) != "") for f in fields}
    return s.join(i, F.col("s.venue_id") == F.col("i.venue_id"), "left").select(
        "s.venue_id", *[F.when(t, F.col(f"i.{f}")).otherwise(F.col(f"s.{f}")).alias(f) for f, t in takes.items()],
        F.array_compact(F.array(*[F.when(t, f) for f, t in takes.items()])).alias("patch"),
    )


def backfilled(stored: DataFrame) -> DataFrame:
    """stored (name, name_key, ...) with the missing and empty name keys made from the names, and which ones (filled).

    Comes before matching, so that a run that writes nothing matches by them too.
    """
    missing = F.coalesce("name_key", F.lit("")) == ""
    return stored.withColumns({"filled": missing, "name_key": F.when(missing, name_key(F.col("name"))).otherwise(F.col("name_key"))})


def get_or_create(dimension: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """dimension plus a row for each key of wanted that it lacks."""
    missing = wanted.select(key).where(F.col(key).isNotNull()).distinct().join(dimension, key, "left_anti")
    return dimension.unionByName(missing, allowMissingColumns=True)


def commit_refusal(status: str, healthy: bool) -> str | None:
    """Why a plan may not be applied, or None."""
    return "the run failed" if status == "failed" else None if healthy else "the run is unhealthy"


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """All or nothing: a version is a directory of its own, read only once it is complete."""
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")
