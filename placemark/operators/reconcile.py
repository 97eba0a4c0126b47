"""How long records have been missing from their source, and whether a run may tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STALE, MISSING, GONE = 1, 2, 3
FETCH_LIMIT, PARSE_LIMIT, LEAST_SEEN = 0.5, 0.3, 0.4


def transition(kind: Column, status: Column, misses: Column, seen: Column, frozen: Column, cancelled: Column, steps: tuple[int, int, int] = (STALE, MISSING, GONE)) -> Column:
    """struct(action, misses): protected states first, then seen, then the ladder of misses."""
    out = lambda action, n: F.struct(F.lit(action).alias("action"), n.cast("int").alias("misses"))
    next_ = misses + 1
    zero = F.lit(0)
    return (
        F.when(frozen | cancelled, out("no-op", misses))
        .when(status == "gone", F.when((kind == "venue") & seen, out("keep-active", zero)).otherwise(out("no-op", misses)))
        .when(seen, out("keep-active", zero))
        .when(next_ >= steps[2], out("mark-gone", next_))
        .when(next_ >= steps[1], out("mark-missing", next_))
        .when(next_ >= steps[0], out("mark-stale", next_))
        .otherwise(out("keep-active", next_))
    )


def status_after(action: Column, before: Column) -> Column:
    return F.when(action == "keep-active", "active").when(action == "mark-stale", "stale").when(action == "mark-missing", "missing").when(action == "mark-gone", "gone").otherwise(before)


def run_health(counts: DataFrame) -> DataFrame:
    """One row counts (discovered, fetch_failed, parse_failed) with status and healthy."""
    fetched = F.col("discovered") - F.col("fetch_failed")
    worn = F.coalesce(F.try_divide("fetch_failed", "discovered") >= FETCH_LIMIT, F.lit(False)) | F.coalesce(F.try_divide(F.col("parse_failed"), fetched) >= PARSE_LIMIT, F.lit(False))
    status = F.when(F.col("discovered") == 0, "failed").when(worn, "degraded").otherwise("ok")
    return counts.withColumn("status", status).withColumn("healthy", F.col("status") == "ok")


def snapshot_guard(stored: DataFrame, failed_refs: Column, least_seen: float = LEAST_SEEN) -> DataFrame:
    """One row (baseline, seen, healthy): a failed part or a collapsed result is no mass closure.

    stored: seen, frozen, cancelled, source_status.
    """
    open_ = ~F.col("frozen") & ~F.col("cancelled") & (F.col("source_status") != "gone")
    summed = stored.agg(F.count_if(open_).alias("baseline"), F.count_if(open_ & F.col("seen")).alias("seen"), failed_refs.alias("failed_refs"))
    collapsed = (F.col("baseline") > 0) & (F.try_divide("seen", "baseline") < least_seen)
    return summed.select("baseline", "seen", (~(F.coalesce(collapsed, F.lit(False)) | (F.col("failed_refs") > 0))).alias("healthy"))


def baseline_in_scope(links: DataFrame, venues: DataFrame, scope: DataFrame) -> DataFrame:
    """(city_id, venues): the source's linked venues in each city in scope, cities without any included.

    links: canonical_id; venues: venue_id, city_id; scope: city_id.
    """
    linked = venues.join(links.select(F.col("canonical_id").alias("venue_id")), "venue_id", "left_semi").groupBy("city_id").agg(F.count("*").alias("venues"))
    return scope.select("city_id").distinct().join(linked, "city_id", "left").select("city_id", F.coalesce("venues", F.lit(0)).alias("venues"))


def reconciled(stored: DataFrame, seen_keys: DataFrame, healthy: DataFrame, partial: bool = False) -> DataFrame:
    """stored (key, kind, source_status, misses, frozen, cancelled) with action and new_misses; no rows if the run is unhealthy.

    A partial run speaks only of what it saw. healthy is a row with the flag, joined as a literal side.
    """
    marked = stored.join(seen_keys.select("key", F.lit(True).alias("was_seen")).distinct(), "key", "left").withColumn("seen", F.coalesce("was_seen", F.lit(False))).drop("was_seen")
    if partial:
        marked = marked.where("seen")
    ok = healthy.where("healthy").select(F.lit(1).alias("gate"))
    step = transition(F.col("kind"), F.col("source_status"), F.col("misses"), F.col("seen"), F.col("frozen"), F.col("cancelled"))
    out = marked.withColumn("gate", F.lit(1)).join(F.broadcast(ok), "gate").drop("gate")  # one row at most
    return out.withColumn("step", step).withColumns({"action": F.col("step.action"), "new_misses": F.col("step.misses")}).drop("step")
