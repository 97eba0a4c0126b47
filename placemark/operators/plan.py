"""A run's plan: upserts, reviews and the counts that report it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.operators.change import change_status, operation, target_id

OPERATION_ORDER = ("insert", "update", "link-only", "skip")


def plan(records: DataFrame) -> DataFrame:
    """records (outcome, stored_hash, content_hash, decision, stored_id, matched_id, ...) with status, operation, canonical_id."""
    status = change_status(F.col("outcome"), F.col("stored_hash"), F.col("content_hash"))
    out = records.withColumn("status", status).withColumn("operation", operation(F.col("status"), F.col("decision")))
    return out.withColumn("canonical_id", F.when(F.col("operation") != "review", target_id(F.col("status"), F.col("stored_id"), F.col("matched_id"))))


def upserts(planned: DataFrame) -> DataFrame:
    """In the order they are applied: venues before events, inserts first, then by external id."""
    order = F.array_position(F.array(*map(F.lit, OPERATION_ORDER)), F.col("operation"))
    return planned.where("operation <> 'review'").orderBy(F.col("kind") == "event", order, "external_id")


def reviews(planned: DataFrame) -> DataFrame:
    return planned.where("operation = 'review'")


def distinct_inserts(planned: DataFrame) -> DataFrame:
    """One row: the planned inserts, counted once a source key however many pages name it."""
    return planned.where("operation = 'insert'").agg(F.count_distinct("source", "external_id").alias("planned_inserts"))


def counted(df: DataFrame, *by: str) -> DataFrame:
    """Counts, most first, then by key."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)
