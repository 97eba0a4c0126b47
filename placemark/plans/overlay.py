"""The venue and event domain laid over the provided tables.

country = region, city = nation, venue = customer, event = orders, genre = a
part's brand reached through lineitem; coordinates and clocks are arithmetic on
the keys. The previous snapshot of the venues lacks keys with remainder 3 of 10
and has another segment where 7 divides the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemark.sources.tables import table

LAT, LON = "44.7 + (c_custkey % 200) * 0.001", "20.3 + (c_custkey % 300) * 0.001"


def cities(spark: SparkSession, d: str) -> DataFrame:
    region = table(spark, d, "region")
    return table(spark, d, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("r_name").alias("country")
    )


def venues(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("venue_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("city_id"), (F.col("c_acctbal") > 0).alias("is_active"),
        F.format_string("%02d:%02d:00", F.col("c_custkey") % 24, F.col("c_custkey") % 60).alias("closing_time"), F.expr(LAT).alias("lat"), F.expr(LON).alias("lon"), "c_mktsegment", "c_acctbal",
    )


def genres(spark: SparkSession, d: str) -> DataFrame:
    """(venue_id, genre), reduced before it meets the orders' customers."""
    line = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return line.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("venue_id"), F.col("p_brand").alias("genre")).distinct()


def events(spark: SparkSession, d: str) -> DataFrame:
    """Orders as events: the clock is the order date plus minutes from the key."""
    start = F.expr("o_orderdate + make_dt_interval(0, int(o_orderkey % 24), int(o_orderkey % 4) * 15)")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("venue_id"), start.alias("start_at"), F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderkey") % 100).alias("ticket_id"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).alias("promoter_key"), "o_totalprice", "o_orderstatus",
    )


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The stored venues of the previous run, with their lifecycle state."""
    k = F.col("c_custkey")
    return table(spark, d, "customer").where(k % 10 != 3).select(
        k.alias("venue_id"), F.col("c_name").alias("name"), F.when(k % 7 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").alias("balance"),
        (k % 4).cast("int").alias("misses"), F.element_at(F.array(*map(F.lit, ("active", "stale", "missing", "gone"))), (k % 4 + 1).cast("int")).alias("source_status"),
        (k % 11 == 0).alias("frozen"), (k % 13 == 0).alias("cancelled"), F.when(k % 6 == 0, "venue").otherwise("event").alias("kind"),
    )
