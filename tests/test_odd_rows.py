"""Odd rows and large groups that the given tables do not hold."""

import duckdb
from pyspark.sql import functions as F

from placemark.operators import classify, match
from placemark.plans import registry


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_content_hash_of_a_negative_zero_and_of_missing_fields(spark, tmp_path):
    rows = [(1, "a", -0.0, "x"), (2, "a", 0.0, "x"), (3, None, 1.0, "x"), (4, "a", None, "x"), (5, "a", 7.5, None), (6, "a", -0.004, "x"), (7, "a", -12.25, "x")]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    want = sorted(duck.sql(registry.ORACLES["content_hash"]).fetchall())
    got = registry.QUERIES["content_hash"](spark, str(tmp_path)).select("venue_id", "content").collect()
    assert sorted(map(tuple, got)) == want and want[0][1] != want[1][1] and want[2][1] is None


def test_rescues_meet_by_keys(spark):
    tags = lambda name: {"amenity": "fountain", "name": name}
    rows = spark.createDataFrame([("n1", tags("Old Mill"), "RS", "x"), ("n2", tags("Old Mill"), "RS", "y"), ("n3", tags("Hall"), "RS", "x")], "ref string, tags map<string,string>, country string, city string")
    rescues = spark.createDataFrame(
        [(3, "RS", "x", "n1", None, "late", "b"), (1, "RS", "x", "n1", "hall", "pinned", "a"), (2, "RS", "x", None, "old mill", "named", "c"), (0, "RS", "y", None, "old mill", "elsewhere", None), (9, "RS", "y", "n3", None, "other town", "d")],
        "ordinal int, country string, city string, osm_ref string, alias_key string, category string, allowed_amenity string",
    )
    met = classify.with_rescues(rows, rescues)
    assert {r.ref: (r.rescue_category, r.bypass) for r in met.collect()} == {"n1": ("pinned", "a"), "n2": ("elsewhere", None), "n3": (None, None)}
    # No part of the condition is left to be tried pair by pair.
    assert not [x for x in _plan(met).split("\n") if "Join" in x and ("CASE WHEN" in x or "NestedLoop" in x)]


def test_a_link_of_many_venues_is_summed_before_rows_meet_it(spark):
    rows = spark.range(40).select(F.col("id").alias("row_id"), F.lit("a").alias("source"), F.col("id").cast("string").alias("external_id"), F.lit("RS").alias("country"), F.lit("x").alias("city"))
    ids = rows.select("source", "external_id", "country", "city", F.lit(None).cast("long").alias("target_id"), F.lit("b").alias("target_source"), F.lit("k").alias("target_external_id"))
    stored = spark.range(50).select(F.col("id").alias("venue_id"), F.lit("b").alias("source"), F.lit("k").alias("external_id"))
    found = match.cross_source(rows, ids, stored)
    assert {(r.status, r.venue_id) for r in found.collect()} == {("conflict", None)}
    one = match.cross_source(rows, ids, stored.limit(1).union(stored.limit(1)))
    assert {(r.status, r.venue_id) for r in one.collect()} == {("found", 0)} and one.count() == 40
    # Joined, 40 rows and 50 venues made 2,000 that were counted apart.
    joins = found.select("row_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in _plan(found) and "Aggregate" in joins.split("Join")[-1]
