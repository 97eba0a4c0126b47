"""Readers: Parquet tables, landing zones of JSON, XML and HTML, fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ELEMENT = "type: string, id: bigint, lat: double, lon: double, center: struct<lat: double, lon: double>, tags: map<string, string>"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def elements(spark: SparkSession, path: str) -> DataFrame:
    """Map elements from response files; a file with a remark or without elements is a failed part and gives no rows here."""
    raw = spark.read.schema(f"remark string, elements array<struct<{ELEMENT}>>").json(path, multiLine=True)
    return raw.where("coalesce(trim(remark), '') = '' and elements is not null").select(F.posexplode("elements").alias("position", "e")).select("position", "e.*")


def failed_parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, code) of response files that cannot be used: invalid-json, remark or empty-result."""
    raw = spark.read.schema(f"remark string, elements array<struct<{ELEMENT}>>, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True)
    code = F.when(F.col("_corrupt").isNotNull(), "invalid-json").when(F.trim(F.coalesce("remark", F.lit(""))) != "", "remark").when(F.coalesce(F.size("elements"), F.lit(0)) <= 0, "empty-result")
    return raw.select(F.input_file_name().alias("part"), code.alias("code")).where("code is not null")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(url, body): whole files, the path standing for the URL."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("body"))


def fixture(spark: SparkSession, rows: list, schema: str, outage: bool = False) -> DataFrame:
    """Rows of a fixed source; an outage is a source that gives none."""
    return spark.createDataFrame([] if outage else rows, schema)
