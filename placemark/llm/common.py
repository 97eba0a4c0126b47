"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of bytes outside these; str.split() on *bytes* cuts at just these.
WHITE = "\\x20\\x09-\\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only on one machine where the session names none."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = _own_dir()
    return where.rstrip("/")


@cache
def _own_dir() -> str:
    """One for this process, gone when it ends."""
    where = tempfile.mkdtemp(prefix="placemark-")
    atexit.register(shutil.rmtree, where, ignore_errors=True)
    return where


#: Shuffle files go with the query that wrote them, and whole texts go to Python a few at a time.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Run what is inside with the settings of LEAN."""
    before = {k: spark.conf.get(k) for k in LEAN}
    for k, v in LEAN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of df with a Parquet table in the shared folder; the table replaces the shuffle files behind it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with lean(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that stored() wrote, once what was made of them is stored itself."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


#: A key with more than one in so many of all rows is hot: fewer than so many are.
HOT = 10_000


def is_hot(side: DataFrame) -> Column:
    return F.col("n") * HOT > side.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def meet(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """rows joined with side, a stored table of one row a key with n, how many of rows have the key.

    A hot key's rows stay where they are and its row of side is broadcast - there are
    fewer than HOT such keys, whatever the input - so that no key's rows gather in one task.
    """
    hot = is_hot(side)
    often, rest = F.broadcast(side.where(hot)), side.where(~hot)
    cold = rows.join(F.broadcast(side.where(hot).select(*keys)), keys, "left_anti")
    return rows.join(often, keys).unionByName(cold.join(rest.hint("merge"), keys))


def one_of_equal(rows: DataFrame, name: str) -> DataFrame:
    """One row of each rid, with copies, how many there are; rows of one rid are equal.

    Rows whose rid is their own stay where they are; of the others each task passes one on.
    """
    again = stored(rows.groupBy("rid").agg(F.count("*").alias("n")).where("n > 1"), name)
    hot = is_hot(again)
    often, seldom = F.broadcast(again.where(hot).select("rid")), again.where(~hot).select("rid")
    own = rows.join(often, "rid", "left_anti").join(seldom, "rid", "left_anti").withColumn("copies", F.lit(1).cast("long"))
    many = rows.join(often, "rid", "left_semi").union(rows.join(seldom, "rid", "left_semi"))
    first = [F.first(c).alias(c) for c in rows.columns if c != "rid"]
    return own.unionByName(many.groupBy("rid").agg(*first, F.count("*").alias("copies")))


#: So many copies of one row are made by one task.
COPIES = 10_000


def multiplied(rows: DataFrame, copies: Column, made: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Each row so many times; very many copies of one are made in pieces, by many tasks.

    made: works the rows, before they are multiplied; it keeps the columns that copies reads.
    """
    few, many = (made(rows.where(own)).withColumn("__copies", copies) for own in (copies.between(1, COPIES), copies > COPIES))
    columns = few.columns[:-1]
    few = few.withColumn("__start", F.lit(1).cast("long"))
    many = many.withColumn("__start", F.explode(F.expr(f"sequence(1L, __copies, {COPIES}L)")))
    many = many.repartition(F.spark_partition_id(), "__start")
    each = F.explode(F.expr(f"sequence(__start, least(__start + {COPIES - 1}, __copies))"))
    return few.unionByName(many).withColumn("__each", each).select(*columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a text; bytes methods know ASCII alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def row_key() -> Column:
    """A long that tells rows apart by doc_id and text; null and repeated ids have no fewer bits than others."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) links -> (node, component), component being the smallest node reachable.

    Every round hooks each node to its smallest neighbour, jumps pointers once
    and contracts the links to the new roots, so the links left shrink fast;
    a group's centre is reached by aggregation, never gathered in one place.
    Null ends are ignored. Nodes without a link are not returned.
    """
    first = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        name,
    )
    links, hooks = first, []
    while not links.isEmpty():
        up = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        # Each hook points to a smaller node: a second hop and then contraction.
        hop = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        up = stored(up.join(hop, "root", "left").select("node", F.coalesce("next", "root").alias("root")), name)
        hooks.append(up)
        left = links
        for end in ("a", "b"):
            moved = up.select(F.col("node").alias(end), F.col("root").alias("root_" + end))
            left = left.join(moved, end, "left").withColumn(end, F.coalesce("root_" + end, end)).drop("root_" + end)
        left = stored(left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
        if links is not first:
            discard(links)
        links = left
    # The rounds are few, about the logarithm of the longest chain: follow each node through their hooks.
    labels = first.select(F.col("a").alias("node")).union(first.select(F.col("b"))).distinct().withColumn("component", F.col("node"))
    for up in hooks:
        moved = up.select(F.col("node").alias("component"), "root")
        labels = labels.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    labels = stored(labels, name)
    discard(first, links, *hooks)
    return labels
