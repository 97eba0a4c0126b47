"""Runs over time: the keyed ladder against the batch, the commit log under two writers."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from placemark.operators import config, runs
from placemark.operators.commit_log import CommitLog, Conflict, Refused
from placemark.streaming import lifecycle

STATE = "key string, kind string, source_status string, misses int, frozen boolean, cancelled boolean"


def stored(spark, n=70):
    r = random.Random(1)
    out = []
    for i in range(n):
        status = r.choice(["active", "active", "active", "stale", "missing", "gone"])
        out.append((f"k{i}", r.choice(["venue", "event"]), status, {"active": 0, "stale": 1, "missing": 2, "gone": 3}[status], i % 11 == 0, i % 13 == 0))
    return spark.createDataFrame(out, STATE)


def rows(df):
    return sorted(map(tuple, df.select(*lifecycle.STORED).collect()))


def test_stream_and_batch_agree(spark, tmp_path):
    """Ten runs: one collapsed, one with a failed part, one tried twice; the state is that of the batch after each."""
    r = random.Random(2)
    begin = stored(spark)
    keys = [x.key for x in begin.collect()]
    ladder, batch, moved = lifecycle.LifecycleStream(spark, str(tmp_path), begin), begin.collect(), []
    for n, share in enumerate((0.7, 0.8, 0.05, 0.6, 0.9, 0.9, 0.45, 0.7, 0.55, 0.8)):
        seen = spark.createDataFrame([(k,) for k in keys if r.random() < share] + [("not stored",), (None,)], "key string")
        failed = int(n == 5)
        took = ladder.take(seen, f"run {n}", failed)
        assert took == (n not in (2, 5))
        before = spark.createDataFrame(batch, STATE)
        batch = lifecycle.advance(before, seen, lifecycle.guard(before, seen, failed).select("healthy")).collect()
        moved += [(a.key, b.source_status) for a, b in zip(sorted(before.collect()), sorted(batch), strict=True) if a.source_status != b.source_status]
        assert rows(ladder.state()) == sorted(map(tuple, batch))
        if n == 3:
            assert ladder.take(seen, "run 3") and rows(ladder.state()) == sorted(map(tuple, batch))
    # A new process goes on from the folder; what moved was told once.
    again = lifecycle.LifecycleStream(spark, str(tmp_path), begin)
    assert rows(again.state()) == sorted(map(tuple, batch))
    told = [(x.key, x.source_status) for x in again.changes().collect()]
    known = [m for m in moved if m in told]
    assert len(told) == len(set((x.key, x.run) for x in again.changes().collect())) and len(known) >= 0.9 * len(moved)
    assert [x.parent for x in again.log.history().orderBy("version").collect()] == list(range(-1, 7))


def test_collapsed_run_closes_nothing(spark, tmp_path):
    """A run that sees one key in a hundred is an outage, not a mass closure; three of them change nothing."""
    begin = spark.createDataFrame([(f"k{i}", "venue", "active", 0, False, False) for i in range(100)], STATE)
    ladder = lifecycle.LifecycleStream(spark, str(tmp_path), begin)
    for n in range(3):
        assert not ladder.take(spark.createDataFrame([("k1",)], "key string"), str(n))
    assert rows(ladder.state()) == rows(begin)
    assert not lifecycle.guard(begin, spark.createDataFrame([], "key string")).first().healthy
    assert lifecycle.guard(begin.limit(0), spark.createDataFrame([], "key string")).first().healthy


def test_stream_of_runs(spark, tmp_path):
    """Micro-batches as runs; rows left behind by a writer that never published are not a run."""
    begin = stored(spark, 20)
    ladder = lifecycle.LifecycleStream(spark, str(tmp_path / "ladder"), begin)
    begin.limit(0).select("key", F.lit(1).cast("long").alias("run"), F.lit("lost").alias("token")).write.parquet(str(tmp_path / "ladder/runs/data/lost0"))
    begin.select("key", F.lit(1).cast("long").alias("run"), F.lit("lost").alias("token")).write.parquet(str(tmp_path / "ladder/runs/data/lost1"))
    for n in range(2):
        begin.where(F.col("key") != f"k{n + 1}").select("key").coalesce(1).write.parquet(str(tmp_path / f"seen/run={n}"))
    seen = spark.readStream.schema("key string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "seen/*"))
    lifecycle.run_stream(seen, ladder).option("checkpointLocation", str(tmp_path / "stream")).trigger(availableNow=True).start().awaitTermination()
    assert len(ladder.log.versions()) == 2
    # The files may come in either order; each of the two keys missed one run, in its place.
    got = {x.key: x for x in ladder.state().collect()}
    held = [x.key for x in begin.collect() if x.key in ("k1", "k2") and not (x.frozen or x.cancelled or x.source_status == "gone")]
    assert sum(got[k].misses > 0 for k in held) in (1, 2) or not held
    assert len(got) == 20


def test_one_of_two_writers_wins(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.current() == -1 and log.commit(spark.range(3).selectExpr("id", "'a' as name"), -1) == 0
    for parent in range(4):
        barrier, outcomes = threading.Barrier(3), []

        def write(n, parent=parent, barrier=barrier, outcomes=outcomes):
            own = CommitLog(spark, str(tmp_path))
            df = spark.range(n + 1).selectExpr("id", f"'{n}' as name")
            barrier.wait()
            try:
                outcomes.append((own.commit(df, parent, note={"writer": n}), n))
            except Conflict:
                outcomes.append((None, n))

        threads = [threading.Thread(target=write, args=(n,)) for n in range(3)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        won = [(v, n) for v, n in outcomes if v is not None]
        assert len(won) == 1 and won[0][0] == parent + 1 == log.current()
        assert log.read().count() == won[0][1] + 1 and log.manifest(parent + 1)["note"] == {"writer": won[0][1]}
    with pytest.raises(Conflict):
        log.commit(spark.range(1).selectExpr("id", "'x' as name"), 1)
    assert log.read(0).count() == 3 and [r.parent for r in log.history().orderBy("version").collect()] == [-1, 0, 1, 2, 3]


def test_torn_write_is_never_read(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    log.commit(spark.range(5).toDF("id"), -1)
    spark.range(99).toDF("id").write.parquet(str(tmp_path / "data/half"))  # a writer that died before it published
    (tmp_path / "log/.x.part").write_text('{"parent": 0, "da')
    (tmp_path / "log/note.txt").write_text("no manifest")
    assert log.current() == 0 and log.read().count() == 5
    assert log.sweep() == 1 and log.read().count() == 5
    assert log.commit(spark.range(6).toDF("id"), 0) == 1


def test_gate_of_the_commit(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    for status, healthy in (("failed", False), ("degraded", False)):
        with pytest.raises(Refused):
            log.commit(spark.range(1), -1, status, healthy)
    assert log.current() == -1


def test_a_run_is_committed_with_its_counters(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    stage = lambda *n: spark.createDataFrame([(s, "primary" if s == "accepted" else None, f"s:{i}" if s == "accepted" else None) for s, k in zip(runs.EVENT_STAGES, n, strict=True) for i in range(k)], "stage string, tier string, source_key string")
    after = spark.createDataFrame([("s:0", "title")], "source_key string, title string")
    good = runs.event_counters(stage(1, 1, 2, 6))
    assert runs.commit_run(log, after, -1, good, "first") == 0 and log.read().count() == 1
    assert log.manifest(0)["note"] == {"run_id": "first", "discovered": 10, "fetch_failed": 1, "parse_failed": 1, "rejected": 2, "accepted": 6, "primary": 6, "secondary": 0, "planned_inserts": 6}
    for bad in (stage(5, 0, 0, 5), stage(0, 3, 0, 7), stage(0, 0, 0, 0)):
        with pytest.raises(Refused):
            runs.commit_run(log, after, 0, runs.event_counters(bad), "bad")
    with pytest.raises(Conflict):
        runs.commit_run(log, after, -1, good, "late")
    assert log.versions() == [0]


def test_city_scope_folds_names(spark):
    cities = spark.createDataFrame([(1, "RS", "Niš", True), (2, "RS", "Novi Sad", True), (3, "HR", "Split", True), (4, "RS", "Beograd", False)], "city_id int, country string, city string, enabled boolean")
    chosen = lambda *a: {r.city_id for r in config.in_scope(cities, *a).collect()}
    assert chosen() == {1, 2, 3} and chosen(("rs",)) == {1, 2} and chosen((), ("NIŠ", "novi-sad", "Beograd")) == {1, 2} and chosen(("HR",), ("Niš",)) == set()


def test_pages_of_one_file_are_dealt_out(spark, tmp_path):
    """Pages are made and parsed in as many tasks as the session has, though their table is one small file."""
    from placemark.plans import run_queries

    spark.range(50).selectExpr("id as c_custkey", "'Customer' as c_name", "cast(id % 2 as int) as c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(2).selectExpr("cast(id as int) as n_nationkey", "'town' as n_name").coalesce(1).write.parquet(f"{tmp_path}/nation.parquet")
    _, fetched = run_queries._fetched(spark, str(tmp_path))
    assert fetched.count() == 50 and fetched.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
