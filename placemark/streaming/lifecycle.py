"""The miss ladder between runs: as a batch over the whole state, and as keyed state of a stream of runs.

In the stream a key's state is written only when a run sees the key or a rung of the
ladder is due, by an event-time timer: healthy runs are numbered, a run's number is its
event time, and how often a key was missed follows from the number it was last seen in.
An unhealthy run - failed, or too small beside what is stored - gets no number, so it
moves nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from placemark.operators.commit_log import CommitLog
from placemark.operators.reconcile import GONE, LEAST_SEEN, MISSING, STALE, snapshot_guard, status_after, transition

STORED = ("key", "kind", "source_status", "misses", "frozen", "cancelled")
STATE = "kind string, source_status string, misses int, frozen boolean, cancelled boolean, run long"
STEPS = (STALE, MISSING, GONE)
RUNGS = tuple(zip(STEPS, ("stale", "missing", "gone"), strict=True))
#: Runs that may wait to be carried into the state; take() carries each at once.
RECENT = 100
_PROVIDER = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def guard(state: DataFrame, seen: DataFrame, failed_refs: int = 0, least_seen: float = LEAST_SEEN) -> DataFrame:
    """One row (baseline, seen, healthy) of a run over the stored keys: a failed part or a collapsed result closes nothing."""
    there = seen.select("key", F.lit(True).alias("there")).distinct()
    marked = state.join(there, "key", "left").withColumn("seen", F.coalesce("there", F.lit(False)))
    return snapshot_guard(marked, F.lit(failed_refs), least_seen)


def advance(state: DataFrame, seen: DataFrame, healthy: DataFrame) -> DataFrame:
    """The state table (key, kind, source_status, misses, frozen, cancelled) after one run; unchanged by an unhealthy one."""
    marked = state.join(seen.select("key", F.lit(True).alias("there")).distinct(), "key", "left").withColumn("seen", F.coalesce("there", F.lit(False)))
    step = transition(F.col("kind"), F.col("source_status"), F.col("misses"), F.col("seen"), F.col("frozen"), F.col("cancelled"))
    moved = marked.join(F.broadcast(healthy.select("healthy"))).withColumn("step", F.when(F.col("healthy"), step))  # one row
    return moved.select(
        "key", "kind", F.coalesce(status_after(F.col("step.action"), F.col("source_status")), "source_status").alias("source_status"),
        F.coalesce("step.misses", "misses").alias("misses"), "frozen", "cancelled",
    )


def aged(state: DataFrame, run: int) -> DataFrame:
    """Stored rows with the number of the run they were written in, as they stand after a later one: unseen since."""
    held = F.col("frozen") | F.col("cancelled") | (F.col("source_status") == "gone") | (F.col("run") >= run)
    # The ladder stops at its last rung, or at the first run after it.
    last = F.greatest(F.lit(GONE), F.col("misses") + 1)
    misses = F.least(F.col("misses") + F.lit(run) - F.col("run"), last)
    status = F.when(misses >= GONE, "gone").when(misses >= MISSING, "missing").when(misses >= STALE, "stale").otherwise("active")
    return state.withColumns({"source_status": F.when(held, F.col("source_status")).otherwise(status), "misses": F.when(held, F.col("misses")).otherwise(misses).cast("int")})


class Ladder(StatefulProcessor):
    """One key's state: (kind, status, misses, frozen, cancelled, run it was written in), and a timer for the next rung."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ladder", STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N803  the interface's names
        r = initialState
        self._write(r.kind, r.source_status, r.misses, r.frozen, r.cancelled, 0)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N803
        runs = sorted({r.run for r in rows})
        for run in runs:
            if not self.state.exists():
                return
            kind, status, misses, frozen, cancelled, wrote = self.state.get()
            if run <= wrote or frozen or cancelled:
                continue
            missed, now = self._missed(status, misses, run - 1 - wrote)
            if now == "gone" and kind != "venue":
                continue  # an event that is gone stays so; its timer tells when
            self._write(kind, "active", 0, frozen, cancelled, run)
            if status != "active" or now != "active":
                yield Row(key=key[0], run=run, source_status="active", misses=0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        kind, status, misses, frozen, cancelled, wrote = self.state.get()
        run = expiredTimerInfo.getExpiryTimeInMs() // 1000
        misses, now = self._missed(status, misses, run - wrote)
        self._write(kind, now, misses, frozen, cancelled, run)
        if now != status:
            yield Row(key=key[0], run=run, source_status=now, misses=misses)

    def close(self) -> None:
        pass

    @staticmethod
    def _missed(status: str, misses: int, runs: int) -> tuple[int, str]:
        if status == "gone" or runs <= 0:
            return misses, status
        misses = min(misses + runs, max(GONE, misses + 1))
        return misses, next((name for step, name in reversed(RUNGS) if misses >= step), "active")

    def _write(self, kind: str, status: str, misses: int, frozen: bool, cancelled: bool, run: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.update((kind, status, misses, frozen, cancelled, run))
        if not (frozen or cancelled or status == "gone"):
            rung = next((step for step, _ in RUNGS if step > misses), misses + 1)
            self.handle.registerTimer((run + rung - misses) * 1000)


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in _PROVIDER}
    for k, v in _PROVIDER.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class LifecycleStream:
    """Runs of one source, one after another, over keyed state in `folder`.

    Accepted runs are versions of a commit log, so a run is numbered once however often
    it is tried. changes() are the status changes that came of them; a key's misses are
    told with the run after which they are known. One process at a time takes runs.
    """

    def __init__(self, spark: SparkSession, folder: str, stored: DataFrame | None = None):
        """stored: the rows (STORED) that the first run met; the same at every start."""
        self.spark, self.folder, self.stored = spark, folder.rstrip("/"), stored
        self.log = CommitLog(spark, f"{self.folder}/runs")

    def state(self) -> DataFrame:
        """Every stored row as it stands after the last accepted run."""
        run = self.log.current() + 1
        return aged(self._written(), run).select(*STORED)

    def _written(self) -> DataFrame:
        if self.log.current() < 0:
            return self.stored.select(*STORED, F.lit(0).cast("long").alias("run"))
        kept = self.spark.read.format("statestore").option("stateVarName", "ladder").load(f"{self.folder}/state")
        return kept.select(F.col("key.key").alias("key"), "value.*")

    def changes(self) -> DataFrame:
        return self.spark.read.schema("key string, run long, source_status string, misses int").parquet(f"{self.folder}/changes")

    def take(self, seen: DataFrame, run_id: str, failed_refs: int = 0, least_seen: float = LEAST_SEEN) -> bool:
        """Judge a run's seen keys against the state and let it move the ladder; whether it did."""
        self._drain()
        taken = self.log.current()
        if taken >= 0 and self.log.manifest(taken)["note"].get("run_id") == run_id:
            return True
        verdict = guard(self.state(), seen, failed_refs, least_seen).first()
        if not verdict.healthy:
            return False
        run = taken + 2
        token = uuid.uuid4().hex
        rows = seen.where("key is not null").select(F.col("key").cast("string"), F.lit(run).cast("long").alias("run"), F.lit(token).alias("token")).distinct()
        self.log.commit(rows, taken, note={"run_id": run_id, "token": token, "baseline": verdict.baseline, "seen": verdict.seen})
        self._drain()
        return True

    def _drain(self) -> None:
        """Carry accepted runs that the state has not had yet into it."""
        if self.log.current() < 0:
            return
        with _rocksdb(self.spark):
            # A run is a version; rows that a writer left behind without publishing them have no version's token.
            tokens = [self.log.manifest(v)["note"]["token"] for v in self.log.versions()[-RECENT:]]
            rows = self.spark.readStream.schema("key string, run long, token string").option("maxFilesPerTrigger", 1_000_000).parquet(f"{self.folder}/runs/data/*")
            timed = rows.where(F.col("token").isin(tokens)).withColumn("at", F.timestamp_seconds("run")).withWatermark("at", "0 seconds")
            start = self.stored.select(F.col("key").cast("string"), *STORED[1:]).groupBy("key") if self.stored is not None else None
            moved = timed.groupBy("key").transformWithState(Ladder(), "key string, run long, source_status string, misses int", "append", "EventTime", initialState=start)
            query = moved.writeStream.format("parquet").option("path", f"{self.folder}/changes").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
            query.awaitTermination()


def run_stream(seen: DataFrame, ladder: LifecycleStream):
    """A stream whose every micro-batch is one run's seen keys."""
    return seen.writeStream.foreachBatch(lambda batch, number: ladder.take(batch, str(number)))
