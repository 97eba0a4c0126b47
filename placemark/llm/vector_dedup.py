"""Embedding near-dedup: Euclidean p-stable hashing of normalised vectors, exact cosine checks.

Vectors of one label link where their cosine is at least `cosine`. Equal vectors of a
label form one class, told by two 64-bit hashes, so copies cost nothing. Each class's
normalised vector gets a bucket in every table: WIDE-quantised random projections, so
many that strangers fill some FILL places of a bucket, in so many tables that a pair
right at the threshold misses all with the chance MISS. Both follow from the size of the
largest label, by formula.

Tables are worked off a few at a time, so that what is shuffled stays small. Only the
bucket and a sketch of 64 signs travel at first; vectors follow for those that have a
likely partner in a bucket. A bucket with more than `block` classes is cut into blocks
that meet in pairs, in tasks of their own. A pair's links are counted in the first table
that brings it together, so that none is counted twice; a meeting emits a row for each
vector, never its pairs.

Defined results: null, zero and non-finite vectors, and those with a null component or
label, link with nothing, as do vectors of different lengths; rows that repeat a vec_id
are vectors of their own; a null vec_id is never the smallest, and a component without
any other is null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.llm.common import components, discard, meet, stored
from placemark.llm.hashing import mix

COSINE = 0.93
#: The cell of a projection; strangers in a bucket; the chance that a pair at the threshold is missed.
WIDE, FILL, MISS = 2.5, 256, 1e-4
#: Tables a pass; classes of a bucket that meet in one task.
A_PASS, BLOCK = 4, 1024
SIGNS = 64
_SEED = 1301


def collide(distance: float, wide: float = WIDE) -> float:
    """The chance that one quantised projection puts two points at that distance into one cell."""
    r = wide / distance
    below = math.erf(r / math.sqrt(2)) / 2 + 0.5
    return 1 - 2 * (1 - below) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """(projections of a bucket, tables) for so many vectors of a label."""
    near, far = collide(math.sqrt(2 - 2 * cosine)), collide(math.sqrt(2))
    projections = max(4, math.ceil(math.log(max(rows, FILL) / FILL) / -math.log(far)))
    return projections, math.ceil(math.log(miss) / math.log(1 - near**projections))


def sketch_reach(cosine: float, miss: float = MISS) -> int:
    """Signs that two vectors at the threshold may differ in, but for a chance of miss."""
    p = math.acos(cosine) / math.pi
    tail, k = 1.0, -1
    while tail > miss:
        k += 1
        tail -= math.comb(SIGNS, k) * p**k * (1 - p) ** (SIGNS - k)
    return k


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by powers of two first, so that no square overflows."""
    x = vectors.astype(np.float64)
    _, power = np.frexp(np.abs(x).max(axis=1, initial=0))
    x = np.ldexp(x, -power[:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _placed(projections: int, tables: int):
    """node, label, vector -> node, sketch, bucket in every table."""
    made: dict[int, tuple] = {}

    def family(dims: int) -> tuple:
        if dims not in made:
            r = np.random.default_rng((_SEED, dims))
            made[dims] = r.standard_normal((dims, projections * tables)), r.uniform(0, WIDE, projections * tables), r.standard_normal((dims, SIGNS))
        return made[dims]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            flat = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)])
            labels = mix(batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            sketch, buckets = np.zeros(len(sizes), np.uint64), np.zeros((len(sizes), tables), np.uint64)
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                x = normalised(flat[starts[at][:, None] + np.arange(dims)])
                a, b, signs = family(int(dims))
                sketch[at] = ((x @ signs > 0).astype(np.uint64) << np.arange(SIGNS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
                cells = np.floor((x @ a + b) / WIDE).astype(np.int64).view(np.uint64).reshape(len(at), tables, projections)
                h = mix(labels[at][:, None] + np.arange(tables, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(dims))
                for k in range(projections):
                    h = mix(h ^ mix(cells[:, :, k] + np.uint64(k + 1)))
                buckets[at] = h
            out = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * tables, pa.array(buckets.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sketch.view(np.int64)), out], names=["node", "sketch", "buckets"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list]:
    """The columns after the keys of every run of equal keys, in order."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        edge = np.flatnonzero(np.logical_or.reduce([n[1:] != n[:-1] for n in names])) + 1
        for a, z in zip(np.concatenate([[0], edge]), np.append(edge, batch.num_rows), strict=True):
            key = tuple(n[a] for n in names)
            part = pa.Table.from_batches([batch.slice(a, z - a)])
            if key == now:
                held.append(part)
            else:
                if held:
                    yield pa.concat_tables(held).combine_chunks()
                now, held = key, [part]
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy(zero_copy_only=False)


def _apart(side: np.ndarray, both: bool, a: slice, b: slice) -> np.ndarray:
    """Which of the pairs a x b this meeting is for: any within a block, else one of each block."""
    return side[a][:, None] != side[b][None] if both else np.ones((a.stop - a.start, b.stop - b.start), bool)


def _slices(n: int, step: int = 512) -> list[slice]:
    return [slice(k, min(k + step, n)) for k in range(0, n, step)]


def _likely(reach: int):
    """bucket, low, high, node, block, sketch, in order of the first three -> the rows with a likely partner in their meeting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            sketch, side = _column(group, "sketch").view(np.uint64), _column(group, "block")
            both = group.column("low")[0].as_py() != group.column("high")[0].as_py()
            hit = np.zeros(len(sketch), bool)
            parts = _slices(len(sketch))
            for i, a in enumerate(parts):
                for b in parts[i:]:
                    near = (np.bitwise_count(sketch[a][:, None] ^ sketch[b][None]) <= reach) & _apart(side, both, a, b)
                    if a is b:
                        np.fill_diagonal(near, False)
                    hit[a] |= near.any(axis=1)
                    hit[b] |= near.any(axis=0)
            if hit.any():
                yield from group.drop_columns(["sketch"]).filter(pa.array(hit)).to_batches()

    return run


def _linked(cosine: float):
    """bucket, low, high, place, node, block, n, vector, buckets in order of the first three -> node, links, least: how
    many vectors each one is linked with here for the first time, and the least node it is connected with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            if len(group) < 2:
                continue
            node, n, side = _column(group, "node"), _column(group, "n"), _column(group, "block")
            x = normalised(np.array(group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(node), -1))
            place = group.column("place")[0].as_py()
            buckets = np.array(group.column("buckets").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(len(node), -1)[:, :place]
            both = group.column("low")[0].as_py() != group.column("high")[0].as_py()
            links, root = np.zeros(len(node), np.int64), np.arange(len(node))
            found = []
            parts = _slices(len(node))
            for i, a in enumerate(parts):
                for b in parts[i:]:
                    near = (x[a] @ x[b].T >= cosine) & _apart(side, both, a, b)
                    if a is b:
                        near = np.triu(near, 1)
                    p, q = np.nonzero(near)
                    p, q = p + a.start, q + b.start
                    found.append((p, q))
                    for s in _slices(len(p), 1 << 16):
                        new = ~(buckets[p[s]] == buckets[q[s]]).any(axis=1)
                        np.add.at(links, p[s][new], n[q[s][new]])
                        np.add.at(links, q[s][new], n[p[s][new]])
            p, q = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            while True:  # the least connected place spreads, by its own root too
                before = root.copy()
                np.minimum.at(root, p, root[q])
                np.minimum.at(root, q, root[p])
                root = root[root]
                if (root == before).all():
                    break
            met = np.unique(np.concatenate([p, q]))
            yield pa.RecordBatch.from_arrays([pa.array(node[met]), pa.array(links[met]), pa.array(node[root[met]])], names=["node", "links", "least"])

    return run


def linked_vectors(vectors: DataFrame, cosine: float = COSINE, miss: float = MISS, a_pass: int = A_PASS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, label, embedding)."""
    e = F.col("embedding")
    whole = F.coalesce(F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf"))) & F.exists(e, lambda v: v != 0), F.lit(False))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e)
    fit = own.where(whole & F.col("label").isNotNull())
    key = (F.xxhash64("label", "embedding").alias("k1"), F.xxhash64(F.lit(_SEED), F.reverse("embedding"), "label").alias("k2"))
    classes = fit.select("*", *key).groupBy("k1", "k2").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("vector"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors-classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    projections, tables = plan(largest, cosine, miss)
    placed = classes.select("node", "label", "vector").mapInArrow(_placed(projections, tables), "node long, sketch long, buckets array<long>")
    placed = stored(placed, "vectors-buckets")

    links = None
    for start in range(0, tables, a_pass):
        places = F.posexplode(F.slice("buckets", start + 1, a_pass)).alias("at", "bucket")
        rows = placed.select("node", "sketch", places)
        sizes = stored(rows.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("at") + start).cast("int").alias("place")).where("n > 1"), "vectors-sizes")
        met = meet(rows.select("node", "sketch", "bucket"), sizes, ["bucket"])
        blocks = F.ceil(F.col("n") / block)
        met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        met = met.select("bucket", F.least("block", "other").cast("int").alias("low"), F.greatest("block", "other").cast("int").alias("high"), "place", "node", "block", "sketch")
        group = ["bucket", "low", "high"]
        likely = met.repartition(*group).sortWithinPartitions(*group)
        likely = stored(likely.mapInArrow(_likely(sketch_reach(cosine)), "bucket long, low int, high int, place int, node long, block int"), "vectors-likely")
        bytes_ = classes.select("node", "n", "vector").join(placed.select("node", F.slice("buckets", 1, start + a_pass).alias("buckets")), "node")
        pairs = likely.join(bytes_, "node").select(*group, "place", "node", "block", "n", "vector", "buckets")
        pairs = pairs.repartition(*group).sortWithinPartitions(*group)
        found = stored(pairs.mapInArrow(_linked(cosine), "node long, links long, least long"), "vectors-links")
        discard(sizes, likely)
        links = found if links is None else links.union(found)
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(links.select(F.col("node").alias("a"), F.col("least").alias("b")), "vectors-components")
    known = classes.select("k1", "k2", "n", "node", "least_id").join(counted, "node", "left").join(group, "node", "left")
    known = known.withColumns({"component": F.coalesce("component", "node"), "n_links": F.coalesce("links", F.lit(0)) + F.col("n") - 1})
    smallest = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = stored(known.join(smallest, "component").select("k1", "k2", "n", "n_links", "component_id"), "vectors-known")
    out = meet(fit.select("vec_id", *key), known, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    rest = own.where(~whole | F.col("label").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
