"""Token ids packed into fixed-length rows by best-fit decreasing.

Every task encodes its own documents, splits those longer than a row without
loss, and packs blocks of at most block_docs documents: pieces by falling
length, each into the fullest row that still holds it. A segment tree over the
free capacities finds that row in log(capacity) steps. Nothing is shuffled and
memory is bounded by a block, so packing runs at the speed of encoding; the
rows of a block depend on its documents alone, and a lost task repeats itself.

A packed row holds: shard and row (its place), ids (little-endian, 2 bytes an id
for vocabularies up to 65,536, else 4), cu_seqlens (cumulative segment lengths
from 0), position_resets (offsets at which positions start over), doc_ids and
piece_starts (the segments' documents and token offsets in them).

Defined results: null and empty texts have no tokens and take no place; repeated
rows are packed each for itself; a null id is kept as null; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.llm.token_counts import default_model, encode_unit, pre_tokens, processor, splits_at_spaces

SCHEMA = (
    "shard long, row long, n_tokens int, n_segments int, ids binary, cu_seqlens array<int>, "
    "position_resets array<int>, doc_ids array<long>, piece_starts array<long>"
)


class Encodings(dict):
    """Pre-tokens' ids as bytes, encoded when first asked for; short ones are remembered, up to a bound."""

    def __init__(self, sp, kind: type, cache: int):
        super().__init__()
        self.sp, self.kind, self.cache = sp, kind, cache

    def __missing__(self, unit: str) -> bytes:
        ids = np.array(encode_unit(self.sp, unit), self.kind).tobytes()
        if len(unit) <= 64:
            if len(self) >= self.cache:
                self.clear()
            self[unit] = ids
        return ids


class CapacityTree:
    """A segment tree over capacities 0..size: which has an open row, and the least such at or above a need."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        k = capacity + self.leaves
        while k and not self.any[k]:
            self.any[k] = 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) of the tightest row that holds need."""
        k = need + self.leaves
        if not self.any[k]:
            while k > 1 and (k & 1 or not self.any[k ^ 1]):
                k >>= 1
            if k <= 1:
                return None
            k ^= 1
            while k < self.leaves:
                k = 2 * k if self.any[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            self.any[k] = 0
            k >>= 1
            while k and not (self.any[2 * k] or self.any[2 * k + 1]):
                self.any[k] = 0
                k >>= 1
        return capacity, row


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Rows of piece numbers; every length is from 1 to size."""
    rows: list[list[int]] = []
    tree = CapacityTree(size)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[piece])
        if found is None:
            found = size, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(piece)
        if capacity > lengths[piece]:
            tree.add(capacity - lengths[piece], row)
    return rows


def pack(
    docs: DataFrame,
    row_tokens: int = 4096,
    model_path: str | None = None,
    block_docs: int = 4096,
    block_tokens: int = 4_000_000,
    cache: int = 300_000,
) -> DataFrame:
    """The packed rows (SCHEMA) of every document's tokens."""
    path = model_path or default_model()
    whole = not splits_at_spaces(processor(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(path)
        kind = np.uint16 if sp.vocab_size() <= 1 << 16 else np.uint32
        known = Encodings(sp, kind, cache)
        shard, written = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def encoded(text: str) -> np.ndarray:
            units = None if whole else pre_tokens(text)
            if units is None:
                return np.array(sp.encode(text, num_threads=1), kind)
            return np.frombuffer(b"".join(map(known.__getitem__, units)), kind)

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal written, size
            pieces = [(d, at, ids[at : at + row_tokens]) for d, ids in held for at in range(0, len(ids), row_tokens)]
            rows = best_fit_decreasing([len(p[2]) for p in pieces], row_tokens)
            for at in range(0, len(rows), 500):
                own = rows[at : at + 500]
                ends = [np.cumsum([len(pieces[p][2]) for p in r]).tolist() for r in own]
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard] * len(own), pa.int64()),
                        "row": pa.array(range(written, written + len(own)), pa.int64()),
                        "n_tokens": pa.array([e[-1] for e in ends], pa.int32()),
                        "n_segments": pa.array(map(len, own), pa.int32()),
                        "ids": pa.array([b"".join(pieces[p][2].tobytes() for p in r) for r in own], pa.binary()),
                        "cu_seqlens": pa.array([[0, *e] for e in ends], pa.list_(pa.int32())),
                        "position_resets": pa.array([[0, *e[:-1]] for e in ends], pa.list_(pa.int32())),
                        "doc_ids": pa.array([[pieces[p][0] for p in r] for r in own], pa.list_(pa.int64())),
                        "piece_starts": pa.array([[pieces[p][1] for p in r] for r in own], pa.list_(pa.int64())),
                    }
                )
                written += len(own)
            held.clear()
            size = 0

        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if t:
                    held.append((d, encoded(t)))
                    size += len(held[-1][1])
                if len(held) >= block_docs or size >= block_tokens:
                    yield from block()
        yield from block()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, model_path: str | None = None) -> DataFrame:
    """(doc_id, piece_start, ids) of every segment: the inverse of pack, piece by piece."""
    width = F.lit(2 if processor(model_path or default_model()).vocab_size() <= 1 << 16 else 4)
    segment = F.posexplode(F.arrays_zip("doc_ids", "piece_starts", F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("ends"), F.col("position_resets").alias("starts")))
    return packed.select("ids", segment.alias("k", "s")).select(
        F.col("s.doc_ids").alias("doc_id"),
        F.col("s.piece_starts").alias("piece_start"),
        F.substring("ids", F.col("s.starts") * width + 1, (F.col("s.ends") - F.col("s.starts")) * width).alias("ids"),
    )


def padded(packed: DataFrame, row_tokens: int = 4096, pad: int = 0, model_path: str | None = None) -> DataFrame:
    """The rows with ids filled up to row_tokens by the pad id, so that they make a matrix; n_tokens tells where filling starts."""
    wide = processor(model_path or default_model()).vocab_size() > 1 << 16
    fill = pad.to_bytes(4 if wide else 2, "little") * row_tokens
    width = len(fill)
    whole = F.substring(F.concat("ids", F.lit(bytearray(fill))), 1, width)
    return packed.withColumn("ids", whole)


def write_packed(packed: DataFrame, path: str, row_tokens: int = 4096, pad: int = 0, model_path: str | None = None) -> None:
    """Write the matrix of padded ids and its index (cumulative segment lengths, position resets) as Parquet."""
    padded(packed, row_tokens, pad, model_path).write.mode("errorifexists").parquet(path)
