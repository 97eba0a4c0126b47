"""Line dedup: repeated multi-line chunks with content-defined boundaries.

A rolling hash runs over the hashes of WINDOW lines; where it divides by EVERY
a chunk of two lines or more ends, so boundaries move with the lines and an
insertion shifts only the chunk it falls in. A chunk of two or more lines with
words that occurs more than once in all documents is kept where it comes first -
by doc_id, then place in the text - and removed elsewhere. Hashes find the
candidates; chunks are taken as equal only where their bytes are.

Hashes alone are shuffled at first; the bytes follow for chunks whose hash
repeats, and each task reduces equal ones to one before. Bytes are compared by
their least and greatest under a hash and digest: where they differ, nothing is
removed. The rows of a very frequent chunk are never gathered.

Defined results: a null text is returned as null with no lines, an empty one as
one empty line; of rows equal in doc_id (or without one) and text, which nothing
tells apart, one is the first and the others lose all their chunks of two or
more lines with words; a null doc_id comes first; a text whose chunks all go becomes
empty; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.llm.common import discard, meet, multiplied, one_of_equal, row_key, stored

WINDOW, EVERY, LEAST = 2, 4, 2
_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15


def chunk_ends(lines: list[bytes]) -> list[int]:
    """The ends (exclusive) of a text's chunks, in lines."""
    hashes, ends, since, rolling = [], [], 0, 0
    out_step = pow(_STEP, WINDOW, 1 << 64)
    for i, line in enumerate(lines):
        h = xxhash.xxh3_64_intdigest(line)
        hashes.append(h)
        rolling = (rolling * _STEP + h - (hashes[i - WINDOW] * out_step if i >= WINDOW else 0)) & _MASK
        mixed = (rolling ^ (rolling >> 31)) * 0x94D049BB133111EB & _MASK
        if (mixed >> 33) % EVERY == 0 and i + 1 - since >= LEAST:
            ends.append(i + 1)
            since = i + 1
    if since < len(lines):
        ends.append(len(lines))
    return ends


def chunks(text: str | None) -> list[tuple[bytes, int, bool]]:
    """(bytes, lines, whether it may be removed) of each chunk."""
    if text is None:
        return []
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    out, at = [], 0
    for end in chunk_ends(lines):
        own = lines[at:end]
        out.append((b"\n".join(own), end - at, sum(1 for x in own if x.strip()) >= 2))
        at = end
    return out


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[xxhash.xxh3_64_intdigest(c) - (1 << 63) for c, _, may in chunks(t) if may] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["rid", "hashes"])


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for rid, doc_id, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            wanted = set(wanted)
            for k, (c, _, may) in enumerate(chunks(text)):
                if may and (h := xxhash.xxh3_64_intdigest(c) - (1 << 63)) in wanted:
                    out.append((rid, doc_id, k, h, xxhash.xxh64_intdigest(c, seed=1) - (1 << 63), c))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["rid", "doc_id", "k", "hash", "digest", "chunk"])


_LEFT = "doc_id long, n_lines long, n_chunks long, n_removed_chunks long, n_removed_lines long, text string, copies long"


def _kept(every: bool):
    """doc_id, text, gone, copies -> what is left without the chunks in gone, or without every one that may go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                all_chunks = chunks(text)
                gone = {k for k, (_, _, may) in enumerate(all_chunks) if may} if every else set(gone or ())
                left = [c for k, (c, _, _) in enumerate(all_chunks) if k not in gone]
                out.append((
                    sum(n for _, n, _ in all_chunks), len(all_chunks), len(gone),
                    sum(n for k, (_, n, _) in enumerate(all_chunks) if k in gone),
                    None if text is None else b"\n".join(left).decode("utf-8", "surrogatepass"),
                ))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            names = ["doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", "text", "copies"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)), batch.column(3)], names=names)

    return run


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines and the text that is left, of every row."""
    own = docs.select(row_key().alias("rid"), F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows = one_of_equal(own, "lines-copies")
    once = rows.where("text is not null")
    found = stored(once.select("rid", "text").mapInArrow(_hashes, "rid long, hashes array<long>").select("rid", F.explode("hashes").alias("hash")), "lines-hashes")
    again = stored(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "lines-again")
    wanted = meet(found, again, ["hash"]).groupBy("rid").agg(F.collect_set("hash").alias("wanted"))
    met = once.join(wanted.hint("merge"), "rid").select("rid", "doc_id", "text", "wanted")
    met = stored(met.mapInArrow(_wanted, "rid long, doc_id long, k int, hash long, digest long, chunk binary"), "lines-met")
    discard(found, again)
    place = F.struct("doc_id", "rid", "k")
    # Equal bytes: the least and the greatest under one hash and digest are the same.
    first = met.groupBy("hash", "digest").agg(F.min(place).alias("first"), F.min("chunk").alias("least"), F.max("chunk").alias("most"), F.count("*").alias("n"))
    first = stored(first.where("least = most and n > 1").select("hash", "digest", "first", "n"), "lines-first")
    gone = meet(met.drop("chunk"), first, ["hash", "digest"]).where(place > F.col("first")).groupBy("rid").agg(F.collect_set("k").alias("gone"))
    gone = stored(gone, "lines-gone")
    discard(met, first)
    first = rows.join(gone.hint("merge"), "rid", "left").select("doc_id", "text", "gone", "copies").mapInArrow(_kept(False), _LEFT)
    others = rows.where("copies > 1").select("doc_id", "text", F.lit(None).cast("array<int>").alias("gone"), "copies").mapInArrow(_kept(True), _LEFT)
    return first.unionByName(multiplied(others, F.col("copies") - 1)).drop("copies")
