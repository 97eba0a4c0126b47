"""Phrase collocation mining: n-gram counts from word-id suffix arrays, merged by key.

A task gathers the words of a language into shards of numbers and sorts each shard's
suffixes by prefix doubling; the stretches of the order whose neighbours agree in n words
(LCP intervals) are its n-grams and their counts. Counts are merged over all shards by
language and phrase.

Three rounds, shortest first: an n-gram occurs `least` times only if its parts do. A
round passes a bitmap of the parts that do on to the next one, whose shards break at
words, and leave out positions, that are not in it. The bitmap has BITS bits whatever the
corpus, so it may let too much through but never too little: counts of what it lets
through are whole.

Defined results: a null text has no words, a null lang is 'und'; phrases never cross a
piece's or a text's end; rows that repeat a doc_id are texts of their own; a language
whose words are all rare has no phrases; an empty table gives an empty result; extra
columns are ignored. Exact while counts stay below 10^15.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placemark.llm.common import meet, stored
from placemark.llm.hashing import mix

LEAST, KEPT = 10, 2000
#: Words of a shard; bits of a bitmap of frequent words or pairs.
SHARD, BITS = 1 << 20, 1 << 26
_BREAK = b"\xff"  # in no UTF-8 text
_PIECES = bytes(0xFF if b in b".,;:!?" or 0x0A <= b <= 0x0D else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with a break between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_PIECES).replace(_BREAK, b" \xff ").split() if text else []


class Numbers(dict):
    """Numbers words as they come; the break is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def suffix_order(ids: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions `at` in the order of their suffixes' first `depth` words, and for each how many
    of these it shares with the one before. Past the end of ids come breaks."""
    ranks = [ids.astype(np.int64)]
    width = 1
    while width < depth:
        last = ranks[-1]
        ahead = np.zeros_like(last)
        ahead[: max(len(last) - width, 0)] = last[width:]
        _, doubled = np.unique(last * (last.max(initial=0) + 1) + ahead, return_inverse=True)
        ranks.append(doubled.astype(np.int64))
        width *= 2
    order = at[np.argsort(ranks[-1][at], kind="stable")]
    shared = np.zeros(len(order), np.int64)
    x, y = order[:-1].copy(), order[1:].copy()
    agree = np.ones(len(x), bool)
    for rank, step in zip(reversed(ranks), (1 << k for k in reversed(range(len(ranks)))), strict=True):
        # As in a binary descent: take the step where the ranks of that width agree.
        inside = np.maximum(x, y) < len(ids)
        agree = inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 0)])
        shared[1:] += np.where(agree, step, 0)
        x, y = x + np.where(agree, step, 0), y + np.where(agree, step, 0)
    return order, np.minimum(shared, depth)


def gram_counts(ids: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(a start, the count) of each n-gram that starts at one of the positions: the LCP intervals of n words."""
    order, shared = suffix_order(ids, at, n)
    first = np.flatnonzero(shared < n)
    return order[first], np.diff(np.append(first, len(order)))


def hashes_of(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF
    return np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) for w in words), np.uint64, len(words))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _PAIR + right)


class Bitmap:
    def __init__(self, raw: np.ndarray):
        self.raw = raw

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes % np.uint64(len(self.raw) * 64)
        return (self.raw[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def counted_shard(lang: str, words: list[bytes], ids: np.ndarray, n: int, bitmap: Bitmap | None) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """(phrases, counts) of a shard's n-grams whose parts the bitmap holds."""
    good = ids > 0
    if n > 1:
        hashes = hashes_of(words, lang)
        if n == 2:
            fine = bitmap.has(hashes)
            fine[0] = False
            ids = np.where(fine[ids], ids, 0)
            good = ids > 0
            good[:-1] &= ids[1:] > 0
            good[-1:] = False
        else:
            pair = np.zeros(len(ids), bool)
            pair[:-1] = (ids[:-1] > 0) & (ids[1:] > 0) & bitmap.has(joined(hashes[ids[:-1]], hashes[ids[1:]]))
            good = pair.copy()
            good[:-1] &= pair[1:]
            good[-1:] = False
    start, count = gram_counts(ids, np.flatnonzero(good), n)
    for a in range(0, len(start), 50_000):
        columns = [[words[i] for i in ids[start[a : a + 50_000] + k].tolist()] for k in range(n)]
        yield [b" ".join(p) for p in zip(*columns, strict=True)] if n > 1 else columns[0], count[a : a + 50_000]


def _counts(n: int, bitmap, size: int):
    """lang, text -> lang, phrase, count of the n-grams of every shard."""

    def batches_of(lang: str, numbers: Numbers, runs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = counted_shard(lang, list(numbers), np.concatenate(runs), n, Bitmap(bitmap.value) if bitmap else None)
        for phrases, count in found:
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(count, pa.int64())], names=["lang", "phrase", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Numbers, list, list[int]]] = {}
        total = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if not words:
                    continue
                if lang not in held:
                    held[lang] = (Numbers(), [], [0])
                numbers, runs, own = held[lang]
                words.append(_BREAK)
                runs.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                own[0] += len(words)
                total += len(words)
                if own[0] >= size:
                    total -= own[0]
                    yield from batches_of(lang, numbers, runs)
                    del held[lang]
                elif total >= 2 * size:  # many languages
                    for other, (theirs, parts, _) in held.items():
                        yield from batches_of(other, theirs, parts)
                    held, total = {}, 0
        for lang, (numbers, runs, _) in held.items():
            yield from batches_of(lang, numbers, runs)

    return run


def _bits(bits: int):
    """lang, phrase of one or two words -> the bit of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = hashes_of(phrase.encode("utf-8", "surrogatepass").split(b" "), lang)
                out.append(int((h[0] if len(h) == 1 else joined(h[:1], h[1:])[0]) % np.uint64(bits)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["bit"])

    return run


def bitmap_of(phrases: DataFrame, bits: int):
    """A broadcast bitmap of the phrases; its size is that of bits, not of the table."""
    found = phrases.select("lang", "phrase").mapInArrow(_bits(bits), "bit long")
    longs = found.groupBy(F.expr("bit div 64").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 64))")).alias("bits")).toArrow()
    raw = np.zeros(bits // 64, np.uint64)
    raw[longs.column("at").to_numpy()] = longs.column("bits").to_numpy().view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(raw)


def _frequent(docs: DataFrame, n: int, least: int, size: int, bitmap) -> DataFrame:
    grams = docs.mapInArrow(_counts(n, bitmap, size), "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    if n == 1:  # the words' total a language comes with the rare ones
        grams = grams.groupBy("lang", F.when(F.col("a") >= least, F.col("phrase")).alias("phrase")).agg(F.sum("a").alias("a"))
        return stored(grams, "phrases-1")
    return stored(grams.where(F.col("a") >= least), f"phrases-{n}")


def phrases(docs: DataFrame, least: int = LEAST, kept: int = KEPT, shard: int = SHARD, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `kept` phrases of two and three words of each language."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    all_words = _frequent(own, 1, least, shard, None)
    n = all_words.groupBy("lang").agg(F.sum("a").alias("words"))
    words = all_words.where("phrase is not null")
    pairs = _frequent(own, 2, least, shard, bitmap_of(words, bits))
    triples = _frequent(own, 3, least, shard, bitmap_of(pairs, bits))

    # The parts of every cut, looked up once; a part that very many phrases have stays in place.
    split = F.split("phrase", " ")
    cut = lambda k, m: F.concat_ws(" ", F.slice(split, k, m))
    grams = pairs.withColumn("parts", F.array(cut(1, 1), cut(2, 1))).union(triples.withColumn("parts", F.array(cut(1, 1), cut(2, 2), cut(1, 2), cut(3, 1))))
    asked = stored(grams.select("lang", "phrase", "a", F.posexplode("parts").alias("slot", "part")), "phrases-parts")
    freq = words.union(pairs).select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    side = stored(asked.groupBy("lang", "part").agg(F.count("*").alias("n")).join(freq, ["lang", "part"]), "phrases-asked")
    slot = lambda k: F.max(F.when(F.col("slot") == k, F.col("f")))
    cuts = meet(asked, side, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*(slot(k).alias(f"f{k}") for k in range(4)))
    score = lambda l, r: F.expr(f"(1000000BD * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast({l} as decimal(15,0)) * cast({r} as decimal(15,0)))")
    cuts = cuts.withColumns({"s1": score("f0", "f1"), "s2": F.when(F.col("f2").isNotNull(), score("f2", "f3"))})
    late = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    scored = cuts.select("lang", "phrase", "a", F.when(late, F.col("f2")).otherwise(F.col("f0")).alias("l"), F.when(late, F.col("f3")).otherwise(F.col("f1")).alias("r"), F.when(late, F.col("s2")).otherwise(F.col("s1")).alias("score"))
    inside = triples.select("lang", F.explode(F.array_distinct(F.array(cut(1, 2), cut(2, 2)))).alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").where("longer is null or longer * 2 < a").drop("longer")
    # A language's first ones come from the first ones of its parts, so that no task ranks a whole language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    rank = lambda *keys: F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    parts = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", rank("lang", "part")).where(F.col("rank") <= kept)
    best = parts.withColumn("rank", rank("lang").cast("long")).where(F.col("rank") <= kept)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
