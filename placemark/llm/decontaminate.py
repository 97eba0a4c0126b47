"""Benchmark decontamination by latent semantic retrieval.

Features are the benchmark's words, weighted by their inverse document frequency
over all documents; words in more than COMMON of the documents are left out
where an item has rarer ones. A randomised SVD of the TF-IDF passages gives the
latent space: tasks sum A'(A W) for a random W, the basis of that sum is made
orthogonal, and a second distributed sum gives the small matrix whose
eigenvectors turn it into the singular vectors. All passages of all documents
take part; the benchmark's own passages are added with the weight of ITEM_SHARE
of the whole, so that the space tells the items apart.

Every document is then cut into overlapping passages; those whose latent vector
has a cosine of at least COSINE with an item's are candidates, and so is every
place that has SHINGLE of an item's words in a row (words of no item left out),
whatever its cosine: no verbatim copy depends on the space. A candidate is
contaminated if the longest common subsequence of its words with the item's
covers COVERED of the item; or, for looser paraphrases, LOOSE of it together
with the item's answer (its last sentence) to ANSWER. Words are compared in lower case
without punctuation at their ends. The benchmark is the stated query set; texts
are read once for all of it, then it is worked off in blocks of item_block items,
no more than the space has dimensions, each against all rows.

Defined results: null or empty texts and items never match; a null item_id or
doc_id is returned as it is; rows that repeat a doc_id, or have none, give one
match an item, the best; an empty table on either side gives no matches; extra
columns are ignored. Where documents are removed, each row goes by itself.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from placemark.llm.common import stored

RANK, OVERSAMPLE, BLOCK, SPAN, SHINGLE = 256, 16, 32, 3, 3
COMMON, LEAST_FEATURES, ITEM_SHARE = 0.1, 8, 0.5
COSINE, COVERED, LOOSE, ANSWER = 0.4, 0.7, 0.62, 0.8
#: Longer segments are summed in pieces of so many rows.
SEGMENTS = 32
#: Sums of tasks that one task merges.
MERGED = 16
_ENDS = b".,;:!?\"'()[]{}"
#: What a byte is: 2 white space as bytes.split() has it, 1 punctuation, 0 the rest.
_KINDS = bytes(2 if c in b" \t\n\v\f\r" else 1 if c in _ENDS else 0 for c in range(256))
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
#: Characters of texts that are looked up at once.
AT_ONCE = 500_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation at the ends."""
    return [w for w in (x.strip(_ENDS) for x in text.lower().encode("utf-8", "surrogatepass").split()) if w] if text else []


class Sequence:
    """A word sequence that others are held against: for each of its words the bits of its places."""

    def __init__(self, words: list):
        self.words = len(words)
        self.places: dict = {}
        for i, w in enumerate(words):
            self.places[w] = self.places.get(w, 0) | 1 << i
        self.own = frozenset(self.places)

    def within(self, others: set) -> int:
        """No common subsequence with words of others is longer: each word that is missing there leaves a place empty."""
        return self.words - len(self.own - others)

    def hits(self, other: list) -> list[int]:
        """The places of the other's words that occur here; no common subsequence is longer than this list."""
        return list(filter(None, map(self.places.get, other)))

    def met(self, hits: list[int]) -> int:
        """How many words here occur in the other; no common subsequence is longer. Words have places of their own, so their bits add up."""
        return sum(set(hits)).bit_count()

    def lcs(self, hits: list[int]) -> int:
        """The length of the longest common subsequence."""
        row = full = (1 << self.words) - 1
        for m in hits:
            u = row & m
            row = ((row + u) | (row - u)) & full
        return self.words - row.bit_count()


def lcs(a: list, b: list) -> int:
    s = Sequence(a)
    return s.lcs(s.hits(b))


def answer_of(text: str) -> list[bytes]:
    """The words of the last sentence, or the last quarter of the words where that is short."""
    words = plain_words(text)
    last = [s for s in _SENTENCE.split(text.strip()) if plain_words(s)]
    own = plain_words(last[-1]) if last else []
    return own if len(own) >= max(3, len(words) // 4) and len(own) < len(words) else words[-max(3, len(words) // 4) :]


class Vocabulary:
    """The benchmark's words and their numbers, looked up for all tokens of some texts at once.

    Words of up to 16 bytes are in an open-addressed table, by their bytes as two whole numbers
    and their length, so a hit is exact; longer ones are met one by one.
    """

    def __init__(self, words: list[bytes]):
        self.number = {w: i for i, w in enumerate(words)}
        self.longest = max(map(len, words), default=0)
        bits = max(4, (4 * len(words)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.low, self.high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self.size, self.word = np.zeros(1 << bits, np.int64), np.full(1 << bits, -1, np.int32)
        short = [w for w in self.number if len(w) <= 16]
        low, high = np.frombuffer(b"".join(w.ljust(16, b"\0") for w in short), "<u8").reshape(-1, 2).T
        for w, k, a, b in zip(short, self.slots(low, high).tolist(), low, high, strict=True):
            while self.size[k]:
                k = (k + 1) % len(self.size)
            self.low[k], self.high[k], self.size[k], self.word[k] = a, b, len(w), self.number[w]

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return ((low * _MIX[0] ^ high * _MIX[1]) * _MIX[0] >> self.shift).astype(np.int64)

    def looked_up(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of words of up to 16 bytes, -1 for others."""
        found = np.full(len(size), -1, np.int32)
        k, left = self.slots(low, high), np.arange(len(size))
        while len(left):
            held = self.size[k]
            same = (self.low[k] == low) & (held == size) & (self.high[k] == high)
            found[left[same]] = self.word[k[same]]
            on = np.flatnonzero(~same & (held > 0))
            left, low, high, size, k = left[on], low[on], high[on], size[on], (k[on] + 1) % len(self.size)
        return found

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each token without punctuation at its ends, -1 for words of no item, and where each text's tokens begin, with their end."""
        lowered = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        raw = b"".join([b"\n", b"\n".join(lowered), b"\n", bytes(16)])
        kind = np.frombuffer(raw.translate(_KINDS), np.uint8)[:-16]
        turns = np.flatnonzero(np.diff(kind == 2)) + 1
        start, end = turns[::2].copy(), turns[1::2].copy()
        cuts = np.searchsorted(start, np.cumsum([1] + [len(t) + 1 for t in lowered]))
        marks = np.flatnonzero(kind == 1)
        if len(marks):  # runs of punctuation next to white space go; a token of nothing else ends before it starts
            new = np.flatnonzero(np.diff(marks) != 1)
            first, after = marks[np.append(0, new + 1)], marks[np.append(new, len(marks) - 1)] + 1
            token, lead, trail = np.searchsorted(start, first, side="right") - 1, kind[first - 1] == 2, kind[after] == 2
            start[token[lead]] = after[lead]
            end[token[trail]] = first[trail]
        size = end - start
        ids = np.full(len(size), -1, np.int32)
        at = np.flatnonzero((size > 0) & (size <= min(16, self.longest)))
        n, s = size[at], start[at]
        eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))  # the eight bytes from each place on
        low, high = eight[s] & _LOW_BYTES[np.minimum(n, 8)], np.zeros(len(at), np.uint64)
        more = np.flatnonzero(n > 8)
        high[more] = eight[s[more] + 8] & _LOW_BYTES[n[more] - 8]
        ids[at] = self.looked_up(low, high, n)
        for k in np.flatnonzero((size > 16) & (size <= self.longest)).tolist():
            ids[k] = self.number.get(raw[start[k] : end[k]], -1)
        return ids, cuts


class Lists:
    """A batch's columns of positions and word numbers, row by row without Python lists."""

    def __init__(self, batch: pa.RecordBatch):
        place, word = batch.column(1), batch.column(2)
        self.doc_ids = batch.column(0).to_pylist()
        self.cuts = place.offsets.to_numpy()
        self.place, self.word = place.values.to_numpy(), word.values.to_numpy()

    def runs(self, tokens: int = 10_000) -> Iterator[tuple[int, int]]:
        """Row ranges of about so many tokens."""
        at = 0
        while at < len(self.doc_ids):
            end = max(at + 1, int(np.searchsorted(self.cuts, self.cuts[at] + tokens, side="right")) - 1)
            yield at, min(end, len(self.doc_ids))
            at = min(end, len(self.doc_ids))

    def rows(self, at: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of rows at:end the row, position and word of each token."""
        cut = slice(self.cuts[at], self.cuts[end])
        return np.repeat(np.arange(end - at), np.diff(self.cuts[at : end + 1])), self.place[cut], self.word[cut]


def benchmark_tokens(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """(doc_id, place, word), doc_id of any type: the positions and numbers of the benchmark's words in each text; other words cannot take part in a match."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            upto = np.cumsum([len(t) for t in texts])
            at, place, word, held = 0, [], [], []
            while at < len(texts):
                end = int(np.searchsorted(upto, upto[at] + AT_ONCE))
                ids, cuts = vocabulary.ids(texts[at:end])
                own = np.flatnonzero(ids >= 0)
                held.append(np.diff(np.searchsorted(own, cuts)))
                place.append((own - np.repeat(cuts[:-1], held[-1])).astype(np.int32))
                word.append(ids[own])
                at = end
            offsets = pa.array(np.cumsum(np.concatenate([[0], *held])), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *c]))) for c in (place, word)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "place", "word"])

    rows = docs.select("doc_id", F.col("text").cast("string")).where("text <> ''")
    return rows.mapInArrow(run, rows.select("doc_id").schema.add("place", ArrayType(IntegerType())).add("word", ArrayType(IntegerType())))


def document_frequencies(tokens: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many texts each word is, and the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size + 1, np.int64)
        for batch in batches:
            lists = Lists(batch)
            held[size] += len(lists.doc_ids)
            for at, end in lists.runs():
                row, _, word = lists.rows(at, end)
                held[:size] += np.bincount(np.unique(row.astype(np.int64) << 32 | word) & 0xFFFFFFFF, minlength=size)
        yield pa.RecordBatch.from_pydict({"word": pa.array(range(size + 1), pa.int32()), "n": pa.array(held)})

    df = np.zeros(size + 1, np.int64)
    for r in tokens.mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        df[r.word] = r.n
    return df[:size], int(df[size])


def segment_sums(matrix: np.ndarray, index: np.ndarray, starts: np.ndarray, value: np.ndarray | None = None) -> np.ndarray:
    """The sums of matrix[index], times value if given, over the segments that begin at starts: the nth rows of all segments are added at once, longest first."""
    sizes = np.diff(np.append(starts, len(index)))
    if sizes.max() > SEGMENTS:
        pieces = -(-sizes // SEGMENTS)
        begin = np.cumsum(pieces) - pieces
        part = np.repeat(starts - SEGMENTS * begin, pieces) + SEGMENTS * np.arange(pieces.sum())
        return segment_sums(segment_sums(matrix, index, part, value), np.arange(len(part)), begin)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[order], sizes[order]
    sums = np.zeros((len(starts), matrix.shape[1]), np.float32)
    for k, n in enumerate(np.searchsorted(-sizes, -np.arange(sizes[0])).tolist()):
        rows = matrix[index[first[:n] + k]]
        if value is not None:
            rows *= value[first[:n] + k, None]
        sums[:n] += rows
    out = np.empty_like(sums)
    out[order] = sums
    return out


class Space:
    """Features (the items' rarer words) with their weights, then the latent vectors of words and items."""

    def __init__(self, items: list[tuple[int | None, np.ndarray, np.ndarray]], df: np.ndarray, n_docs: int):
        self.items = items
        idf = (np.log((n_docs + 1) / (df + 1)) + 0.1).astype(np.float32)
        chosen: set[int] = set()
        for _, words, _ in items:
            own = sorted(set(words.tolist()), key=lambda w: (-idf[w], w))
            rare = [w for w in own if df[w] <= COMMON * n_docs]
            chosen.update(rare if len(rare) >= LEAST_FEATURES else own[:LEAST_FEATURES])
        kept = np.array(sorted(chosen), np.int64)
        self.feature = np.full(len(df), -1, np.int64)
        self.feature[kept] = np.arange(len(kept))
        self.idf = idf[kept]
        self.latent = self.queries = None
        # By length: the items' shingles in order, with the item and the shingle's distance from its middle.
        self.shingles = {}
        lengths = np.array([len(words) for _, words, _ in items])
        for size in range(1, SHINGLE + 1):
            chosen = np.flatnonzero(lengths == size if size < SHINGLE else lengths >= size)
            if len(chosen):
                keys = np.concatenate([self.keys(items[k][1], size) for k in chosen])
                own = np.repeat(chosen, lengths[chosen] - size + 1)
                middle = np.concatenate([lengths[k] // 2 - np.arange(lengths[k] - size + 1) for k in chosen])
                order = np.argsort(keys, kind="stable")
                bits = min((64 * len(keys)).bit_length(), 24)
                seen = np.zeros(1 << bits, bool)
                seen[self.spread(keys, bits)] = True
                self.shingles[size] = keys[order], own[order], middle[order], bits, seen

    def keys(self, word: np.ndarray, size: int) -> np.ndarray:
        """A number for each size words in a row; should two share it, the verdict tells them apart."""
        n = len(word) - size + 1
        key = np.zeros(max(n, 0), np.int64)
        for k in range(size):
            key = key * len(self.feature) + word[k : k + len(key)]
        return key

    @staticmethod
    def spread(keys: np.ndarray, bits: int) -> np.ndarray:
        return (keys.view(np.uint64) * _MIX[0] >> np.uint64(64 - bits)).astype(np.int64)

    def verbatim(self, row: np.ndarray, place: np.ndarray, word: np.ndarray) -> np.ndarray:
        """(row, block, item number) of the passages around what shares a shingle with an item, each once."""
        found = [np.empty((0, 3), np.int64)]
        for size, (keys, items, middle, bits, seen) in self.shingles.items():
            own = self.keys(word, size)
            at = np.flatnonzero(seen[self.spread(own, bits)])  # all of the items' shingles, and few others
            at = at[row[at] == row[at + size - 1]]
            low = np.searchsorted(keys, own[at])
            n = np.searchsorted(keys, own[at], side="right") - low
            hit = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at = np.repeat(at, n)
            block = np.maximum((place[at] + middle[hit]) // BLOCK - SPAN // 2, 0)
            found.append(np.stack([row[at], block, items[hit]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def rows(self, row: np.ndarray, place: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """The unit TF-IDF rows of separate passages: starts of the rows, features, and by how much each row's weights are scaled."""
        f = self.feature[word]
        has = f >= 0
        if not has.any():
            return None
        passage = row[has].astype(np.int64) * (1 << 24) + place[has] // (BLOCK * SPAN)
        # Tokens come in order, so passages can be numbered as they change.
        number = np.cumsum(np.diff(passage, prepend=passage[0]) != 0)
        number, f = np.divmod(np.unique(number * len(self.idf) + f[has]), len(self.idf))
        starts = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1])
        value = self.idf[f]
        return starts, f, 1 / np.sqrt(np.add.reduceat(value * value, starts))[:, None]

    def times(self, rows: tuple, weighted: np.ndarray) -> np.ndarray:
        """rows @ matrix; weighted: the matrix with the features' weights in it"""
        starts, feature, scale = rows
        return segment_sums(weighted, feature, starts) * scale

    def back(self, rows: tuple, projected: np.ndarray, out: np.ndarray) -> None:
        """out += rows' @ projected, but for the features' weights, which are left to the sum"""
        starts, feature, scale = rows
        order = np.argsort(feature, kind="stable")
        f = feature[order]
        passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(feature))))
        first = np.concatenate([[0], np.flatnonzero(np.diff(f)) + 1])
        out[f[first]] += segment_sums(projected * scale, passage[order], first)


def _summed(tokens: DataFrame, space: Space, shape: tuple[int, int], add) -> np.ndarray:
    """The sum over all passages of a matrix that add(space, rows, out) adds to; what the tasks have summed is merged as a tree, MERGED at a time."""
    shared = tokens.sparkSession.sparkContext.broadcast(space)
    kind = "part int, sum binary"

    def one(out: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "sum": pa.array([out.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, out = shared.value, np.zeros(shape, np.float32)
        for batch in batches:
            lists = Lists(batch)
            for at, end in lists.runs(40_000):
                rows = s.rows(*lists.rows(at, end))
                if rows:
                    add(s, rows, out)
        yield one(out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape, np.float32)
        for batch in batches:
            for raw in batch.column(1):
                out += np.frombuffer(raw.as_buffer(), np.float32).reshape(shape)
        yield one(out)

    total = np.zeros(shape, np.float64)
    sums, parts = tokens.mapInArrow(run, kind), tokens.rdd.getNumPartitions()
    while parts > MERGED:
        parts = -(-parts // MERGED)
        sums = sums.repartition(parts).mapInArrow(merge, kind)
    for r in sums.toLocalIterator():
        total += np.frombuffer(r.sum, np.float32).reshape(shape)
    return total


def fit(tokens: DataFrame, items: list[tuple[int | None, np.ndarray, np.ndarray]], frequencies: tuple[np.ndarray, int], rank: int = RANK) -> Space:
    """The latent space of all passages and of the items; frequencies: in how many texts each word is, and of how many."""
    space = Space(items, *frequencies)
    features = len(space.idf)
    width = min(features, rank + OVERSAMPLE)
    draw = np.random.Generator(np.random.PCG64(5)).standard_normal((features, width)).astype(np.float32)
    lengths = [len(words) for _, words, _ in items]
    own = space.rows(np.repeat(np.arange(len(items)), lengths), np.concatenate([np.arange(n) for n in lengths]), np.concatenate([words for _, words, _ in items]))
    weights = space.idf[:, None]
    draw *= weights
    probe = _summed(tokens, space, (features, width), lambda s, rows, out: s.back(rows, s.times(rows, draw), out)) * weights
    mine = np.zeros((features, width), np.float32)
    space.back(own, space.times(own, draw), mine)
    mine *= weights
    # The items weigh ITEM_SHARE of the whole.
    weight = ITEM_SHARE / (1 - ITEM_SHARE) * max(np.linalg.norm(probe), 1e-9) / max(np.linalg.norm(mine), 1e-9)
    basis = np.linalg.qr(probe + weight * mine)[0].astype(np.float32)
    weighted = basis * weights

    def gram(s: Space, rows: tuple, out: np.ndarray) -> None:
        y = s.times(rows, weighted)
        out += y.T @ y

    small = _summed(tokens, space, (basis.shape[1], basis.shape[1]), gram)
    y = space.times(own, weighted)
    values, vectors = np.linalg.eigh(small + weight * (y.T @ y))
    space.latent = (basis @ vectors[:, np.argsort(-values)[:rank]]).astype(np.float32) * weights
    q = np.zeros((len(items), space.latent.shape[1]), np.float32)
    for k, (_, words, _) in enumerate(items):
        f = space.feature[words]
        q[k] = space.latent[f[f >= 0]].sum(0)
    space.queries = (q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-9)).T.copy()
    return space


def candidates(space: Space, row: np.ndarray, place: np.ndarray, word: np.ndarray, cosine: float) -> tuple[np.ndarray, ...]:
    """(row, first word, item number, cosine) of the passages of SPAN blocks of words, a block apart, that are near an item or share a shingle with it, row by row."""
    f = space.feature[word]
    has = f >= 0
    same = space.verbatim(row, place, word)
    if not has.any():
        return same[:, 0], same[:, 1] * BLOCK, same[:, 2], np.zeros(len(same))
    row, block, f = row[has], place[has] // BLOCK, f[has]
    # Blocks of a row lie side by side with SPAN - 1 empty ones after the last.
    last, ends = np.zeros(int(row[-1]) + 1, np.int64), np.append(np.flatnonzero(np.diff(row)), len(row) - 1)
    last[row[ends]] = block[ends]
    width = last + SPAN
    base = np.cumsum(width) - width
    at = base[row] + block
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    sums = np.zeros((int(width.sum()) + SPAN, space.latent.shape[1]), np.float32)
    sums[at[first]] = segment_sums(space.latent, f, first)
    # A passage that starts before the first word with a feature is covered by the one that starts there.
    begins = np.zeros(len(sums), bool)
    for k in range(SPAN):
        begins[np.maximum(at[first] - k, base[row[first]])] = True
    begin = np.flatnonzero(begins)
    passages = sums[begin]
    for k in range(1, SPAN):
        passages += sums[begin + k]
    passages /= np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-9)
    score = passages @ space.queries
    p, q = np.divmod(np.flatnonzero(score.ravel() >= cosine), score.shape[1])
    own = np.searchsorted(base, begin[p], side="right") - 1
    near = np.stack([own, begin[p] - base[own], q], axis=1)
    # The others by their shingles; a passage that no passage with features starts at has no cosine.
    cosines = np.zeros(len(same), np.float32)
    known = np.flatnonzero(same[:, 0] < len(base))
    known = known[same[known, 1] < width[same[known, 0]]]
    start = base[same[known, 0]] + same[known, 1]
    at = np.minimum(np.searchsorted(begin, start), len(begin) - 1)
    known, at = known[begin[at] == start], at[begin[at] == start]
    cosines[known] = score[at, same[known, 2]]
    more = cosines < cosine
    every, cosines = np.concatenate([near, same[more]]), np.concatenate([score[p, q], cosines[more]])
    order = np.argsort(every[:, 0], kind="stable")
    return every[order, 0], every[order, 1] * BLOCK, every[order, 2], cosines[order]


def verdict(item: Sequence, answer: Sequence, region: list) -> tuple[bool, int, int]:
    """Contaminated?, and the common subsequences of the region with the item and with its answer."""
    hits = item.hits(region)
    if len(hits) < LOOSE * item.words or item.met(hits) < LOOSE * item.words:
        return False, 0, 0
    n = item.lcs(hits)
    if n < LOOSE * item.words:
        return False, n, 0
    a = answer.lcs(answer.hits(region))
    return n >= COVERED * item.words or a >= ANSWER * answer.words, n, a


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, item_block: int = RANK) -> DataFrame:
    """(doc_id, item_id, cosine, lcs_words, item_words, answer_words): the best matching passage a document and item."""
    schema = docs.select("doc_id").schema
    for name, kind in (("item_id", "long"), ("cosine", "double"), ("lcs_words", "integer"), ("item_words", "integer"), ("answer_words", "integer")):
        schema = schema.add(name, kind)
    kinds = [pa.string() if schema["doc_id"].dataType.simpleString() == "string" else pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32()]
    names = schema.names
    found: list[DataFrame] = []
    queries = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text <> ''").orderBy("item_id", "text")
    vocabulary = sorted({w for r in queries.toLocalIterator() for w in plain_words(r.text)})
    number = {w: k for k, w in enumerate(vocabulary)}
    tokens = stored(benchmark_tokens(docs, vocabulary), "benchmark-tokens")
    frequencies = document_frequencies(tokens, len(vocabulary))

    def search(block: list[tuple[int | None, str]]) -> None:
        texts = [(i, plain_words(t), answer_of(t)) for i, t in block]
        items = [(i, np.array([number[w] for w in words]), np.array([number[w] for w in answer])) for i, words, answer in texts if words]
        if not items:
            return
        shared = docs.sparkSession.sparkContext.broadcast(fit(tokens, items, frequencies))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = shared.value
            sequences = [(Sequence(item.tolist()), Sequence(answer.tolist())) for _, item, answer in s.items]
            reach = max(item.words for item, _ in sequences) // 2
            for batch in batches:
                lists, best, now, here = Lists(batch), {}, -1, None
                for at, end in lists.runs():
                    rows = lists.rows(at, end)
                    for row, first, q, score in zip(*(c.tolist() for c in candidates(s, *rows, cosine)), strict=True):
                        if at + row != now:
                            now = at + row
                            cut = slice(lists.cuts[now], lists.cuts[now + 1])
                            place, word = lists.place[cut].tolist(), lists.word[cut].tolist()
                        if (now, first) != here:  # the words around the passage, as far as the longest item reaches
                            here = now, first
                            around = set(word[bisect_left(place, first - reach) : bisect_left(place, first + BLOCK * SPAN + reach)])
                        item, answer = sequences[q]
                        if item.within(around) < LOOSE * item.words:
                            continue
                        low, high = bisect_left(place, first - item.words // 2), bisect_left(place, first + BLOCK * SPAN + item.words // 2)
                        yes, n, a = verdict(item, answer, word[low:high])
                        key = (now, q)
                        if yes and (key not in best or n > best[key][3]):
                            best[key] = (lists.doc_ids[now], s.items[q][0], score, n, item.words, a)
                columns = list(zip(*best.values(), strict=True)) if best else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        found.append(tokens.mapInArrow(run, schema))

    block: list[tuple[int | None, str]] = []
    for r in queries.toLocalIterator():
        block.append((r.item_id, r.text))
        if len(block) == item_block:
            search(block)
            block = []
    if block:
        search(block)
    every = reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], schema)
    best = F.max(F.struct("lcs_words", "cosine", "item_words", "answer_words")).alias("best")
    return every.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.lcs_words", "best.item_words", "best.answer_words")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that match no item; rows are told apart by id and text."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    columns, keyed = docs.columns, docs.withColumn("__row_key", key)
    hit = contaminated(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("__row_key")).distinct()
    return keyed.join(hit, "__row_key", "left_anti").select(*columns)
