"""Suffix-array dedup: bytes covered by a long string that starts elsewhere too.

Of the 16-byte strings inside a window of `length` bytes, the one with the least
hash (leftmost of equals) is the window's anchor; equal windows have it at the
same offset, so equal windows meet at their anchors, and only anchors, one in
some 200 bytes, are shuffled. The windows of an anchor are dealt to cells by
that offset; all windows of a cell share a core of bytes, whose hash is the key
they meet by. Where all contexts of a key are the same bytes, its windows are
repeated and no text is moved.

Where contexts differ, one of each kind goes to its key's group with its bytes:
the strings right and (reversed) left of the anchors are put in suffix order by
deep-shallow sorting - multikey quicksort to a shallow depth, then blind tries
for what still agrees - and the common prefixes of the two orders tell which
windows two contexts share. A key with more than `group` kinds of contexts is
cut into finer cells instead, down to single windows, which need no group: no
task ever holds an unbounded one. Contexts are told equal by two 64-bit hashes
of different kinds, a polynomial of what they share with their cell and xxh3 of
all their bytes; contexts that differ are only brought together by the first
and compared by their bytes. Rows equal in id and text are worked on once.

What the windows of a coarse cell share, its core of length + 1 - widths[0] bytes,
is a shorter repeat by itself where two places hold it. These are told as well,
though nothing is removed for them: a lower bound of what repeats below length.

Passages of words that other rows hold too are told apart from this, and nothing is
removed for them either: each window of PASSAGE words has the least of its runs of
RUN words as its anchor, in the same way, and an anchor counts if another row has
it. So every shared passage of PASSAGE words is told, and none of less than RUN.

Defined results: null and empty texts keep nothing and lose nothing (n_bytes 0);
repeated rows are repetitions of each other; a null doc_id is an id of its own;
overlapping matches merge; texts shorter than length are kept; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.llm.common import discard, meet, multiplied, one_of_equal, row_key, stored
from placemark.llm.hashing import in_runs, mix, word_hashes

LENGTH, GRAM = 400, 16
#: Words of a passage that is told if other rows have it, and of the run in it that they are met by.
PASSAGE, RUN = 50, 35
#: Cells of the anchor's offset, from coarse to single windows; the kinds of contexts a group may have.
WIDTHS, GROUP = (200, 25, 1), 4096
#: Multikey quicksort compares so many bytes as one character, to this depth.
CHARACTER, SHALLOW = 8, 32
SMALL = 48

_RANDOM = np.random.Generator(np.random.PCG64(77))
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0xD1342543DE82EF95
_power = {s: np.ones(1, np.uint64) for s in (_STEP, pow(_STEP, -1, 1 << 64))}


def _powers(step: int, n: int) -> np.ndarray:
    if len(_power[step]) < n:
        grown = np.full(max(n, 2 * len(_power[step])), np.uint64(step))
        grown[0] = 1
        _power[step] = np.cumprod(grown, dtype=np.uint64)
    return _power[step][:n]


class Hashes:
    """Hashes of any stretch of a byte string, or of a row of word hashes, from its prefix sums."""

    def __init__(self, raw: bytes | np.ndarray):
        values = _BYTE[np.frombuffer(raw, np.uint8)] if isinstance(raw, bytes) else raw
        self.inverse = _powers(pow(_STEP, -1, 1 << 64), len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(values * _powers(_STEP, len(raw) + 1)[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def anchors(h: Hashes, starts: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): the windows that begin from first to last have that anchor; texts lie at starts:ends."""
    size, width = int(ends[-1]), length - gram + 1
    counts = np.maximum(ends - starts - length + 1, 0)
    none = np.empty(0, np.int64)
    if not counts.sum():
        return none, none, none
    at = np.arange(size - gram + 1)
    key = (mix(h.of(at, at + gram)) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    n = -(-len(key) // width) * width
    key = np.concatenate([key, np.full(n - len(key), np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(key, axis=1).ravel()
    after = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].ravel()
    x = np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)
    least = np.minimum(after[x], before[x + width - 1])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(x) != 1)) + 1
    first = np.concatenate([[0], cut])
    return anchor[first], x[first], x[np.concatenate([cut, [len(x)]]) - 1]


def cells(raw: bytes, h: Hashes, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, width: int, length: int) -> tuple[np.ndarray, ...]:
    """The ranges cut by anchor offset into cells of width: (range, key, context hash, first, last, anchor)."""
    low, high = (anchor - last) // width, (anchor - first) // width
    n = high - low + 1
    which = np.repeat(np.arange(len(n)), n)
    cell = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]
    a = anchor[which]
    xs = np.maximum(first[which], a - (cell + 1) * width + 1)
    xe = np.minimum(last[which], a - cell * width)
    key = mix(h.of(a - cell * width, a + length + 1 - (cell + 1) * width) ^ mix((cell * 1024 + width).astype(np.uint64)))
    own = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(xs.tolist(), (xe + length).tolist(), strict=True)), np.uint64, len(xs))
    context = mix(own ^ mix(((a - xs) * 65536 + (xe - xs)).astype(np.uint64)))
    return which, key, context, xs, xe, a


_ROW = "rid long, key long, kind long, first int, last int, high int, n int"
_NAMES = ["rid", "key", "kind", "first", "last", "high", "n"]


def _rows(rid, key, kind, first, last, high, again=None) -> pa.RecordBatch:
    """Rows of one run of texts. Contexts that repeat inside the run are told at once
    (n 0); one of them goes on for all (n 2), so a text that repeats itself stays small.
    again: which ones lie in a text that other rows have too (n 2)."""
    _, one, which, count = np.unique(key ^ mix(kind), return_index=True, return_inverse=True, return_counts=True)
    told = np.flatnonzero(count[which] > 1)
    if again is not None:
        np.maximum.at(count, which, 1 + again.astype(count.dtype))
    at = np.concatenate([one, told])
    n = np.concatenate([np.minimum(count, 2), np.zeros(len(told), np.int64)])
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[at], pa.int64()), pa.array(key[at].view(np.int64)), pa.array(kind[at].view(np.int64)), *(pa.array(v.astype(np.int32)) for v in (first[at], last[at], high[at], n))], names=_NAMES
    )


def _raw(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _all_windows(length: int, width: int):
    """rid, text, copies -> a row for each anchor and cell of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, texts, done = batch.column(0).to_numpy(zero_copy_only=False), [_raw(t) for t in batch.column(1).to_pylist()], 0
            copies = batch.column(2).to_numpy(zero_copy_only=False) > 1
            for group in in_runs(texts):
                raw = b"".join(group)
                sizes = np.array([len(t) for t in group], np.int64)
                ids, more = rids[done : done + len(group)], copies[done : done + len(group)]
                done += len(group)
                if sizes.max() < length:
                    continue
                h, ends = Hashes(raw), np.cumsum(sizes)
                starts = ends - sizes
                _, key, kind, xs, xe, a = cells(raw, h, *anchors(h, starts, ends, length), width, length)
                own = np.searchsorted(ends, xs, side="right")
                yield _rows(ids[own], key, kind, xs - starts[own], xe - starts[own], a - xs, more[own])

    return run


def _finer(length: int, width: int):
    """rid, text, contexts -> their windows in finer cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                first, last, high = (np.array([w[k] for w in wanted], np.int64) for k in ("first", "last", "high"))
                raw = _raw(text)
                h = Hashes(raw)
                _, key, kind, xs, xe, a = cells(raw, h, first + high, first, last, width, length)
                yield _rows(np.full(len(xs), rid), key, kind, xs, xe, a - xs)

    return run


def _contexts(length: int):
    """rid, text, contexts -> each context with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for rid, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                raw = _raw(text)
                out += [(w["key"], w["kind"], rid, w["first"], w["last"], w["high"], raw[w["first"] : w["last"] + length]) for w in wanted]
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "kind", "rid", "first", "last", "high", "bytes"])

    return run


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes], items: list[int]) -> tuple[list[int], list[int]]:
    """Items in the order of their strings, and each one's common prefix with the one before (the first: 0).

    A node knows its depth and branches by one byte; a string goes down blindly
    to some leaf, and one comparison with it tells where it branches off.
    """
    end = -1
    root: list = [len(strings[items[0]]), {end: [items[0]]}]
    for item in items[1:]:
        s, node, path = strings[item], root, []
        while True:
            path.append(node)
            step = s[node[0]] if node[0] < len(s) else end
            below = node[1].get(step)
            if below is None:
                below = next(iter(node[1].values()))
            if not isinstance(below[-1], dict):
                break
            node = below
        n = common_prefix(s, strings[below[0]])
        k = 0
        while k < len(path) and path[k][0] < n:
            k += 1
        if k < len(path) and path[k][0] == n:  # at a node: a branch more, or the same string again
            step = s[n] if n < len(s) else end
            if step in path[k][1]:
                path[k][1][step].append(item)
            else:
                path[k][1][step] = [item]
            continue
        # Between two nodes, or below the last: a new node there.
        parent = path[k - 1] if k else None
        other = strings[below[0]]
        if k < len(path):
            held = path[k]
            new = [n, {other[n]: held, (s[n] if n < len(s) else end): [item]}]
        else:
            held = below
            if n == len(s) and n == len(other):
                held.append(item)
                continue
            new = [n, {(other[n] if n < len(other) else end): held, (s[n] if n < len(s) else end): [item]}]
        if parent is None:
            root = new
        else:
            for step, child in parent[1].items():
                if child is held:
                    parent[1][step] = new
                    break
    order: list[int] = []
    lcp: list[int] = []
    todo: list[tuple] = [(root, 0)]
    while todo:
        node, shared = todo.pop()
        if isinstance(node[-1], dict):
            steps = sorted(node[1])
            todo += [(node[1][b], node[0] if i else shared) for i, b in reversed(list(enumerate(steps)))]
        else:
            order += node
            lcp += [shared] + [len(strings[node[0]])] * (len(node) - 1)
    return order, lcp


def deep_shallow(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of the strings and each one's common prefix with the one before (the first: 0)."""
    order: list[int] = []
    lcp: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while todo:
        items, depth = todo.pop()
        if not items:
            continue
        if len(items) == 1:
            found, shared = items, [0]
        elif depth >= SHALLOW:
            found, shared = blind_trie(strings, items)
        else:
            at = lambda i: strings[i][depth : depth + CHARACTER]
            pivot = at(items[len(items) // 2])
            parts: tuple[list[int], list[int], list[int]] = ([], [], [])
            for i in items:
                c = at(i)
                parts[0 if c < pivot else 2 if c > pivot else 1].append(i)
            if len(pivot) < CHARACTER and len(parts[1]) > 1:  # these strings end here and are equal
                todo += [(parts[2], depth), (parts[1], SHALLOW), (parts[0], depth)]
            else:
                todo += [(parts[2], depth), (parts[1], depth + CHARACTER), (parts[0], depth)]
            continue
        lcp.append(common_prefix(strings[order[-1]], strings[found[0]]) if order else 0)
        lcp += shared[1:]
        order += found
    return order, lcp


def shared_offsets(contexts: list[tuple[int, bytes]], length: int) -> list[list[tuple[int, int]]]:
    """For each of different contexts (offset of the anchor, bytes): the runs of anchor
    offsets at which its window is also another's."""
    right = deep_shallow([c[high:] for high, c in contexts])
    left = deep_shallow([c[:high][::-1] for high, c in contexts])
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    if len(contexts) <= SMALL:
        common: dict[tuple[int, int], int] = {}
        for k, (order, lcp) in enumerate((left, right)):
            for p in range(len(order)):
                least = length
                for q in range(p + 1, len(order)):
                    least = min(least, lcp[q])
                    pair = (order[p], order[q]) if order[p] < order[q] else (order[q], order[p])
                    if k == 0:
                        common[pair] = least
                    elif length - least <= common[pair]:
                        for i in pair:
                            out[i].append((length - least, common[pair]))
        return [_merged(runs) for runs in out]
    n = len(contexts)
    highs = np.array([high for high, _ in contexts])
    lows = length - np.array([len(c) - high for high, c in contexts])
    rank = []
    for order, lcp in (left, right):
        r = np.empty(n, np.int64)
        r[order] = np.arange(n)
        rank.append((r, np.array(lcp)))
    for offset in range(int(lows.min()), int(highs.max()) + 1):
        here = np.flatnonzero((lows <= offset) & (offset <= highs))
        group = [np.cumsum(lcp < depth)[r[here]] for (r, lcp), depth in zip(rank, (offset, length - offset), strict=True)]
        _, which, count = np.unique(group[0] * (n + 1) + group[1], return_inverse=True, return_counts=True)
        for i in here[count[which] > 1].tolist():
            if out[i] and out[i][-1][1] == offset - 1:
                out[i][-1] = (out[i][-1][0], offset)
            else:
                out[i].append((offset, offset))
    return out


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _merged_rows(spans: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of (first, last, of) of n rows -> of * n + row in order, first and last of each run of a row and kind;
    the last of a window (of 0) is where its last window of length begins."""
    n, flat = len(spans), spans.flatten()
    first, last, of = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
    last = last + (of == 0) * (length - 1)
    own = of * n + np.repeat(np.arange(n), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    order = np.lexsort((first, own))
    own, far = own[order], int(last.max(initial=0)) + 2
    first, last = first[order] + own * far, np.maximum.accumulate(last[order] + own * far)
    new = np.concatenate([[True], first[1:] > last[:-1] + 1])[: len(own)]
    own, first, last = own[new], first[new], last[np.append(new[1:], True)[: len(new)]]
    return own, first - own * far, last - own * far


def _resolved(length: int):
    """Contexts in the order of their keys -> the runs of windows of each that others share."""

    def solve(group: dict[int, tuple]) -> Iterator[tuple[int, int, int]]:
        members = list(group.values())
        if len(members) > 1:
            for (rid, first, high, _), runs in zip(members, shared_offsets([(m[2], m[3]) for m in members], length), strict=True):
                for a, b in runs:
                    yield rid, first + high - b, first + high - a

    def batch_of(spans: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*spans, strict=True)) if spans else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=["rid", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, {}
        for batch in batches:
            out: list[tuple] = []
            for key, kind, rid, first, _, high, raw in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if key != now:
                    out += solve(group)
                    now, group = key, {}
                group.setdefault(kind, (rid, first, high, raw))
            yield batch_of(out)
        yield batch_of(list(solve(group)))

    return run


def repeated_windows(docs: DataFrame, length: int = LENGTH, widths: tuple[int, ...] = WIDTHS, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(rid, first, last): the windows of the text with that rid that start from first to last start elsewhere too;
    and (rid, first, last): the first and last byte of the cores that were found elsewhere too.

    docs: rid, text, copies, one row a rid. widths must divide evenly into one another and end with 1.
    """
    rows = stored(docs.select("rid", "text", "copies").mapInArrow(_all_windows(length, widths[0]), _ROW), "windows")
    spans = cores = None
    for k, width in enumerate(widths):
        keys = rows.where("n > 0").groupBy("key").agg(F.sum("n").alias("windows"), F.count("*").alias("n"), F.min("kind").alias("least"), F.max("kind").alias("most"))
        keys = stored(keys.where("windows > 1").select("key", "n", (F.col("least") < F.col("most")).alias("mixed")), "windows-keys")
        met = meet(rows.where("n > 0").withColumnRenamed("n", "times"), keys, ["key"]).select("rid", "key", "kind", "first", "last", "high", "times", "mixed")
        # Windows that were told to repeat inside their run of texts go along.
        told = rows.where("n = 0").select("rid", "key", "kind", "first", "last", "high", F.lit(0).alias("times"), F.lit(False).alias("mixed"))
        met = stored(met.union(told), "windows-met")
        discard(rows, keys)
        if cores is None:
            anchor, low = F.expr("first + high"), F.expr(f"(first + high - last) div {width} * {width}")
            cores = met.select("rid", (anchor - low).cast("int").alias("first")).distinct()
            cores = stored(cores.withColumn("last", F.col("first") + length - width), "windows-cores")
        kinds = met.where("mixed").groupBy("key", "kind").agg(F.sum("times").alias("times"), F.count("*").alias("n"), F.min(F.struct("rid", "first", "last", "high")).alias("one"))
        kinds = stored(kinds, "windows-kinds")
        again = meet(met.where("mixed"), kinds.where("times > 1").select("key", "kind", "n"), ["key", "kind"])
        found = met.where("not mixed").select("rid", "first", "last").union(again.select("rid", "first", "last"))
        sizes = kinds.groupBy("key").agg(F.count("*").alias("kinds"))
        counted, kinds = kinds, stored(kinds.join(sizes, "key").select("key", "kind", "kinds", "one.*"), "windows-sized")
        wanted = F.collect_list(F.struct("key", "kind", "first", "last", "high")).alias("wanted")
        few = docs.join(kinds.where(F.col("kinds") <= group).groupBy("rid").agg(wanted), "rid").select("rid", "text", "wanted")
        contexts = few.mapInArrow(_contexts(length), "key long, kind long, rid long, first int, last int, high int, bytes binary")
        solved = contexts.repartition("key").sortWithinPartitions("key").mapInArrow(_resolved(length), "rid long, first int, last int")
        found = stored(found.union(solved), "windows-repeated")
        discard(met, counted)
        spans = found if spans is None else spans.union(found)
        many = kinds.where(F.col("kinds") > group)
        if k + 1 == len(widths) or many.isEmpty():
            return spans, cores
        again = docs.join(many.groupBy("rid").agg(wanted), "rid").select("rid", "text", "wanted")
        rows = stored(again.mapInArrow(_finer(length, widths[k + 1]), _ROW), "windows-finer")
    return spans, cores


def _word_runs(passage: int, run_words: int):
    """rid, text, copies -> rid, key, first word and whether other rows have the text: the anchors of its passages of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rids, texts, done = batch.column(0).to_numpy(zero_copy_only=False), [_raw(t) for t in batch.column(1).to_pylist()], 0
            copies = batch.column(2).to_numpy(zero_copy_only=False) > 1
            for group in in_runs(texts):
                words = word_hashes(group)
                ids, more = rids[done : done + len(group)], copies[done : done + len(group)]
                done += len(group)
                sizes = np.array([len(w) for w in words], np.int64)
                if sizes.max() < passage:
                    continue
                ends, h = np.cumsum(sizes), Hashes(np.concatenate(words))
                starts = ends - sizes
                at = np.unique(anchors(h, starts, ends, passage, run_words)[0])
                own = np.searchsorted(ends, at, side="right")
                key = mix(h.of(at, at + run_words)).view(np.int64)
                columns = pa.array(ids[own], pa.int64()), pa.array(key), pa.array((at - starts[own]).astype(np.int32)), pa.array(more[own])
                yield pa.RecordBatch.from_arrays(list(columns), names=["rid", "key", "first", "again"])

    return run


def shared_words(docs: DataFrame, passage: int = PASSAGE, run_words: int = RUN) -> DataFrame:
    """(rid, first, last): the first and last word of the runs of run_words words that other rows have too; of
    every passage of so many words that two rows share at least one is told. docs: rid, text, copies, one row a rid."""
    rows = stored(docs.select("rid", "text", "copies").mapInArrow(_word_runs(passage, run_words), "rid long, key long, first int, again boolean"), "passages")
    keys = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("least"), F.max("rid").alias("most"), F.max("again").alias("again"))
    keys = stored(keys.where("again or least < most").select("key", "n"), "passages-keys")
    met = meet(rows, keys, ["key"]).select("rid", "first", (F.col("first") + run_words - 1).alias("last"))
    met = stored(met, "passages-met")
    discard(rows, keys)
    return met


def remove_repeats(docs: DataFrame, length: int = LENGTH, **parameters) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256, n_core_bytes (bytes in cores found elsewhere too)
    and n_shared_words (words in runs that other rows have too) of every row."""
    own = docs.select(row_key().alias("rid"), F.col("doc_id"), F.col("text").cast("string").alias("text"))
    once = one_of_equal(own, "windows-copies")
    words = shared_words(once)
    spans, cores = repeated_windows(once, length, **parameters)
    spans = reduce(DataFrame.unionByName, [x.select("rid", "first", "last", F.lit(k).alias("of")) for k, x in enumerate((spans, cores, words))])
    spans = spans.groupBy("rid").agg(F.collect_list(F.struct("first", "last", "of")).alias("spans"))
    schema = docs.select("doc_id").schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary"), ("kept_sha256", "string"), ("n_core_bytes", "long"), ("n_shared_words", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, out = batch.num_rows, []
            own, first, last = _merged_rows(batch.column(2), length)
            counts = np.bincount(own, last - first + 1, 3 * n).astype(np.int64).reshape(3, n)
            cuts = np.searchsorted(own, np.arange(n + 1))
            for k, text in enumerate(batch.column(1).to_pylist()):
                raw, at, kept = _raw(text), 0, []
                for a, b in zip(first[cuts[k] : cuts[k + 1]].tolist(), last[cuts[k] : cuts[k + 1]].tolist(), strict=True):
                    kept.append(raw[at:a])
                    at = b + 1
                left = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(left), len(kept), left, sha256(left).hexdigest()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.binary(), pa.string()]
            more = pa.array(counts[1]), pa.array(counts[2]), batch.column(3)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), *more], names=schema.names)

    schema = schema.add("copies", "long")
    told = once.join(spans, "rid", "left").select("doc_id", "text", "spans", "copies")
    return multiplied(told, F.col("copies"), lambda rows: rows.mapInArrow(run, schema)).drop("copies")
