"""Brown class-based n-grams: exchange clustering, class transitions, word emissions.

Spark counts the training words. Every word maps to a unit: itself if it is one
of the WORDS most frequent, else its ending (last three bytes) if that is one of
the ENDINGS most frequent among the other words, else one rest unit; the end
token is a unit and a class of its own. Unit bigrams over all training tokens
are summed by Spark - a table whose size the two numbers bound - and the
exchange algorithm moves units between CLASSES classes while the class bigram
likelihood rises. Then every other word that occurs in training is exchanged by
itself: Spark sums, over all training tokens, how often each stands before and
after every class, and each word goes to the class that raises the likelihood
most. Class bigrams are counted again over all training tokens.

Texts are read twice: once to count words, once to write each as a row of codes
(the words of the table, TABLE of them, the broadcast's bound; for other words
that of their ending) with the words beyond the table beside it. All else works
on the codes. Classes and counts of the table are broadcast; those of the words
beyond it stay a table of Spark's, which the texts meet in a join, so classes
and counts cover the whole corpus, whatever its vocabulary.

P(text) = prod P(class | class before) * P(word | class), a text beginning after
an end token. Transitions are smoothed with the class distribution. A class
keeps as much for unseen words as it has words seen once (n1):
P(w | c) = n(w) / (N(c) + n1(c)), and n1(c) / (N(c) + n1(c)) for an unseen word.

Defined results: a null or empty text is one end token; the held-out part is
crc32(doc_id as text) mod 5 = 1, a null id is in training; repeated rows are
scored row by row and counted as often as they occur; a word that never occurs
in training has no neighbours to go by and the class of its ending; without
training rows every word is unseen and N and V are 0; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemark.llm.common import discard, stored, words_of

WORDS, ENDINGS, CLASSES, TABLE, ROUNDS = 1024, 512, 64, 60_000, 6


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts; a task sends each word once for many texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen.update(words_of(t))
                if len(seen) > 400_000:
                    yield emit(seen)
                    seen.clear()
        yield emit(seen)

    def emit(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(seen.keys(), pa.binary()), "n": pa.array(seen.values(), pa.int64())})

    return docs.select(F.col("text").cast("string")).where("text <> ''").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Units:
    """Words to units: 0 the end token, then the frequent words, the frequent endings, and the rest."""

    def __init__(self, words: list[bytes], endings: list[bytes]):
        self.words = {w: i + 1 for i, w in enumerate(words)}
        self.endings = {e: i + 1 + len(words) for i, e in enumerate(endings)}
        self.rest = 1 + len(words) + len(endings)
        self.size = self.rest + 1

    def of(self, words: list[bytes]) -> list[int]:
        whole, ending, rest = self.words.get, self.endings.get, self.rest
        return [whole(w) or ending(w[-3:], rest) for w in words]


class Codes:
    """Numbers of words: 0 the end token, then the words of the table, then for words beyond it their endings and the rest."""

    def __init__(self, units: Units, top: list[bytes]):
        self.units, self.table = units, len(top)
        self.number = {w: i + 1 for i, w in enumerate(top)}
        self.endings = {e: u - 1 - len(units.words) + len(top) + 1 for e, u in units.endings.items()}
        self.rest = 1 + len(top) + len(units.endings)
        #: The unit of each code, and the smallest type that holds every code.
        self.unit = np.array([0, *units.of(top), *range(1 + len(units.words), units.size)], np.int64)
        self.kind = np.uint16 if self.rest < 1 << 16 else np.uint32

    def of(self, words: list[bytes]) -> np.ndarray:
        own, ending, rest = self.number.get, self.endings.get, self.rest
        return np.array([own(w) or ending(w[-3:], rest) for w in words], self.kind)


def encoded(docs: DataFrame, shared) -> DataFrame:
    """(row, doc_id, held_out, codes, rare) of each text: codes end with the end token, rare has the words beyond the table and their places."""
    schema = "row long, doc_id long, held_out boolean, codes binary, rare array<struct<word: binary, place: int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        end = np.zeros(1, codes.kind).tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            out, rare, places, cuts = [], [], [], [0]
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                c = codes.of(words)
                beyond = np.flatnonzero(c > codes.table)
                out.append(c.tobytes() + end)
                rare += [words[i] for i in beyond.tolist()]
                places.append(beyond)
                cuts.append(len(rare))
            place = pa.array(np.concatenate([np.empty(0, np.int64), *places]).astype(np.int32))
            rows = pa.array(range(row, row + len(batch)), pa.int64())
            row += len(batch)
            beside = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(rare, pa.binary()), place], ["word", "place"]))
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), batch.column(1), pa.array(out, pa.binary()), beside], names=["row", "doc_id", "held_out", "codes", "rare"])

    return docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(run, schema)


def _joined(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """What a batch's rows of numbers hold, one after the other, and where each row begins (and the last ends)."""
    cuts = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or cuts[0] == cuts[-1]:
        return np.empty(0, kind), np.zeros(len(column) + 1, np.int64)
    size = np.dtype(kind).itemsize
    return np.frombuffer(column.buffers()[2][int(cuts[0]) : int(cuts[-1])], kind), (cuts - cuts[0]) // size


def _struct_lists(column: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """The row of each struct of a batch's lists, and the structs' fields."""
    cuts = column.offsets.to_numpy()
    held = column.values.slice(int(cuts[0]), int(cuts[-1] - cuts[0]))
    return np.repeat(np.arange(len(column)), np.diff(cuts)), held.flatten()


def unit_bigrams(coded: DataFrame, shared) -> np.ndarray:
    """Counts of unit pairs over all texts, each between two end tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        size = codes.units.size
        held = np.zeros(size**2, np.int64)
        for batch in batches:
            _add(held, codes.unit[np.append(codes.kind(0), _joined(batch.column(0), codes.kind)[0])], size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(at), "n": pa.array(held[at])})

    summed = coded.select("codes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    size = shared.value.units.size
    out = np.zeros(size**2)
    out[summed.column("pair").to_numpy()] = summed.column("n").to_numpy()
    return out.reshape(size, size)


def _add(held: np.ndarray, a: np.ndarray, size: int) -> None:
    pair, n = np.unique(a[:-1] * size + a[1:], return_counts=True)
    held[pair] += n


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Classes of the units: each in turn goes where the class bigram likelihood is highest.

    Unit 0 stays alone in class 0. The table is bounded by the number of units.
    """
    size = len(pairs)
    cls = np.zeros(size, np.int64)
    by_count = np.argsort(-(pairs.sum(1) + pairs.sum(0))[1:], kind="stable") + 1
    cls[by_count] = 1 + np.arange(size - 1) % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), cls] = 1
    after, before = pairs @ member, pairs.T @ member  # unit to class, class to unit
    table = member.T @ after
    for _ in range(rounds):
        moved = 0
        for u in by_count:
            a, own = cls[u], pairs[u, u]
            out, into = after[u].copy(), before[u].copy()
            if not out.sum() + into.sum():
                continue
            out[a] -= own
            into[a] -= own
            table[a] -= out
            table[:, a] -= into
            table[a, a] -= own
            # Wherever the unit goes, others' moves to and from it count in their own sums.
            row, col = table.sum(1) + into, table.sum(0) + out
            gain = (_f(table + out) - _f(table)).sum(1) + (_f(table + into[:, None]) - _f(table)).sum(0)
            d = np.diagonal(table)
            gain += _f(d + out + into + own) - _f(d + out) - _f(d + into) + _f(d)
            gain -= _f(row + out.sum() + own) - _f(row) + _f(col + into.sum() + own) - _f(col)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            table[b] += out
            table[:, b] += into
            table[b, b] += own
            if b != a:
                cls[u] = b
                after[:, a] -= pairs[:, u]
                after[:, b] += pairs[:, u]
                before[:, a] -= pairs[u]
                before[:, b] += pairs[u]
                moved += 1
        if not moved:
            break
    return cls


class Classes:
    """Classes of words: those of the table are held, the other training words' asked from Spark, which keeps them; words of neither have that of their unit."""

    def __init__(self, codes: Codes, cls: np.ndarray):
        self.codes, self.units, self.number, self.cls = codes, codes.units, codes.number, cls
        self.own = cls[codes.unit]  # by code
        self.rare: DataFrame | None = None
        self.seen: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        """For a few words at a time: a query on the driver. Texts get theirs by join."""
        code = self.codes.of(words)
        out = self.own[code]
        asked = {words[i] for i in np.flatnonzero(code > self.codes.table)}
        new = [F.lit(bytearray(w)) for w in asked - self.seen.keys()]
        if new and self.rare is not None:
            found = {bytes(r.word): r.c for r in self.rare.where(F.col("word").isin(new)).collect()}
            self.seen.update({w: found.get(w, -1) for w in asked - self.seen.keys()})
        for i, w in enumerate(words):
            if self.seen.get(w, -1) >= 0:
                out[i] = self.seen[w]
        return out


def contexts(coded: DataFrame, shared) -> DataFrame:
    """(word, near): for each code of a table word beyond the units' how often each class stands before it (0 to CLASSES) and after it (from CLASSES on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, own = shared.value
        width = 2 * CLASSES
        held = np.zeros((codes.table + 1) * width, np.int32)
        for batch in batches:
            at = np.append(codes.kind(0), _joined(batch.column(0), codes.kind)[0]).astype(np.int64)
            c = own[at]
            i = np.flatnonzero((at > len(codes.units.words)) & (at <= codes.table))
            code, n = np.unique(np.concatenate([at[i] * width + c[i - 1], at[i] * width + CLASSES + c[i + 1]]), return_counts=True)
            held[code] += n.astype(np.int32)
        at = np.flatnonzero(held)
        for k in range(0, len(at), 1_000_000):
            part = at[k : k + 1_000_000]
            yield pa.RecordBatch.from_pydict({"code": pa.array(part), "n": pa.array(held[part].astype(np.int64))})

    summed = coded.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    width = 2 * CLASSES
    return summed.groupBy(F.expr(f"code div {width}").alias("word")).agg(F.collect_list(F.struct((F.col("code") % width).alias("near"), "n")).alias("near"))


def rare_contexts(coded: DataFrame, shared) -> DataFrame:
    """(word, near): for each word beyond the table how often each pair of classes (before * CLASSES + after) stands around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, own = shared.value
        for batch in batches:
            at, cuts = _joined(batch.column(0), codes.kind)
            c = own[np.append(codes.kind(0), at)]
            row, (word, place) = _struct_lists(batch.column(1))
            i = cuts[row] + place.to_numpy()  # the word's own place in c is i + 1
            yield pa.RecordBatch.from_arrays([word, pa.array((c[i] * CLASSES + c[i + 2]).astype(np.int32))], names=["word", "near"])

    # Counted first: a word's list is no longer than there are pairs of classes.
    counted = coded.select("codes", "rare").mapInArrow(run, "word binary, near int").groupBy("word", "near").agg(F.count("*").alias("n"))
    return counted.groupBy("word").agg(F.collect_list(F.struct("near", "n")).alias("near"))


def _odds(moves: np.ndarray) -> np.ndarray:
    """What a class before (0 to CLASSES) or after (from CLASSES on) speaks for each class of a word."""
    table = moves + 0.1
    odds = np.log(table) - np.log(table.sum(1, keepdims=True)) - np.log(table.sum(0, keepdims=True))
    return np.concatenate([odds, odds.T])


def placed(near: DataFrame, moves: np.ndarray) -> DataFrame:
    """(word, n, c) of each word: how often it occurs, and the class in which its neighbours raise the class bigram likelihood most.

    near: codes from 0 to 2 * CLASSES of one neighbour each for words that are numbers, of both for words that are bytes.
    """
    both = dict(near.dtypes)["word"] == "binary"
    # The end token's class 0 is a neighbour, never a place.
    gain = _odds(moves)[:, 1:]
    if both:
        gain = (gain[:CLASSES, None] + gain[None, CLASSES:]).reshape(CLASSES * CLASSES, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, (code, n) = _struct_lists(batch.column(1))
            code, n = code.to_numpy(), n.to_numpy()
            starts = np.searchsorted(row, np.arange(len(batch) + 1))
            at = 0
            while at < len(batch):  # so many neighbours at a time
                end = max(at + 1, int(np.searchsorted(starts, starts[at] + 50_000, side="right")) - 1)
                cut, first = slice(starts[at], starts[end]), starts[at:end] - starts[at]
                best = np.add.reduceat(gain[code[cut]] * n[cut, None], first, axis=0).argmax(1) + 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(np.add.reduceat(n[cut], first)), pa.array(best)], names=["word", "n", "c"])
                at = end

    return near.mapInArrow(run, f"word {'binary' if both else 'long'}, n long, c long")


def class_moves(classed: DataFrame) -> np.ndarray:
    """Counts of class pairs over all texts, each between two end tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            c = np.append(np.uint8(0), _joined(batch.column(0), np.uint8)[0]).astype(np.int64)
            held += np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(range(len(held)), pa.int64()), "n": pa.array(held)})

    out = np.zeros(CLASSES * CLASSES)
    for r in classed.select("classes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r.pair] = r.n
    return out.reshape(CLASSES, CLASSES)


def class_model(vocabulary: DataFrame, docs: DataFrame, table: int) -> dict:
    """The texts in codes, the classes of all training words, and the table's counts; what is broadcast is bounded by parameters."""
    columns = vocabulary.orderBy(F.desc("n"), "word").limit(table).toArrow()
    top = list(zip(columns.column("word").to_pylist(), columns.column("n").to_pylist(), strict=True))
    words = [w for w, _ in top[:WORDS]]
    ending = F.substring("word", -3, 3)
    least = top[len(words) - 1] if words else None
    others = vocabulary.where(F.lit(False)) if least is None else vocabulary.where((F.col("n") < least[1]) | ((F.col("n") == least[1]) & (F.col("word") > F.lit(bytearray(least[0])))))
    endings = [bytes(r.e) for r in others.groupBy(ending.alias("e")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "e").limit(ENDINGS).collect()]
    codes = Codes(Units(words, endings), [w for w, _ in top])
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(codes)
    coded = stored(encoded(docs, shared), "lm-codes")
    training = coded.where("not held_out")
    pairs = unit_bigrams(training, shared)
    classes = Classes(codes, exchange(pairs))
    member = np.zeros((codes.units.size, CLASSES))
    member[np.arange(codes.units.size), classes.cls] = 1
    moves = member.T @ pairs @ member
    # Words are exchanged one by one against the classes they start in, those of their units.
    start = context.broadcast((codes, classes.own.copy()))
    classes.rare = stored(placed(rare_contexts(training, start), moves), "lm-rare")
    if len(top) > len(words):
        for r in placed(contexts(training, start), moves).select("word", "c").toLocalIterator():
            classes.own[r.word] = r.c
    return {"classes": classes, "coded": coded, "n": np.array([n for _, n in top], np.int64)}


def classed(model: dict, n_docs: int, base: float) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, held_out, n_tokens, known, base, part, classes) of each text, the part still without transitions and class sizes; and what the classes keep for unseen words."""
    classes, n = model["classes"], model["n"]
    codes, coded = classes.codes, model["coded"]
    singles = np.bincount(classes.own[1 : len(n) + 1][n == 1], minlength=CLASSES).astype(np.float64)
    for r in classes.rare.where("n = 1").groupBy("c").agg(F.count("*").alias("n")).collect():
        singles[r.c] += r.n
    spare = np.maximum(singles, 1.0)
    spare[0] = 1.0 if not n_docs else 1e-9  # the end token is never unseen once trained
    # What each code adds; words beyond the table count as unseen until they meet their row of rare.
    beyond = len(codes.unit) - 1 - len(n)
    known = np.concatenate([[int(n_docs > 0)], np.ones(len(n), np.int64), np.zeros(beyond, np.int64)])
    log_base = np.log10(np.concatenate([[n_docs], n, np.zeros(beyond)]) + 0.5) - base
    log_n = np.log10(np.concatenate([[n_docs or spare[0]], n, spare[classes.own[len(n) + 1 :]]]))
    shared = coded.sparkSession.sparkContext.broadcast((codes.kind, classes.own.astype(np.uint8), known, log_base, log_n, np.log10(spare)))
    found = coded.select("row", F.inline("rare")).join(classes.rare, "word").groupBy("row").agg(F.collect_list(F.struct("place", "n", "c")).alias("found"))
    none = F.array().cast("array<struct<place: int, n: bigint, c: bigint>>")
    met = coded.drop("rare").join(found, "row", "left").select("doc_id", "held_out", "codes", F.coalesce("found", none).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, own, known, log_base, log_n, log_spare = shared.value
        for batch in batches:
            if not len(batch):
                continue
            at, cuts = _joined(batch.column(2), kind)
            c = own[at]
            row, (place, n, rare_c) = _struct_lists(batch.column(3))
            i, n = cuts[row] + place.to_numpy(), n.to_numpy()
            more = lambda x: np.bincount(row, x, len(batch))  # noqa: B023, E731
            summed = lambda x: np.add.reduceat(x[at], cuts[:-1])  # noqa: B023, E731
            tokens = np.diff(cuts)
            b = summed(log_base) + more(np.log10(n + 0.5) - np.log10(0.5))
            part = summed(log_n) + more(np.log10(n) - log_spare[c[i]])
            seen = summed(known) + np.bincount(row, minlength=len(batch))
            c[i] = rare_c.to_numpy()
            raw = [c[x:y].tobytes() for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, (tokens, seen, b, part)), pa.array(raw, pa.binary())], names=names)

    names = ["doc_id", "held_out", "n_tokens", "known", "base", "part", "classes"]
    return stored(met.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, known long, base double, part double, classes binary"), "lm-classes"), spare


def scored(docs: DataFrame, table: int = TABLE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    training = docs.where("not held_out")
    vocabulary = stored(count_words(training), "lm-words")
    n_docs = training.count()
    n, v = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, types = n + n_docs, v + (n_docs > 0)
    model = class_model(vocabulary, docs, table)
    parts, spare = classed(model, n_docs, np.log10(tokens + 0.5 * (types + 1)))
    discard(vocabulary, model["coded"])
    moves = class_moves(parts.where("not held_out"))
    share = (moves.sum(0) + 0.5) / (moves.sum() + 0.5 * CLASSES)
    step = np.log10((moves + CLASSES * share) / (moves.sum(1, keepdims=True) + CLASSES))
    # A class's size counts at every word of it, with the step that leads there.
    shared = docs.sparkSession.sparkContext.broadcast((step - np.log10(moves.sum(0) + spare)).ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        for batch in batches:
            if not len(batch):
                continue
            c, cuts = _joined(batch.column(6), np.uint8)
            c = np.append(np.uint8(0), c).astype(np.int64)
            score = batch.column(5).to_numpy() + np.add.reduceat(steps[c[:-1] * CLASSES + c[1:]], cuts[:-1])
            train = pa.array(np.full(len(batch), tokens), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], train, batch.column(4), pa.array(score)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return parts.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
