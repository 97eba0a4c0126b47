"""Quality rules: word and line statistics, then language-specific perplexity bands.

The language model is a modified Kneser-Ney n-gram model over folded
characters, one a language. Spark counts the n-grams of all texts; as the
folded alphabet has ALPHABET symbols, there are at most ALPHABET ** ORDER of
them a language, however large the corpus, and the model is broadcast as sorted
arrays of hashes with their probabilities and back-off weights. A document is
scored under the model of its own language alone; if its perplexity per character
lies outside the language's band it is rejected: junk is either too surprising
or, repeating itself, too predictable.

The band is taken from the shortest interval that holds half of a language's
different scores, which junk does not move while it is less than about a third.
As a model that has read the junk is not surprised by it, the models are counted
REFITS times more from the documents inside the bands of the model before.

Defined results: a null or empty text has no words and fails the base rules; a
null language is a language of its own; rows are judged one by one, so repeated
rows agree and rows that share an id need not; a null id is returned as it is; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placemark.llm.common import discard, lean, stored

ALPHABET, ORDER = 48, 4
#: Symbols that the base rules count, and the least words a text must have.
SYMBOLS, LEAST_WORDS = b"#*$%&|<>", 50
#: A text's perplexity is that of its median passage of so many characters, so that
#: a quotation in another language does not tell against it.
PASSAGE = 100
#: The band reaches this many times half the width of the shortest half, which is
#: taken as no less than LEAST_SPREAD where a language has few documents.
REACH, LEAST_SPREAD, REFITS = 6.0, 0.003, 2
#: N-grams of the models that are held at once: those of four languages that have them all.
MOST = 4 * ALPHABET**ORDER
#: Tables of a language's n-grams that a task holds at once, and the characters from which on a table is begun.
TABLES, WORTH_A_TABLE = 4, 50_000
#: Characters from which on a text's scatter is taken as steady.
STEADY = 4000
_SPACE, _UPPER, _DIGIT, _STOP, _COMMA, _SIGN, _MARK, _OTHER = 0, 40, 41, 42, 43, 44, 45, 46


def _fold_table() -> np.ndarray:
    """Code point below 0x250 -> symbol: a-z, upper case as one, other letters dealt to 13."""
    out = np.full(0x250, _OTHER, np.int32)
    for cp in range(0x250):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if ch.isspace():
            out[cp] = _SPACE
        elif kind == "Lu":
            out[cp] = _UPPER
        elif "a" <= ch <= "z":
            out[cp] = 1 + cp - 97
        elif kind[0] == "L":
            out[cp] = 27 + cp % 13
        elif kind == "Nd":
            out[cp] = _DIGIT
        elif ch in ".?;:":
            out[cp] = _STOP
        elif ch in ",'-()\"":
            out[cp] = _COMMA
        elif ch in SYMBOLS.decode():
            out[cp] = _SIGN
        elif ch == "!":
            out[cp] = _MARK
    return out


_FOLD = _fold_table()


def folded(text: str) -> np.ndarray:
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = cps >= 0x250
    if wide.any():
        return np.where(wide, 27 + cps % 13, _FOLD[np.minimum(cps, 0x24F)]).astype(np.int32)
    return _FOLD[cps]


def gram_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the ORDER-grams that end at each character, texts end to end, and each text's length."""
    parts, sizes = [], np.array([len(t) for t in texts], np.int64)
    pad = np.zeros(ORDER - 1, np.int32)
    for t in texts:
        parts += [pad, folded(t)]
    if not parts:
        return np.empty(0, np.int32), sizes
    s = np.concatenate(parts)
    ids = s[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        ids += s[ORDER - 1 - back : len(s) - back] * ALPHABET**back
    # Grams that end in the padding of a later text are none.
    real = np.ones(len(ids), bool)
    at = np.cumsum(sizes + ORDER - 1)[:-1] - (ORDER - 1)
    for k in range(ORDER - 1):
        real[at + k] = False
    return ids[real], sizes


def _batches(rows: list[tuple[str, str]], chars: int = 500_000) -> Iterator[tuple[str, list[int]]]:
    """Row numbers by language, in runs of about so many characters."""
    by: dict[str, list[int]] = {}
    size: Counter = Counter()
    for i, (lang, text) in enumerate(rows):
        by.setdefault(lang, []).append(i)
        size[lang] += len(text)
        if size[lang] >= chars:
            yield lang, by.pop(lang)
            del size[lang]
    yield from by.items()


def count_grams(docs: DataFrame, inside: "Judge | None" = None) -> DataFrame:
    """(lang, gram, n) over all texts, or those that lie inside their band; each task sums its own rows first."""
    shared = docs.sparkSession.sparkContext.broadcast(inside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge, sums = shared.value, {}
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for lang, own in _batches(rows):
                ids, sizes = gram_ids([rows[i][1] for i in own])
                if judge:
                    ids = ids[np.repeat(judge.inside(lang, ids, sizes), sizes)]
                if lang not in sums and len(sums) >= TABLES:  # so many tables are held at once; others go on as they come
                    u, n = np.unique(ids, return_counts=True)
                    yield rows_of(lang, u, n)
                    continue
                held = sums.setdefault(lang, np.zeros(ALPHABET**ORDER, np.uint32))
                np.add.at(held, ids, np.uint32(1))
        yield from emit(sums)

    def emit(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, held in sums.items():
            ids = np.flatnonzero(held)
            yield rows_of(lang, ids, held[ids])

    def rows_of(lang: str, ids: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(ids), pa.string()), "gram": pa.array(ids.astype(np.int64), pa.int64()), "n": pa.array(n.astype(np.int64), pa.int64())})

    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.col("text").cast("string").alias("text")).where("text <> ''")
    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def hashed(ids: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash of n-gram ids of one order (splitmix64, a bijection)."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(order)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class KneserNey:
    """Modified Kneser-Ney probabilities in sorted hash arrays, one pair an order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order_ids, order_counts = [grams], [counts.astype(np.int64)]
        for n in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
            ids, cont = np.unique(order_ids[-1] % ALPHABET**n, return_counts=True)
            order_ids.append(ids)
            order_counts.append(cont)
        self.levels: list[tuple] = []
        for ids, c in zip(reversed(order_ids), reversed(order_counts), strict=True):
            n = len(self.levels) + 1
            of = [max(int((c == k).sum()), 1) for k in (1, 2, 3, 4)]
            y = of[0] / (of[0] + 2 * of[1])
            d = np.array([0.0] + [min(max(k - (k + 1) * y * of[k] / of[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)])
            cut = d[np.minimum(c, 3)]
            context, at = np.unique(ids // ALPHABET, return_inverse=True)
            total = np.bincount(at, weights=c)
            rest = np.bincount(at, weights=cut) / total
            lower = self.probability(ids % ALPHABET ** (n - 1), n - 1) if n > 1 else np.full(len(ids), 1 / ALPHABET)
            p = (c - cut) / total[at] + rest[at] * lower
            keys, marks = hashed(ids, n), hashed(context, n)
            i, j = np.argsort(keys), np.argsort(marks)
            self.levels.append((keys[i], p[i], marks[j], rest[j]))

    def probability(self, ids: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 0:
            return np.full(len(ids), 1 / ALPHABET)
        keys, p, marks, rest = self.levels[n - 1]
        found, at = _search(keys, hashed(ids, n))
        out = np.empty(len(ids))
        out[found] = p[at[found]]
        if not found.all():
            miss = ids[~found]
            known, where = _search(marks, hashed(miss // ALPHABET, n))
            out[~found] = np.where(known, rest[where], 1.0) * self.probability(miss % ALPHABET ** (n - 1), n - 1)
        return out


def _search(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


class Judge:
    """The models and, by language, the bands (middle, spread)."""

    def __init__(self, models: dict[str, KneserNey], bands: dict[str, tuple[float, float]], reach: float):
        self.models, self.bands, self.reach = models, bands, reach
        self.costs: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"costs": {}}

    def cost(self, lang: str, ids: np.ndarray) -> np.ndarray:
        """-log10 of the probability of each n-gram. What was worked out is kept in a table, for TABLES languages at once."""
        held = self.costs.pop(lang, None)
        if held is None and len(ids) < WORTH_A_TABLE:
            u, at = np.unique(ids, return_inverse=True)
            return -np.log10(self.models[lang].probability(u)).astype(np.float32)[at]
        if held is None:
            if len(self.costs) >= TABLES:
                del self.costs[next(iter(self.costs))]  # the one not used for longest
            held = np.full(ALPHABET**ORDER, np.nan, np.float32)
        self.costs[lang] = held
        out = held[ids]
        new = np.isnan(out)
        if new.any():
            u = np.unique(ids[new])
            held[u] = -np.log10(self.models[lang].probability(u))
            out = held[ids]
        return out

    def perplexity(self, lang: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 per character of the median passage of each of the texts, none of them empty."""
        starts, counts, lengths = _passages(sizes)
        means = np.add.reduceat(self.cost(lang, ids), starts, dtype=np.float64) / lengths
        means = means[np.lexsort((means, np.repeat(np.arange(len(counts)), counts)))]
        begin = np.cumsum(counts) - counts
        return (means[begin + (counts - 1) // 2] + means[begin + counts // 2]) / 2

    def inside(self, lang: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        middle, spread = self.bands[lang]
        return np.abs(self.perplexity(lang, ids, sizes) - middle) * np.sqrt(np.minimum(sizes, STEADY) / STEADY) <= self.reach * spread


def train(docs: DataFrame, inside: Judge | None = None) -> dict[str, KneserNey]:
    """A model a language; a language of which nothing lies inside keeps the model it has."""
    with lean(docs.sparkSession):
        counted = count_grams(docs, inside).toArrow()  # at most ALPHABET ** ORDER rows a language
    lang, gram, n = counted.column("lang").combine_chunks().dictionary_encode(), counted.column("gram").to_numpy(), counted.column("n").to_numpy()
    which = lang.indices.to_numpy()
    models = dict(inside.models) if inside else {}
    for k, name in enumerate(lang.dictionary.to_pylist()):
        own = np.flatnonzero(which == k)
        own = own[np.argsort(gram[own])]
        models[name] = KneserNey(gram[own], n[own])
    return models


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    b = np.frombuffer(raw, np.uint8)
    white = int(np.count_nonzero((b == 32) | ((b >= 9) & (b <= 13))))
    word_chars = len(text) - white
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeat = 0
    grams = list(zip(words, words[1:], words[2:]))
    if len(set(grams)) < len(grams):
        often = Counter(grams)
        hit = np.fromiter((often[g] > 1 for g in grams), bool, len(grams))
        cover = np.zeros(len(words), bool)
        for k in range(3):
            cover[k : k + len(hit)] |= hit
        repeat = int(cover.sum())
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeat


def _passages(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the passages of texts laid end to end, passages a text, and their lengths; a short rest joins the last."""
    counts = np.maximum(sizes // PASSAGE, 1)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = within * PASSAGE + np.repeat(np.cumsum(sizes) - sizes, counts)
    return starts, counts, np.diff(np.append(starts, sizes.sum()))


def scored(docs: DataFrame, models: dict[str, KneserNey], base: bool = True) -> DataFrame:
    """The base counts (if asked for) and log10_ppl, the perplexity per character, of every row; log10_ppl is null without text."""
    shared = docs.sparkSession.sparkContext.broadcast(Judge(models, {}, 0.0))
    schema = docs.select("doc_id").schema
    for name, kind in [("lang", "string"), *((n, "long") for n in ("n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("log10_ppl", "double")]:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in batches:
            langs, texts = batch.column(1).to_pylist(), [t or "" for t in batch.column(2).to_pylist()]
            counts = np.array([base_counts(t) if base else (0,) * 5 for t in texts], np.int64).reshape(-1, 5)
            ppl: list[float | None] = [None] * len(texts)
            for lang, own in _batches(list(zip(langs, texts, strict=True))):
                own = [i for i in own if texts[i]]
                if own:
                    for i, p in zip(own, judge.perplexity(lang, *gram_ids([texts[i] for i in own])).tolist(), strict=True):
                        ppl[i] = p
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(t) for t in texts], pa.int64()), *(pa.array(counts[:, k]) for k in range(5)), pa.array(ppl, pa.float64())],
                names=schema.names,
            )

    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def _shortest_half(values: str, n: int = 50) -> Column:
    """(width, middle) of the shortest interval that holds half of the values."""
    q = F.percentile_approx(values, F.array(*(F.lit(k / n) for k in range(n + 1))), 10_000)
    ends = lambda q: F.transform(F.sequence(F.lit(1), F.lit(n - n // 2 + 1)), lambda k: F.struct((F.element_at(q, k + n // 2) - F.element_at(q, k)).alias("width"), ((F.element_at(q, k + n // 2) + F.element_at(q, k)) / 2).alias("middle")))
    return F.array_min(ends(q))


def _steady() -> Column:
    """Short texts scatter more: distances times the root of the length make one band fit all lengths."""
    return F.sqrt(F.least(F.col("n_chars"), F.lit(STEADY)) / STEADY)


def bands(scores: DataFrame) -> DataFrame:
    """(lang, middle, spread), from the scores of different texts; a row a language."""
    different = scores.where("log10_ppl is not null").select("lang", "n_chars", "log10_ppl").distinct()
    middle = different.groupBy("lang").agg(_shortest_half("log10_ppl")["middle"].alias("middle"))
    # A row a language, as the models that are broadcast.
    off = different.join(F.broadcast(middle), "lang").withColumn("off", (F.col("log10_ppl") - F.col("middle")) * _steady())
    return off.groupBy("lang").agg(F.first("middle").alias("middle"), F.greatest(_shortest_half("off")["width"] / 2, F.lit(LEAST_SPREAD)).alias("spread"))


def language_groups(docs: DataFrame, most: int = MOST) -> list[list[str]]:
    """All languages, the largest first, in groups whose models hold at most so many n-grams together (or one language)."""
    size = F.least(F.sum(F.length(F.col("text").cast("string"))), F.lit(ALPHABET**ORDER))
    rows = docs.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.coalesce(size, F.lit(0)).alias("size")).orderBy(F.desc("size"), "lang").collect()
    groups: list[list[str]] = []
    held = most
    for r in rows:
        if held + r.size > most:
            groups.append([])
            held = 0
        groups[-1].append(r.lang)
        held += r.size
    return groups


def judged(docs: DataFrame, reach: float = REACH, least_words: int = LEAST_WORDS, refits: int = REFITS, most: int = MOST) -> DataFrame:
    """The counts, base_failed, log10_ppl with its language's middle and spread, and kept, for every row.

    Languages are worked off in groups, so that the models that are held and sent at
    once have a bound, however many languages there are.
    """
    scores = None
    groups = language_groups(docs, most)
    for names in groups or [[]]:
        own = docs.where(F.coalesce("lang", F.lit("")).isin(names)) if len(groups) > 1 else docs
        models = train(own)
        for _ in range(refits):
            fit = stored(scored(own, models, base=False), "quality-refit")
            found = {r.lang: (r.middle, r.spread) for r in bands(fit).collect()}
            discard(fit)
            models = train(own, Judge(models, found, reach))
        part = stored(scored(own, models), "quality")
        scores = part if scores is None else scores.unionByName(part)
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    scores = scores.withColumn("base_failed", failed)
    own = F.broadcast(bands(scores.where("not base_failed")))
    off = (F.col("log10_ppl") - F.col("middle")) * _steady()
    inside = F.coalesce(F.abs(off) <= F.col("spread") * reach, F.lit(False))
    return scores.join(own, "lang", "left").withColumn("off", off).withColumn("kept", ~F.col("base_failed") & inside)


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, each judged by itself."""
    columns = docs.columns
    # Rows are told apart by id and text, so that rows that share an id, or have none, go one by one.
    keyed = docs.withColumns({"__row_id": F.col("doc_id").cast("string"), "__row_text": F.sha2(F.col("text").cast("string"), 256), "__row_lang": F.col("lang").cast("string")})
    told = keyed.select(F.struct("__row_id", "__row_text", "__row_lang").alias("doc_id"), "lang", "text")
    bad = judged(told).where("not kept").select("doc_id.*").distinct().toDF("id", "hash", "lang_")
    same = F.col("__row_id").eqNullSafe(F.col("id")) & F.col("__row_text").eqNullSafe(F.col("hash")) & F.col("__row_lang").eqNullSafe(F.col("lang_"))
    return keyed.join(bad, same, "left_anti").select(*columns)
