"""Line and substring dedup, n-gram join, language model, decontamination and page text against brute force."""

import itertools
import math
import random
import sys
import time
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from placemark.llm import class_lm, common, decontaminate, html_text, line_dedup, ngram_join, substring_dedup

ODD = [None, "", " ", "a", "a b", "x " * 4000, "same text here twice", "same text here twice", "é ü\nß", "\n\n\n"]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "other") for i, t in rows], "doc_id long, text string, rid string")


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    word = lambda: "".join(r.choices(["th", "er", "on", "é"], k=r.randint(1, 4)))
    line = lambda: " ".join(word() for _ in range(r.randint(3, 12)))
    texts = ["\n".join(line() for _ in range(r.randint(1, 25))) for _ in range(60)]
    passage = "\n".join(line() for _ in range(20))
    texts += [t + "\n" + passage for t in texts[:8]] + texts[:5] + [passage + "\n" + t for t in texts[8:12]]
    for t in texts[:15]:  # near copies
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    rows = list(enumerate(texts + ODD))
    return rows + [(None, "null id text"), (3, texts[3])]


def brute_components(rows, size, percent):
    sets: dict = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.setdefault(i, set()).add(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations([(i, s) for i, g in sets.items() for s in g if s], 2):
        if i is not None and j is not None and i != j and 100 * len(a & b) >= percent * len(a | b):
            i, j = find(i), find(j)
            root[max(i, j)] = min(i, j)
    return {i: None if i is None else find(i) for i in sets}, sets


@pytest.mark.parametrize("size,percent,cell,frequent", [(3, 90, 50, 32), (5, 80, 10_000, 2), (3, 80, 100, 1)])
def test_join(spark, corpus, size, percent, cell, frequent):
    want, sets = brute_components(corpus, size, percent)
    got = ngram_join.linked_components(table(spark, corpus), size, percent, cell, frequent).collect()
    assert len(got) == len(corpus)
    assert all(r.component_id == want[r.doc_id] and r.n_shingles in {len(s) for s in sets[r.doc_id]} for r in got)


def test_join_large_clusters(spark):
    """Copies of an original that do not link with each other, chains of them, and strangers that share much."""
    r = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    origin = r.choices(words, k=60)
    rows = [(0, " ".join(origin))]
    chain = list(origin)
    for k in range(1, 60):
        copy = list(origin)
        for at in r.sample(range(60), r.choice([1, 2, 4, 9])):
            copy[at] = f"new{k}x{at}"
        rows.append((k, " ".join(copy)))
        chain[(7 * k) % 60] = f"link{k}"
        rows.append((100 + k, " ".join(chain)))
    for size, percent, cell in ((2, 80, 150), (1, 80, 100)):
        want, _ = brute_components(rows, size, percent)
        got = {x.doc_id: x.component_id for x in ngram_join.linked_components(table(spark, rows), size, percent, cell).collect()}
        assert got == want


@pytest.mark.parametrize("percent", [50, 60, 80, 90, 99, 100])
def test_join_prefixes_meet(percent):
    for a in range(1, 300):
        for b in range(a, a * 100 // percent + 1):
            common = -(-(a + b) * percent // (100 + percent))  # of two sets that just link
            if common <= a:
                # With all else first in the order, a shared shingle still lies in both prefixes.
                assert all(n - common < ngram_join.prefix_length(n, percent) for n in (a, b))


def test_join_frequent_outside_the_zone(spark, monkeypatch):
    """A line of three words that many short texts share, and that none has in its zone, is known as frequent."""
    monkeypatch.setattr(ngram_join, "SAMPLED", 2)
    zone = int(ngram_join._zone(90))
    shared = next(t for t in (f"all rights {i}" for i in range(1000)) if zone < int(next(ngram_join.each_shingles([t], 3))[0]) < 1.1 * zone)
    rows = [(k, f"{shared} a{k} b{k}") for k in range(400)]
    longer = [f"c{i}" for i in range(60)]
    rows += [(1000 + k, " ".join([shared, *longer[: 60 - k]])) for k in range(8)]
    docs = table(spark, rows)
    often = ngram_join.frequent_shingles(ngram_join.document_sets(docs, 3, 90))
    assert next(ngram_join.each_shingles([shared], 3))[0] in often
    sent = ngram_join.ordered_shingles(docs, 3, 90, often)
    assert sent.where("kind < 2").groupBy("h").count().agg({"count": "max"}).first()[0] <= 8
    want, _ = brute_components(rows, 3, 90)
    assert {r.doc_id: r.component_id for r in ngram_join.linked_components(docs, 3, 90).collect()} == want and want[1007] == 1000


def test_join_copies_in_several_tasks(spark):
    """A copy in another task is no other set: its shingles are not told as shared. A task packs a run of its shingles, a row for each part."""
    r = random.Random(15)
    texts = [[f"w{r.randrange(10**6)}" for _ in range(60)] for _ in range(30)]
    rows = [(100 * c + k, " ".join(t)) for c in range(3) for k, t in enumerate(texts)] + [(1000, " ".join([*texts[7][:-1], "other"]))]
    docs = table(spark, rows).repartition(6)
    packed = ngram_join.packed_shingles(docs, 3, 90, np.zeros(0, np.uint64), 4)
    assert packed.count() <= 6 * (4 + 1)
    kept = ngram_join.prefixes(common.stored(ngram_join.shared_shingles(packed), "shared"))
    assert kept.select("d", "d2").distinct().count() == 2 and kept.count() == kept.distinct().count()
    got = {x.doc_id: x.component_id for x in ngram_join.linked_components(docs, 3, 90).collect()}
    assert got == {k: 7 if k == 1000 else k % 100 for k, _ in rows}


def test_join_short_texts(spark):
    rows = []
    for k, n in enumerate(range(8, 15)):
        words = [f"t{k}w{i}" for i in range(n + 1)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[:-1]))]
    want, _ = brute_components(rows, 3, 90)
    got = {r.doc_id: r.component_id for r in ngram_join.linked_components(table(spark, rows), 3, 90).collect()}
    assert got == want and want[31] == 30


def test_join_repeated_id(spark):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]
    rows = [(0, texts[0]), (0, texts[1]), (1, texts[0] + " more"), (2, texts[1] + " more"), (0, texts[0])]
    got = ngram_join.linked_components(table(spark, rows), 3, 90).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {0}
    a, b = texts
    shared = [(2, a), (5, a), (5, b), (7, b)]
    assert {r.component_id for r in ngram_join.linked_components(table(spark, shared), 3, 90).collect()} == {2}
    shared = [(5, a), (5, b), (7, a + " more"), (8, b + " more")]
    assert {r.component_id for r in ngram_join.linked_components(table(spark, shared), 3, 90).collect()} == {5}
    # Of one document both texts stay.
    assert sorted(r.text for r in ngram_join.one_of_each(table(spark, [*shared, (5, a)])).collect()) == [a, b]


def test_one_of_each(spark, corpus):
    df = table(spark, corpus)
    left = ngram_join.one_of_each(df)
    assert left.columns == df.columns
    want, _ = brute_components(corpus, 5, 80)
    assert Counter(r.doc_id for r in left.collect()) == Counter(i for i in want if want[i] == i or i is None)


def test_empty_tables(spark):
    none = table(spark, [])
    assert ngram_join.linked_components(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert line_dedup.remove_repeated_chunks(none).count() == 0
    assert class_lm.scored(none).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(none, bench).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == 0


def brute_repeats(rows, length):
    starts = Counter(t.encode()[x : x + length] for _, t in rows if t for x in range(len(t.encode()) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = set()
        for x in range(len(b) - length + 1):
            if starts[b[x : x + length]] > 1:
                gone.update(range(x, x + length))
        spans = sum(1 for y in gone if y - 1 not in gone)
        out.append((i, len(b), len(gone), spans, sha256(bytes(b[y] for y in range(len(b)) if y not in gone)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length,widths,group", [(400, (200, 25, 1), 4096), (40, (20, 5, 1), 4), (40, (20, 5, 1), 4096)])
def test_substring_dedup(spark, corpus, length, widths, group):
    rows = [*corpus, (500, "ab" * 300), (501, "z" * 900)]
    got = substring_dedup.remove_repeats(table(spark, rows), length, widths=widths, group=group)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_repeats(rows, length)


def test_substring_cores(spark, corpus):
    """Cores are repeats of their own length; a passage shorter than length that two texts hold shows there, and is kept."""
    r = random.Random(21)
    text = lambda n: "".join(r.choices("abcdefghij ", k=n))
    passage = text(330)
    rows = [*corpus, (700, text(900) + passage + text(900)), (701, text(500) + passage), (702, text(2000))]
    rows += [(None, f"{text(450)} {k}") for k in range(200)] + [(None, text(100) + passage + text(700))]
    got = substring_dedup.remove_repeats(table(spark, rows)).collect()
    core = substring_dedup.LENGTH + 1 - substring_dedup.WIDTHS[0]
    starts = Counter(t.encode()[x : x + core] for _, t in rows if t for x in range(len(t.encode()) - core + 1))
    covered = Counter()
    for i, t in rows:
        b, hit = (t or "").encode(), set()
        for x in range(len(b) - core + 1):
            if starts[b[x : x + core]] > 1:
                hit.update(range(x, x + core))
        covered[i, len(b), len(hit)] += 1
    assert all(any(r.n_core_bytes <= n for i, size, n in covered if (i, size) == (r.doc_id, r.n_bytes)) for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].n_removed == 0 and by[i].n_core_bytes >= core for i in (700, 701)) and by[702].n_core_bytes == 0
    # Many different texts without an id.
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 400)


def test_substring_shared_words(spark, corpus):
    """Every passage of 50 words that another row holds is told, also below 400 bytes; none within one row alone, or below 35 words."""
    r = random.Random(23)
    some = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 5))) for _ in range(n))
    shared, own, brief = (" ".join(some(1) for _ in range(n)) for n in (51, 60, 34))
    rows = [(700 + k, f"{some(r.randint(5, 300))} {shared}\n{some(r.randint(5, 300))}") for k in range(40)]
    rows += [(800, f"{own} {some(80)} {own}"), (801, f"{some(70)} {brief} {some(70)}"), (802, f"{some(70)} {brief} {some(70)}"), (803, some(400))]
    rows += [(804, own := some(90)), (804, own)] + corpus
    words = [(t or "").encode().split() for _, t in rows]
    holders: list = [{}, {}]
    for size, held in zip((substring_dedup.PASSAGE, substring_dedup.RUN), holders, strict=True):
        for k, w in enumerate(words):
            for x in range(len(w) - size + 1):
                held.setdefault(tuple(w[x : x + size]), set()).add(k)
    want = {}
    for (i, t), w in zip(rows, words, strict=True):
        long_, most = ({p for x in range(len(w) - size + 1) if len(held[tuple(w[x : x + size])]) > 1 for p in range(x, x + size)} for size, held in zip((substring_dedup.PASSAGE, substring_dedup.RUN), holders, strict=True))
        want.setdefault((i, len((t or "").encode())), []).append((len(long_) > 0, len(most)))
    got = substring_dedup.remove_repeats(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for x in got:
        assert any((x.n_shared_words > 0 or not told) and x.n_shared_words <= most for told, most in want[x.doc_id, x.n_bytes])
    by = {x.doc_id: x for x in got}
    assert all(by[700 + k].n_shared_words >= 35 and by[700 + k].n_removed == 0 for k in range(40))
    assert [by[i].n_shared_words for i in (800, 801, 802, 803)] == [0] * 4 and by[804].n_shared_words >= 50


def test_row_keys_differ(spark):
    rows = [(i, f"text {k}") for i in (None, -1, 7) for k in range(4000)]
    keys = {r[0] for r in table(spark, rows).select(common.row_key()).collect()}
    assert len(keys) == len(rows)


def test_deep_shallow_order():
    r = random.Random(5)
    for _ in range(500):
        strings = [bytes(r.choices(b"ab", k=r.randint(0, 70))) for _ in range(r.randint(1, 50))]
        strings += [s + b"b" * r.randint(0, 9) for s in strings[:20]]
        order, lcp = substring_dedup.deep_shallow(strings)
        assert [strings[i] for i in order] == sorted(strings) and sorted(order) == list(range(len(strings)))
        assert all(lcp[k] == substring_dedup.common_prefix(strings[order[k - 1]], strings[order[k]]) for k in range(1, len(order)))


def test_line_dedup_equal_rows(spark, monkeypatch):
    """Equal texts without an id lose all copies but one, as they do with ids of their own."""
    monkeypatch.setattr(common, "COPIES", 30)
    text = "\n".join(f"line {k} of the text" for k in range(400))
    rows = [(None, text)] * 100 + [(9, "a b\nc d\ne f")] * 3 + [(None, None)] * 2 + [(None, "one")] * 4
    got = line_dedup.remove_repeated_chunks(table(spark, rows)).collect()
    assert len(got) == len(rows) and sum(r.n_removed_lines for r in got if r.n_lines == 400) == 99 * 400
    assert Counter(r.text for r in got) == {text: 1, "": 101, "a b\nc d\ne f": 1, None: 2, "one": 4}
    alone = line_dedup.remove_repeated_chunks(table(spark, list(enumerate([text] * 100)))).collect()
    assert sum(r.n_removed_lines for r in alone) == 99 * 400


def test_substring_dedup_equal_rows(spark, monkeypatch):
    """Very many equal rows cost no more than one; their count is kept."""
    monkeypatch.setattr(common, "COPIES", 300)
    r = random.Random(31)
    text = "".join(r.choices("abcdefgh ", k=20_000))
    rows = [(None, text)] * 2000 + [(1, text[5000:9000] + "z" * 50), (2, "alone " * 3), (2, "alone " * 3), (3, text[:700]), (3, text[:700])]
    began = time.perf_counter()
    got = Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans) for x in substring_dedup.remove_repeats(table(spark, rows)).collect())
    assert got == {(None, 20_000, 20_000, 1): 2000, (1, 4050, 4000, 1): 1, (2, 18, 0, 0): 2, (3, 700, 700, 1): 2}
    assert time.perf_counter() - began < 60


def test_line_dedup(spark, corpus):
    got = line_dedup.remove_repeated_chunks(table(spark, corpus)).collect()
    assert len(got) == len(corpus)
    first: dict = {}
    for i, t in sorted({(-1 if i is None else i, t) for i, t in corpus if t is not None}):
        for k, (c, _, may) in enumerate(line_dedup.chunks(t)):
            if may:
                first.setdefault(c, (i, t, k))
    want, seen = Counter(), set()
    for i, t in corpus:
        # Of equal rows the first has what is its own, the others nothing that may go.
        left = [c for k, (c, _, may) in enumerate(line_dedup.chunks(t)) if not may or (first[c] == (-1 if i is None else i, t, k) and (i, t) not in seen)]
        seen.add((i, t))
        want[(i, None if t is None else b"\n".join(left).decode())] += 1
    assert Counter((r.doc_id, r.text) for r in got) == want
    assert sum(r.n_removed_chunks for r in got) > 0


def test_chunk_ends_shift():
    r = random.Random(6)
    lines = [str(r.random()).encode() for _ in range(200)]
    a, b = line_dedup.chunk_ends(lines), line_dedup.chunk_ends([b"new", *lines])
    assert len({x + 1 for x in a} & set(b)) > 0.8 * len(a)


def test_class_lm(spark, corpus):
    rows = [r for r in corpus if r[0] is not None] + [(1000 + k, corpus[k][1]) for k in range(60)]
    got = class_lm.scored(table(spark, rows), table=30).collect()
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens)
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_class_lm_score(spark, corpus, monkeypatch):
    """Given the classes, the score is what plain counting gives; words of the table beyond the head are exchanged too."""
    monkeypatch.setattr(class_lm, "WORDS", 12)
    monkeypatch.setattr(class_lm, "ENDINGS", 6)
    held: dict = {}
    whole = class_lm.class_model
    monkeypatch.setattr(class_lm, "class_model", lambda *a: held.setdefault("model", whole(*a)))
    rows = [*corpus, (None, "th er new"), (None, None), (3, corpus[3][1])]
    got = class_lm.scored(table(spark, rows), table=80).collect()
    classes = held["model"]["classes"]
    of = lambda words: [int(c) for c in classes.of(words)]
    assert of(list(classes.number)) != [int(c) for c in classes.cls[classes.units.of(list(classes.number))]]
    words = lambda t: (t or "").encode().lower().split()
    training = [words(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    n, moves = Counter(w for t in training for w in t), Counter()
    for t in training:
        moves.update(itertools.pairwise([0, *of(t), 0]))
    classes_n = class_lm.CLASSES
    into, out = Counter(), Counter()
    for (a, b), k in moves.items():
        out[a] += k
        into[b] += k
    total, singles = sum(moves.values()), Counter(of([w for w in n if n[w] == 1]))
    spare = lambda c: max(singles[c], 1) if c else 1e-9
    step = lambda a, b: (moves[a, b] + classes_n * (into[b] + 0.5) / (total + 0.5 * classes_n)) / (out[a] + classes_n)
    want = Counter()
    for i, t in rows:
        c = of(words(t))
        p = sum(math.log10(step(a, b)) for a, b in itertools.pairwise([0, *c, 0])) + math.log10(len(training) / (into[0] + spare(0)))
        p += sum(math.log10((n[w] or spare(k)) / (into[k] + spare(k))) for w, k in zip(words(t), c, strict=True))
        want[i, round(p, 6)] += 1
    assert Counter((r.doc_id, round(r.score, 6)) for r in got) == want


def test_class_lm_rare(spark, corpus, monkeypatch):
    """Words beyond the table are exchanged too: each goes where its neighbours speak for it most, not where its ending is."""
    monkeypatch.setattr(class_lm, "WORDS", 12)
    monkeypatch.setattr(class_lm, "ENDINGS", 6)
    held: dict = {}
    whole = class_lm.class_model
    monkeypatch.setattr(class_lm, "class_model", lambda *a: held.setdefault("model", whole(*a)))
    class_lm.scored(table(spark, corpus), table=30).count()
    classes, words = held["model"]["classes"], lambda t: (t or "").encode().lower().split()
    training = [words(t) for i, t in corpus if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    beyond = sorted({w for t in training for w in t} - classes.number.keys())
    first = lambda ws: classes.cls[classes.units.of(ws)] if ws else np.empty(0, int)
    k = class_lm.CLASSES
    moves, near = np.zeros((k, k)), {w: np.zeros((2, k)) for w in beyond}
    for t in training:
        c = [0, *first(t).tolist(), 0]
        np.add.at(moves, (c[:-1], c[1:]), 1)
        for i, w in enumerate(t):
            if w in near:
                near[w][0, c[i]] += 1
                near[w][1, c[i + 2]] += 1
    odds = np.log(moves + 0.1) - np.log((moves + 0.1).sum(1, keepdims=True)) - np.log((moves + 0.1).sum(0, keepdims=True))
    gain = lambda w: (near[w][0] @ odds + near[w][1] @ odds.T)[1:]
    got = classes.of(beyond)
    assert len(beyond) > 100 and all(math.isclose(gain(w)[c - 1], gain(w).max(), rel_tol=1e-9) for w, c in zip(beyond, got, strict=True))
    assert (got != first(beyond)).any() and classes.of([b"never seen"]).tolist() == first([b"never seen"]).tolist()


def test_class_lm_units():
    assert class_lm.WORDS >= 1024 and class_lm.ENDINGS >= 512


def test_exchange_raises_the_likelihood():
    import numpy as np

    r = np.random.Generator(np.random.PCG64(1))
    pairs = r.integers(0, 3, (30, 30)).astype(float)
    pairs[1:15, 15:] += 20  # two kinds of words that alternate
    pairs[15:, 1:15] += 20
    cls = class_lm.exchange(pairs, classes=3)
    assert cls[0] == 0 and len(set(cls[1:15])) == 1 and len(set(cls[15:])) == 1 and cls[1] != cls[15]


def test_decontamination(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choices(["th", "er", "on", "an", "re", "he", "st"], k=r.randint(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(30) + ". " + text(10) + ".") for i in range(12)] + [(50, None), (51, "")]
    docs = [(i, text(300)) for i in range(40)]
    docs += [(100 + i, text(80) + " " + t + " " + text(80)) for i, t in items[:12]]
    changed = [w for k, w in enumerate(items[0][1].upper().split()) if k % 8]
    docs += [(200, text(60) + " " + " ".join(changed) + " " + text(60)), (300, None), (301, ""), (None, text(20) + " " + items[1][1])]
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(100 + i, i) for i in range(12)} | {(200, 0), (None, 1)}
    clean = decontaminate.clean_documents(table(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {x.doc_id for x in clean.collect()} == set(range(40)) | {300, 301}


def test_decontamination_without_cosine(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    items = [" ".join(r.choices(words, k=r.choice([1, 2, 3, 15, 40, 150]))) + "." for _ in range(300)]
    docs = []
    for k, item in enumerate(items):
        own = item.split()
        if k % 3 == 1 and len(own) > 10:  # near-verbatim: a word in eight changed
            own[4::8] = ["other"] * len(own[4::8])
        text = r.choices(words + ["- ,", "none"], k=r.randint(0, 400))
        cut = r.randint(0, len(text))
        docs.append((k, " ".join(text[:cut] + own + text[cut:])))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for cosine in (2.0, decontaminate.COSINE):
        got = {(m.doc_id, m.item_id) for m in decontaminate.contaminated(table(spark, docs), benchmark, cosine).collect()}
        assert {(k, k) for k in range(len(items))} <= got
        assert all(decontaminate.lcs(decontaminate.plain_words(items[i]), decontaminate.plain_words(docs[d][1])) >= decontaminate.LOOSE * len(items[i].split()) for d, i in got)


def test_bounds_of_the_verdict(monkeypatch):
    """What the bounds turn down, the longest common subsequence turns down too, and few others reach it."""
    r = random.Random(31)
    calls = []
    whole = decontaminate.Sequence.lcs
    monkeypatch.setattr(decontaminate.Sequence, "lcs", lambda self, hits: calls.append(1) or whole(self, hits))
    for _ in range(400):
        words = [r.randint(0, 30) for _ in range(r.randint(3, 40))]
        region = [r.choice(words) if r.random() < 0.5 else r.randint(0, 60) for _ in range(r.randint(0, 120))]
        item, answer = decontaminate.Sequence(words), decontaminate.Sequence(words[-3:])
        n = decontaminate.lcs(words, region)
        assert n <= item.met(item.hits(region)) <= item.within(set(region)) <= item.words
        a = decontaminate.lcs(words[-3:], region)
        yes = n >= decontaminate.LOOSE * len(words) and (n >= decontaminate.COVERED * len(words) or a >= decontaminate.ANSWER * 3)
        assert decontaminate.verdict(item, answer, region)[0] == yes
    # One common word many times over is no reason to compare.
    calls.clear()
    item = decontaminate.Sequence([0] + list(range(40)))
    assert decontaminate.verdict(item, decontaminate.Sequence([38, 39]), [0] * 120) == (False, 0, 0) and not calls


def test_segment_sums():
    r = np.random.Generator(np.random.PCG64(7))
    for n, segments in ((1, 1), (40, 40), (500, 33), (700, decontaminate.SEGMENTS), (900, 2 * decontaminate.SEGMENTS + 1)):
        matrix, index, value = r.standard_normal((50, 24)).astype(np.float32), r.integers(0, 50, n), r.random(n, np.float32)
        starts = np.concatenate([[0], np.sort(r.choice(np.arange(1, n), segments - 1, replace=False))]) if n > 1 else np.zeros(1, np.int64)
        got = decontaminate.segment_sums(matrix, index, starts, value)
        assert np.allclose(got, np.add.reduceat(matrix[index] * value[:, None], starts, axis=0), atol=1e-4)


def test_words_are_looked_up_together():
    """All tokens of some texts by arrays, and each has the number that it has by itself."""
    r = random.Random(3)
    letters = list("abAB.,;()'\"!?[]{}  \n\t\x0b\x0c\r\x1c\x85\xa0\0éΣßİ\ud800")
    long = ["x" * n for n in (15, 16, 17, 40, 41)]
    for _ in range(60):
        texts = ["".join(r.choices(letters, k=r.choice([0, 1, 5, 30, 200]))) for _ in range(r.randint(0, 20))] + [" .".join(long) + ")", "." * 100, "", " \n"]
        held = {w for t in texts for w in decontaminate.plain_words(t)}
        words = sorted(w for w in held if r.random() < 0.6)
        number = {w: k for k, w in enumerate(words)}
        ids, cuts = decontaminate.Vocabulary(words).ids(texts)
        for k, t in enumerate(texts):
            alone = [number.get(x.strip(decontaminate._ENDS), -1) for x in t.lower().encode("utf-8", "surrogatepass").split()]
            assert ids[cuts[k] : cuts[k + 1]].tolist() == alone
    # Tokens that were never met before cost no calls of their own.
    vocabulary, calls = decontaminate.Vocabulary([b"%d" % k for k in range(500)]), []
    texts = [" ".join(f"{k}," for k in range(20_000))] * 3
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        ids, cuts = vocabulary.ids(texts)
    finally:
        sys.setprofile(None)
    assert cuts.tolist() == [0, 20_000, 40_000, 60_000] and (ids >= 0).sum() == 1_500 and len(calls) < 1_000


def test_sums_of_long_segments():
    """Segments of very unlike lengths, without a product for each row and segment beside it."""
    r = np.random.Generator(np.random.PCG64(9))
    matrix, index = r.standard_normal((50, 24)).astype(np.float32), r.integers(0, 50, 6000)
    starts = np.array([0, 1, 2, 5, 37, 70, 2200, 2201, 5999])
    assert np.allclose(decontaminate.segment_sums(matrix, index, starts), np.add.reduceat(matrix[index].astype(float), starts, axis=0), atol=1e-3)
    assert np.array_equal(decontaminate.segment_sums(matrix, index[:1], np.zeros(1, np.int64)), matrix[index[:1]])


def test_lcs():
    r = random.Random(9)
    for _ in range(300):
        a, b = ([r.choice([b"x", b"y", b"z"]) for _ in range(r.randint(0, 20))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(a, b) == t[-1][-1]


PAGES = {
    "<html><head><title>T</title><script>a<b</script></head><body><nav><a href=x>Home</a></nav><article><h1>One &amp; two</h1><p>Some <b>bold</b>\n text.<br>New</p><div class='comments'><p>Nice post</p></div></article><footer>f</footer>": "One & two\n\nSome bold text. New",
    "": "", "plain words only": None, "<p>unclosed <b>para<p>second": None, "<article><p>cut off <a hre": "cut off", "<!-- <article><p>x</p> --><main><p>Real text here</p></main><script>var a='<p>no</p>'": "Real text here",
    "<body><div id='sidebar'><p>side words here</p></div><form><p>your name</p></form><article><p>The main story.</p></article><div class='cookie-notice'>We use cookies</div></body>": "The main story.",
}


def test_page_text(spark):
    rows = [(i, "u", p) for i, p in enumerate(PAGES)] + [(None, None, None), (1, "u", "")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    for i, want in enumerate(PAGES.values()):
        if want is not None:
            assert by[i] == want
    assert by[None] == ""


_WORDS = " ".join(f"word{i}" for i in range(60))
_FRAMED = f"<nav><a href=/>home</a></nav>{{}}<footer><a href=/x>about us</a></footer>"
LAYOUTS = {
    f"<div class='layout has-sidebar'><article><h1>Title here</h1><p>{_WORDS}</p></article></div>": f"Title here\n\n{_WORDS}",
    f"<div class='content-sidebar-wrap'><article><p>{_WORDS}</p></article><aside class='sidebar'>other words</aside></div>": _WORDS,
    f"<article class='post no-comments'><p>{_WORDS}</p><div id='comments'><p>{_WORDS}</p><p>{_WORDS}</p></div></article>": _WORDS,
    f"<article><header class='entry-header'><h1>Title here</h1></header><p>{_WORDS}</p></article>": f"Title here\n\n{_WORDS}",
    f"<div class='post'><div class='post-header-inner'><h1>Title here</h1></div><p>{_WORDS}</p><div class='post-footer'>other words</div></div>": f"Title here\n\n{_WORDS}",
    f"<form id='aspnetForm'><nav><a href=/>home</a></nav><article><h1>Title here</h1><p>{_WORDS}</p></article><form><p>your name</p></form></form>": f"Title here\n\n{_WORDS}",
    f"<article><p title=don't>{_WORDS}</p><p>It's the end</p></article>": f"{_WORDS}\n\nIt's the end",
    f"<article><p>{_WORDS}<br>more <math><mi>x</mi><mo>=</mo><mn>2</mn></math> here</p><figure><img src=a><figcaption>What it shows</figcaption></figure></article>": f"{_WORDS} more x=2 here\n\nWhat it shows",
}


def test_page_layouts(spark):
    """Wrappers named after what they lack or hold, odd attributes, line breaks, captions and formulas keep their article."""
    rows = [(i, "u", _FRAMED.format(p), "x") for i, p in enumerate(LAYOUTS)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    for i, want in enumerate(LAYOUTS.values()):
        assert got[i] == want, i


@pytest.mark.parametrize("page", ["<div>word" * 50_000, "<b>" * 30_000 + "<p>x" * 30_000, "<li><div>" + "<b>" * 20_000 + "<li>x</li>" * 20_000, "<p " + 'a="x" ' * 50_000, "<div class='ad'>" * 20_000 + "x</div>" * 20_000])
def test_page_in_linear_time(page):
    begin = time.process_time()
    html_text.blocks(page)
    assert time.process_time() - begin < 5


def test_tree_on_pages_it_has_not_seen(spark):
    nodes = html_text.train(spark)
    rows = html_text.labelled_blocks(pages=300, seed=99)
    hits = Counter((html_text.is_main(nodes, dict(zip(html_text.FEATURES, x, strict=True))), y > 0.5) for x, y in rows)
    assert hits[True, True] >= 0.9 * (hits[True, True] + hits[True, False])
    assert hits[True, True] >= 0.9 * (hits[True, True] + hits[False, True])


def test_tree_fits_its_labels(spark):
    nodes = html_text.train(spark)
    rows = html_text.labelled_blocks()
    right = sum(html_text.is_main(nodes, dict(zip(html_text.FEATURES, x, strict=True))) == (y > 0.5) for x, y in rows)
    assert right >= 0.97 * len(rows)


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_meet_hot_and_cold_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT", hot)
    rows = spark.createDataFrame([(k, v) for k in range(6) for v in range(1 + 40 * (k == 2) + k)], "key long, v long")
    side = rows.groupBy("key").agg(common.F.count("*").alias("n")).where("key <> 4")
    got = common.meet(rows, side, ["key"]).select("key", "v", "n").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, rows.join(side, "key").select("key", "v", "n").collect()))


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), (3, 9), (10, None), (8, 6), (6, 4)] + [(20 + i, 21 + i) for i in range(15)] + [(100, k) for k in range(101, 140)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 9: 1, 4: 4, 5: 4, 6: 4, 8: 4} | {20 + i: 20 for i in range(16)} | {100 + i: 100 for i in range(40)}
    assert got == want


@pytest.mark.parametrize("tag", ["button", "title", "head", "script", "svg", "select"])
def test_unclosed_tags_in_linear_time(tag):
    """A raw element that never ends is looked for once, not at every place it opens."""
    page = "<html><body><article><p>" + "some words of an article " * 20 + "</p></article>" + f"<{tag}> x " * 400_000
    began = time.perf_counter()
    html_text.blocks(page)
    assert time.perf_counter() - began < 20
