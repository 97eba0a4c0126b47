"""Source divergence, collocations and near-duplicate vectors against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from placemark.llm import collocations, divergence, vector_dedup

ODD = [None, "", " ", "...", "a", "é È ß", "x " * 3000, "Same text here, twice", "Same text here, twice", "\n\t.;", "a b 1c2d"]


def documents(spark, rows):
    """Rows with extra columns whose names the operators use themselves."""
    wide = [(*r, "t", "n", 1, "v") for r in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, term string, n string, value int, phrase string")


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(41)
    words = [a + b for a in ("th", "er", "on", "é", "Z") for b in ("", "an", "in", "ou")]
    line = lambda k: " ".join(r.choices(words[k:] + words[:5], k=r.randint(1, 30))) + r.choice([".", "\n", "; x1", ""])
    rows = [(i, "".join(line(i % 7) for _ in range(r.randint(0, 6))), r.choice(["en", "en", "fr", None, ""]), r.choice(["a", "b", "c", None, "", "d" + str(i % 9)])) for i in range(260)]
    rows += [(None, t, "en", "a") for t in ODD] + [(5, t, None, None) for t in ODD] + [(7, "rare words only", "xx", s) for s in ("p", "q", None)] + [(8, None, "yy", "p")]
    return rows


def brute_audit(rows, least=10, top=10):
    by, lang_df, occurring = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        occurring[lang].add(source)
        by[lang, source].update(terms)
        lang_df[lang].update(set(terms))
    out = []
    for lang, sources in occurring.items():
        kept = [t for t, n in lang_df[lang].items() if n >= least]

        def chances(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p = {s: chances(by[lang, s]) for s in sources}
        q = chances(sum((by[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) * (a - b) // (a + b)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources - {s})
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if by[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, i.decode(), -v, k + 1) for part, found in (("pair", pairs), ("term", terms)) for k, (v, i) in enumerate(found)]
    return Counter(out)


@pytest.mark.parametrize("parameters", [{}, {"a_seat": 1, "max_seats": 100, "cell": 4}, {"a_seat": 2, "max_seats": 3, "cell": 16}])
def test_audit(spark, corpus, parameters):
    got = divergence.audit(documents(spark, corpus), **parameters).collect()
    assert Counter((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got) == brute_audit(corpus)
    assert any(r.lang == "xx" and r.part == "pair" and r.value == 0 for r in got) and any(r.part == "term" for r in got)


def test_audit_passes_counts_on(spark, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 10)
    batches = [documents(spark, corpus).select("lang", "source", "text").toArrow().combine_chunks().to_batches()[0]]
    n, df = Counter(), Counter()
    for b in divergence._counted(iter(batches)):
        for row in b.to_pylist():
            n[row["lang"], row["source"], row["term"]] += row["n"]
            df[row["lang"], row["term"]] += row["df"]
    terms = [(x[2], x[3], [t.decode() for t in divergence.terms_of(x[1])]) for x in corpus]
    assert +n == Counter((a, b, t) for a, b, ts in terms for t in ts)
    assert +df == Counter((a, t) for a, _, ts in terms for t in set(ts))


def test_probability_is_exact():
    r = random.Random(3)
    for words in (0, 9, 10**6, 10**12, 9 * 10**15 - 100):
        counts = [min(words, r.choice([0, 1, 7, words // 3, words])) for _ in range(20)]
        for terms in (1, 40):
            want = [1 + 1_000_000_000 * (c + 2) // (words + 2 * terms) for c in counts]
            assert divergence.probability(np.array(counts), words, terms).tolist() == want


def test_vectors_packed():
    ids, counts = np.array([0, 3, 4, 70_000]), np.array([1, 10**15, 2, 3])
    assert [x.tolist() for x in divergence.unpacked(divergence.packed(ids, counts))] == [ids.tolist(), counts.tolist()]
    assert [len(x) for x in divergence.unpacked(None)] == [0, 0]


@pytest.mark.parametrize("seats", [2, 4, 6, 14])
def test_tournament(spark, seats):
    """Every two seats meet once, and both agree who meets whom."""
    turns = spark.range(seats).select("id", *(divergence.partner(F.col("id"), F.lit(seats), t).alias(f"t{t}") for t in range(seats - 1))).collect()
    met = Counter()
    for r in turns:
        for t in range(seats - 1):
            other = next(x for x in turns if x.id == r[f"t{t}"])
            assert other[f"t{t}"] == r.id and other.id != r.id
            met[r.id, other.id] += 1
    assert len(met) == seats * (seats - 1) and set(met.values()) == {1}


def brute_phrases(rows, least=10, kept=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        many = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        found = []
        for g, a in many.items():
            score, k = min((1_000_000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
            longer = [b for h, b in many.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
            if not any(100 * b >= 50 * a for b in longer):
                found.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:kept])]
    return Counter(out)


@pytest.mark.parametrize("parameters", [{}, {"shard": 50, "bits": 64}, {"least": 3, "kept": 7, "shard": 500, "bits": 1 << 12}, {"least": 1, "shard": 1}])
def test_phrases(spark, corpus, parameters):
    rows = [*corpus, *[(900 + i, "new york city. New York, new york", "en", "a") for i in range(9)], *[(950 + i, "a b a b a b a", "fr", None) for i in range(4)]]
    got = collocations.phrases(documents(spark, rows), **parameters).collect()
    want = brute_phrases(rows, parameters.get("least", 10), parameters.get("kept", 2000))
    assert Counter((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == want


def test_suffix_order():
    r = random.Random(9)
    for depth in (1, 2, 3, 4, 5, 7):
        ids = np.array([r.randint(0, 3) for _ in range(r.randint(1, 200))], np.int32)
        at = np.array(sorted(r.sample(range(len(ids)), len(ids) // 2 + 1)))
        order, shared = collocations.suffix_order(ids, at, depth)
        suffix = lambda i: [*ids[i : i + depth].tolist(), *[0] * depth][:depth]  # noqa: E731, B023
        assert sorted(order.tolist()) == at.tolist() and [suffix(i) for i in order] == sorted(suffix(i) for i in at)
        for k in range(1, len(order)):
            x, y = ids[order[k - 1] :][:depth].tolist(), ids[order[k] :][:depth].tolist()
            same = next((i for i, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))
            assert shared[k] == same or min(len(x), len(y)) < depth


def brute_vectors(rows, cosine=0.93):
    good = [i for i, (_, label, e) in enumerate(rows) if label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, i in enumerate(good):
        for j in good[x + 1 :]:
            a, b = (np.array(rows[k][2], float) for k in (i, j))
            a, b = a / np.abs(a).max(), b / np.abs(b).max()
            if rows[i][1] == rows[j][1] and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least: dict = {}
    for i, (vec, _, _) in enumerate(rows):
        least.setdefault(find(i), []).append(vec)
    ids = {k: min((v for v in vs if v is not None), default=None) for k, vs in least.items()}
    return Counter((rows[i][0], links[i], ids[find(i)], rows[i][0] == ids[find(i)]) for i in range(len(rows)))


def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, label int, embedding array<{kind}>, node int, bucket string")


@pytest.fixture(scope="module")
def points():
    r = np.random.default_rng(5)
    rows, vec = [], 0

    def add(label, e):
        nonlocal vec
        rows.append((vec, label, None if e is None else [None if x is None else float(x) for x in e]))
        vec += 1

    for label in (0, 1, 2):
        for _ in range(60):
            base = r.standard_normal(24)
            add(label, base)
            for _ in range(r.integers(0, 4)):  # about the threshold, on both sides
                noise = r.standard_normal(24)
                add(label, base / np.linalg.norm(base) + noise / np.linalg.norm(noise) * r.uniform(0.01, 0.6))
    hub = r.standard_normal(24)
    for _ in range(70):
        add(1, hub + 0.02 * r.standard_normal(24))
    for _ in range(40):
        add(2, hub)  # equal ones
    for e in (None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24, [1e300] * 24, [1e-300] * 24, hub[:7], hub[:7] * 3):
        add(1, e)
    for label in (None, None, 7):
        add(label, hub)
    rows += [(None, 0, rows[0][2]), (None, 9, list(map(float, hub))), (None, None, None), (3, 9, [1.0, 0.0]), (3, 9, [1.0, 0.0]), (3, 9, [0.0, 1.0])]
    return rows


@pytest.mark.parametrize("parameters", [{}, {"a_pass": 30, "block": 8}])
def test_vectors(spark, points, parameters):
    got = vector_dedup.linked_vectors(vectors(spark, points), **parameters).collect()
    assert len(got) == len(points)
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_vectors(points)


def test_vectors_in_a_chain(spark):
    """Neighbours on an arc link, ends do not; one component, by the least id."""
    step = 0.25
    rows = [(100 - i, 4, [float(np.cos(i * step)), float(np.sin(i * step))]) for i in range(12)]
    got = vector_dedup.linked_vectors(vectors(spark, rows, "float")).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_vectors([(v, l, np.float32(e).tolist()) for v, l, e in rows])
    assert {r.component_id for r in got} == {89}


def test_vectors_recall(spark):
    """Pairs right above the threshold, where a table misses most, are found."""
    r = np.random.default_rng(8)
    rows = []
    for k in range(1500):
        a, b = r.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = r.uniform(0.9301, 0.94)
        rows += [(2 * k, 0, a.tolist()), (2 * k + 1, 0, (c * a + np.sqrt(1 - c * c) * b).tolist())]
    got = vector_dedup.linked_vectors(vectors(spark, rows)).collect()
    assert sum(x.n_links for x in got) / 3000 >= 0.995


def test_tables_follow_the_threshold():
    for rows in (10, 5000, 10**7, 10**10):
        k, tables = vector_dedup.plan(rows)
        assert (1 - vector_dedup.collide(np.sqrt(0.14)) ** k) ** tables <= vector_dedup.MISS
        assert rows * vector_dedup.collide(np.sqrt(2)) ** k <= vector_dedup.FILL
    r, wide, d = np.random.default_rng(1), vector_dedup.WIDE, 0.374
    x, b = r.standard_normal(200_000) * d, r.uniform(0, wide, 200_000)
    assert abs((np.floor(b / wide) == np.floor((b + x) / wide)).mean() - vector_dedup.collide(d)) < 0.005


def test_empty_tables(spark):
    none = documents(spark, [])
    assert divergence.audit(none).count() == 0
    assert collocations.phrases(none).count() == 0
    assert vector_dedup.linked_vectors(vectors(spark, [])).count() == 0
    # Rows, but nothing in them.
    bare = documents(spark, [(None, None, None, None)] * 3)
    assert divergence.audit(bare).count() == 0 and collocations.phrases(bare).count() == 0
    assert vector_dedup.linked_vectors(vectors(spark, [(1, 1, None)])).collect()[0][:] == (1, 0, 1, True)
