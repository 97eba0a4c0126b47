"""Token counts, packing, mixing and quality rules."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from placemark.llm import common, mixing, packing, quality, token_counts

ODD = [None, "", " ", "  a  b ", "a\nb\n\nc", "\n", "x" * 5000, "▁mark ▁", "é ü 日本 🎵", "<s> </s> <unk>", "a\tb\r\nc", "word " * 3000, "same", "same"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i else None, t, ["en", "de", None][i % 3], [None, "s1", "s2"][i % 3], 0, i) for i, t in enumerate(ODD)] + [(5, ODD[5], "en", "s1", 0, 99)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_counts_are_the_library_s(spark, odd):
    sp = token_counts.processor(token_counts.default_model())
    got = token_counts.count_tokens(odd, sample_rows=2, entries=3, cache=4).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in odd.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_counts.count_tokens(empty(spark)).count() == 0


def test_pre_tokens_concatenate():
    sp, random_ = token_counts.processor(token_counts.default_model()), random.Random(4)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "日", ".", "▁", "\r", "ing"]
    for _ in range(3000):
        t = "".join(random_.choices(parts, k=random_.randint(0, 14)))
        units = token_counts.pre_tokens(t)
        if units is not None:
            assert sum((token_counts.encode_unit(sp, u) for u in units), []) == sp.encode(t)


def test_pack_round_trip(spark, odd):
    sp = token_counts.processor(token_counts.default_model())
    rows = packing.pack(odd, row_tokens=64, block_docs=5).collect()
    assert all(len(r.ids) == 2 * r.n_tokens and r.n_tokens <= 64 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1] and len(r.doc_ids) == r.n_segments for r in rows)
    pieces = packing.unpack(packing.pack(odd, row_tokens=64, block_docs=5)).collect()
    got: dict = {}
    for p in sorted(pieces, key=lambda p: p.piece_start):
        got.setdefault(p.doc_id, []).append(np.frombuffer(p.ids, np.uint16).tolist())
    for r in odd.where("doc_id <> 5 and text <> ''").collect():
        assert sum(got[r.doc_id], []) == sp.encode(r.text)
    assert packing.pack(empty(spark)).count() == 0
    matrix = packing.padded(packing.pack(odd, row_tokens=64, block_docs=5), 64, pad=1).collect()
    assert len(matrix) == len(rows) and all(len(r.ids) == 128 and set(np.frombuffer(r.ids, np.uint16)[r.n_tokens :]) <= {1} for r in matrix)


def test_premise_is_checked(spark, odd, monkeypatch):
    """A model whose pieces hold spaces inside encodes whole texts: the counts are the library's all the same."""
    assert token_counts.splits_at_spaces(token_counts.processor(token_counts.default_model()))
    want = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(odd).collect())
    monkeypatch.setattr(token_counts, "splits_at_spaces", lambda sp: False)
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(odd).collect()) == want


def test_best_fit_is_best_fit():
    random_ = random.Random(1)
    for _ in range(200):
        size = random_.randint(1, 40)
        lengths = [random_.randint(1, size) for _ in range(random_.randint(0, 60))]
        rows = packing.best_fit_decreasing(lengths, size)
        free: list[int] = []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fit = [f for f in free if f >= lengths[i]]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - lengths[i])
            else:
                free.append(size - lengths[i])
        assert sorted(x for r in rows for x in r) == list(range(len(lengths)))
        assert sorted(size - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def level(sizes, weights, cap=3):
    """Targets by resharing until none is above its cap."""
    total, target, open_ = sum(sizes), {}, set(range(len(sizes)))
    left = float(total)
    while open_:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] > cap * sizes[i]}
        if not over:
            return target | share
        for i in over:
            target[i] = float(cap * sizes[i])
            left -= target[i]
        open_ -= over
    return target


def test_mix_meets_targets(spark):
    random_ = random.Random(2)
    rows = [(i, "w " * random_.randint(0, 40), "s" + str(min(random_.randint(0, 9), 5))) for i in range(800)] + [(900 + i, "one two", None) for i in range(3)] + [(5000, "w w", "s0"), (5000, "w w", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    got = mixing.mixed(docs, slots=1 << 12, docs_a_bucket=20).collect()
    assert len(got) == len(rows) and all(r.taken <= 3 * r["size"] for r in got)
    source = {d: s for d, _, s in rows}
    names = sorted({s for s in source.values() if s}) + [None]
    sizes = [sum(len(t.split()) for _, t, s in rows if s == n) for n in names]
    want = level(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for i, n in enumerate(names):
        own = [r for r in got if source[r.doc_id] == n]
        assert {r.source_size for r in own} == {sizes[i]} and abs(own[0].target - want[i]) < 1e-6
        assert abs(sum(r.taken for r in own) - want[i]) <= 0.02 * want[i] + 10
    again = mixing.mixed(docs.repartition(7), slots=1 << 12, docs_a_bucket=20)
    assert Counter((r.doc_id, r.taken) for r in again.collect()) == Counter((r.doc_id, r.taken) for r in got)


@pytest.mark.parametrize("weights,sizes", [((5, 2, 1), [10] * 4), ((5, 2, 1), [7] * 300), ((5, 2, 1), [10, 4, 2, 10, 4, 2, 3]), ((1, 1), [3, 3, 0, 3]), ((5, 2, 1), [0, 0]), ((4, 1), [1, 400, 1, 400])])
def test_mix_targets_of_equal_levels(spark, weights, sizes):
    """Sources that fill at the same level share what bisection gives them."""
    rows = [(f"s{i:05}", n) for i, n in enumerate(sizes)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long"), weights).collect()}
    want = level(sizes, [weights[i % len(weights)] for i in range(len(sizes))])
    assert all(abs(got[name] - w) < 1e-6 * max(1, w) for (name, _), w in zip(rows, map(want.get, range(len(sizes))), strict=True))
    assert abs(sum(got.values()) - sum(sizes)) < 1e-6 * max(1, sum(sizes))


def test_mix_many_sources(spark):
    """Very many sources of one size: every one gives its target, in whole words."""
    n = 20_000
    docs = spark.range(n).selectExpr("id as doc_id", "repeat('w ', 24) as text", "concat('s', lpad(id, 6, '0')) as source")
    got = mixing.mixed(docs)
    total = got.agg(F.sum("taken"), F.sum("target"), F.max(F.abs(F.col("taken") - F.col("target"))), F.count("*")).first()
    assert total[3] == n and total[2] <= 1 and abs(total[1] - 24 * n) < 1e-3 and abs(total[0] - 24 * n) <= n


def test_mix_of_equal_rows(spark, monkeypatch):
    """Rows equal in id, text and source share what they give evenly; the same text in two sources is two documents."""
    monkeypatch.setattr(common, "COPIES", 7)
    rows = [(None, "one two three", "a")] * 100 + [(None, "", "a")] * 300 + [(None, "one two three", "b")] * 20 + [(i, "w " * 30, "b") for i in range(40)] + [(1, "x y", "c")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, source string, number long")
    placed = mixing.schedule(docs)[1]
    assert placed.count() == 44 and placed.agg(F.sum("copies")).first()[0] == len(rows)
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows)
    for size in (0, 3):
        for goal in {r.target for r in got if r["size"] == size}:
            own = [r.taken for r in got if r["size"] == size and r.target == goal]
            assert max(own) - min(own) <= 1 and max(own) <= 3 * size
    for goal, size in {(r.target, r.source_size) for r in got}:
        assert abs(sum(r.taken for r in got if r.target == goal and r.source_size == size) - goal) <= 1
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns
    whole = whole.collect()
    for source in "abc":
        words = sum(len(r.text.split()) for r in whole if r.source == source)
        assert abs(words - next(r.target for r in got if r.source_size == sum(len(x[1].split()) for x in rows if x[2] == source))) <= 31
    assert max(Counter(r.number for r in whole).values()) <= 3


def test_mix_small_sources(spark):
    rows = [(i, "w " * 100, "hot") for i in range(500)] + [(1000 + i, "one two three", f"s{i % 60}") for i in range(180)] + [(2000, "w", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs, slots=64).collect()
    source = {d: s for d, _, s in rows}
    for n in set(source.values()):
        own = [r for r in got if source[r.doc_id] == n]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1, n
        assert all(r.taken <= 3 * r["size"] for r in own)
    slots = mixing.schedule(docs, slots=64)[0].select("slot", "source").distinct().groupBy("slot").count()
    assert slots.where("count > 1").count() == 0


def test_mix_odd_tables(spark, odd):
    assert mixing.mixed(odd).count() == odd.count()
    assert mixing.mixed(empty(spark)).count() == 0
    assert mixing.mixed_documents(odd).columns == odd.columns


def brute_base(t):
    words = (t or "").encode().split()
    grams = list(zip(words, words[1:], words[2:]))
    many = {g for g, n in Counter(grams).items() if n > 1}
    lines = [x for x in (t or "").encode().split(b"\n") if x.split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum((t or "").count(c) for c in "#*$%&|<>"), sum(x in lines[:i] for i, x in enumerate(lines)),
        sum(any(0 <= k < len(grams) and grams[k] in many for k in (i - 2, i - 1, i)) for i in range(len(words))),
    )


def test_quality_costs_are_kept(monkeypatch):
    """An n-gram's probability is worked out once a table; scores are those of plain medians, with more languages than tables too."""
    monkeypatch.setattr(quality, "WORTH_A_TABLE", 500)
    r = random.Random(41)
    langs = [f"l{k}" for k in range(quality.TABLES + 2)]
    texts = {x: ["".join(r.choices("abcdefg .é日", k=r.randint(1, 900))) for _ in range(12)] for x in langs}
    grams = {x: quality.gram_ids(t) for x, t in texts.items()}
    models = {x: quality.KneserNey(*np.unique(ids[::2].astype(np.int64), return_counts=True)) for x, (ids, _) in grams.items()}
    judge = quality.Judge(models, {}, 0.0)

    def plain(lang, text):
        cost = -np.log10(models[lang].probability(quality.gram_ids([text])[0])).astype(np.float32)
        cuts = [k * quality.PASSAGE for k in range(max(len(text) // quality.PASSAGE, 1))]
        return np.median([cost[a:b].mean(dtype=np.float64) for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)])

    for x in langs * 2:
        assert np.allclose(judge.perplexity(x, *grams[x]), [plain(x, t) for t in texts[x]], rtol=0, atol=1e-9)
        assert len(judge.costs) <= quality.TABLES
    asked = []
    whole = quality.KneserNey.probability
    monkeypatch.setattr(quality.KneserNey, "probability", lambda self, ids, n=quality.ORDER: asked.append(len(ids)) or whole(self, ids, n))
    again = judge.perplexity(langs[-1], *grams[langs[-1]])
    assert not asked and (again == judge.perplexity(langs[-1], *grams[langs[-1]])).all()
    judge.perplexity(langs[-1], *quality.gram_ids(["abc" * 5]))  # short texts of a language without a table need none
    assert quality.Judge(models, {}, 0.0).perplexity("l0", *quality.gram_ids(["abc" * 5])).shape == (1,)


def test_quality_base(spark, odd):
    got = quality.judged(odd).collect()
    want = Counter((r.doc_id, *brute_base(r.text)) for r in odd.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.judged(empty(spark)).count() == 0
    assert quality.kept_documents(odd).columns == odd.columns


def test_kneser_ney_is_a_distribution():
    texts = ["the cat sat on the mat and the dog ran", "a cat and a dog"]
    ids, _ = quality.gram_ids(texts)
    grams, n = np.unique(ids, return_counts=True)
    model = quality.KneserNey(grams, n)
    for context in (grams[0] // quality.ALPHABET, grams[-1] // quality.ALPHABET, 12345):
        p = model.probability(context * quality.ALPHABET + np.arange(quality.ALPHABET))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_quality_tells_junk(spark):
    random_ = random.Random(3)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    text = lambda: " ".join("".join(random_.choices(syllables, k=random_.randint(1, 4))) for _ in range(120))
    rows = [(i, text(), "en") for i in range(300)] + [(1000 + i, " ".join("".join(random_.choices("%#QZ9!xkw|Y7", k=6)) for _ in range(120)), "en") for i in range(10)]
    got = quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert sum(r.kept for r in got if r.doc_id < 1000) >= 297 and not any(r.kept for r in got if r.doc_id >= 1000)


def test_quality_where_a_third_is_junk(spark):
    """Junk of many kinds, copies of junk, and text of another language under a wrong name go; the rest stays."""
    random_ = random.Random(4)
    tongues = {"en": ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"], "xy": ["oux", "ei", "la", "ç", "eau", "que", "ño", "is"]}
    text = lambda lang, n=140: " ".join("".join(random_.choices(tongues[lang], k=random_.randint(1, 4))) for _ in range(n))
    rows = [(i, text(lang, random_.randint(60, 300)), lang) for i, lang in enumerate(["en"] * 300 + ["xy"] * 300)]
    good = len(rows)
    signs = lambda lang: " ".join(w + random_.choice(("***", "$$$", "%%%", "&&&")) for w in text(lang).split())
    rows += [(1000 + i, signs("en" if i % 2 else "xy"), "en" if i % 2 else "xy") for i in range(160)]
    rows += [(2000 + i, signs("en") if i == 0 else rows[-1][1], "en") for i in range(60)]
    rows += [(3000 + i, text("xy"), "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.judged(docs).where("kept").collect()}
    assert len([i for i in kept if i < good]) >= 0.99 * good
    assert len([i for i in kept if i >= 1000]) <= 0.02 * (len(rows) - good)


def test_quality_rows_one_by_one(spark):
    """Rows that share an id, or have none, are kept or go each by itself."""
    random_ = random.Random(5)
    text = lambda: " ".join("".join(random_.choices(["th", "er", "on", "an"], k=random_.randint(1, 4))) for _ in range(120))
    rows = [(i, text(), "en", 1) for i in range(40)] + [(7, "short", "en", 1), (None, "short", "en", 1), (None, text(), "en", 1), (50, None, None, 1)]
    kept = quality.kept_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, __id int"))
    assert kept.columns == ["doc_id", "text", "lang", "__id"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter([*range(40), None])


def test_quality_of_many_languages(spark):
    """Hundreds of languages: the groups hold what they may, and give what all languages at once give."""
    r = random.Random(6)
    text = lambda k: " ".join("".join(r.choices([a + b for a in "bdfgklmnprst" for b in "aeiou"][k % 20 : k % 20 + 15], k=r.randint(1, 3))) for _ in range(90))
    rows = [(i, text(i % 200), f"l{i % 200}") for i in range(800)] + [(5000 + i, text(1), None) for i in range(5)] + [(6000, None, "none"), (6001, "", "l3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    groups = quality.language_groups(docs, 100_000)
    assert sorted(x for g in groups for x in g) == sorted({x or "" for _, _, x in rows}) and len(groups) > 2
    size = Counter()
    for _, t, x in rows:
        size[x or ""] += len(t or "")
    assert all(sum(size[x] for x in g) <= 100_000 for g in groups)
    assert quality.language_groups(docs.where("false")) == []
    seen = lambda df: Counter((x.doc_id, x.n_words, x.kept, x.log10_ppl and round(x.log10_ppl, 9)) for x in df.collect())
    assert seen(quality.judged(docs, refits=1, most=100_000)) == seen(quality.judged(docs, refits=1))
