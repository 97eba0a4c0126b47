"""The queries of this subpackage over the provided tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placemark.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.mixing import mixed

    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["mix_targets"] = r"""WITH s AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
g AS (SELECT source, sum(size) AS n FROM s GROUP BY source),
w AS (SELECT source, n, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM g),
f AS (SELECT source, n, weight, 3 * n / weight AS fills_at FROM w),
l AS (SELECT a.fills_at, (sum(b.n) - sum(CASE WHEN b.fills_at < a.fills_at THEN 3 * b.n ELSE 0 END)) / sum(CASE WHEN b.fills_at < a.fills_at THEN 0 ELSE b.weight END) AS level FROM (SELECT DISTINCT fills_at FROM f) a, f b GROUP BY a.fills_at),
t AS (SELECT max(level) AS level FROM l WHERE level <= fills_at)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(n AS BIGINT) AS source_size, round(least(3 * n, level * weight), 4) AS target FROM s JOIN f ON s.source IS NOT DISTINCT FROM f.source, t"""


@query
def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of the mix alone, without its schedule."""
    from pyspark.sql import functions as F

    from placemark.llm.mixing import targets, word_count

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    goal = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size"))).alias("g")
    met = docs.join(goal, F.col("g.source").eqNullSafe(docs["source"]))
    return met.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.quality import judged

    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log10_ppl"
    )


@query
def op3_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"))


@query
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"))


ORACLES["op10_ngram_join"] = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM w),
c AS (SELECT min(doc_id) AS c, any_value(s) AS s, len(any_value(s)) AS n FROM s WHERE len(s) > 0 GROUP BY md5(array_to_string(s, chr(10)))),
g AS (SELECT c, n, unnest(s) AS g FROM c),
e AS (SELECT a.c AS x, b.c AS y FROM g a JOIN g b ON a.g = b.g AND a.c < b.c AND a.n * 90 <= b.n * 100 AND b.n * 90 <= a.n * 100 GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
f AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT c AS node, c AS m FROM c UNION SELECT f.y, r.m FROM r JOIN f ON f.x = r.node),
m AS (SELECT node, min(m) AS component_id FROM r GROUP BY node),
k AS (SELECT md5(array_to_string(s, chr(10))) AS h, c FROM c)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM s LEFT JOIN k ON len(s) > 0 AND k.h = md5(array_to_string(s, chr(10))) LEFT JOIN m ON m.node = k.c"""


@query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.ngram_join import linked_components

    return linked_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.class_lm import scored

    return scored(table(spark, sf_dir, "documents"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.line_dedup import remove_repeated_chunks

    return remove_repeated_chunks(table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM u GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(df) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER w + 2 * count(*) OVER w) AS BIGINT) AS p, CAST(1 + (1000000000::HUGEINT * (total + 2)) // (sum(total) OVER w + 2 * count(*) OVER w) AS BIGINT) AS q FROM m WINDOW w AS (PARTITION BY lang, source)),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
y AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
z AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
a AS (SELECT * FROM y UNION ALL SELECT * FROM z),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM a)
SELECT * FROM o WHERE part = 'pair' OR rank <= 10"""


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.divergence import audit

    return audit(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
u AS (SELECT lang, unnest(w) AS phrase FROM w),
b AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM w WHERE len(w) > 1),
t AS (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS phrase FROM w WHERE len(w) > 2),
n AS (SELECT lang, count(*) AS n FROM u GROUP BY ALL),
f AS (SELECT lang, phrase, count(*) AS f FROM (SELECT * FROM u UNION ALL SELECT * FROM b UNION ALL SELECT * FROM t) GROUP BY ALL HAVING count(*) >= 10),
s AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE contains(phrase, ' ')),
k AS (SELECT s.lang, s.phrase, s.a, c AS k, array_to_string(p[:c], ' ') AS x, array_to_string(p[c + 1:], ' ') AS y FROM s, LATERAL (SELECT unnest(range(1, len(p))) AS c)),
e AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, 1000000::HUGEINT * k.a * k.a // (x.f::HUGEINT * y.f) AS score FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.x JOIN f y ON y.lang = k.lang AND y.phrase = k.y),
m AS (SELECT lang, phrase, a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, min(score) AS score FROM e GROUP BY ALL),
i AS (SELECT lang, array_to_string(p[o:o + 1], ' ') AS phrase, max(a) AS longer FROM s, (SELECT unnest([1, 2]) AS o) WHERE len(p) = 3 GROUP BY ALL),
q AS (SELECT m.* FROM m LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM q)
SELECT o.lang, rank, phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score FROM o JOIN n USING (lang) WHERE rank <= 2000"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.collocations import phrases

    return phrases(table(spark, sf_dir, "documents"))


ORACLES["op13_vector_dedup"] = r"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
g AS (SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS n FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
p AS (SELECT a.vec_id AS x, b.vec_id AS y FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS m FROM v UNION SELECT p.y, r.m FROM r JOIN p ON p.x = r.node),
c AS (SELECT node, min(m) AS component_id FROM r GROUP BY node),
l AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT vec_id, coalesce(l.n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.node = v.vec_id LEFT JOIN l ON l.x = v.vec_id"""


@query
def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placemark.llm.vector_dedup import linked_vectors

    return linked_vectors(table(spark, sf_dir, "embeddings"))
