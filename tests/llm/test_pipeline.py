"""The pipeline's stages, each on all that the one before kept, and the registry."""

import os

import pytest

import corpus_pipeline
from placemark.llm import registry
from placemark.llm.common import stored, table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == columns
        assert name == "mixing sources" or docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.selectExpr("sum(n_tokens) n").first().n > 0
    assert corpus_pipeline.run(spark, FOLDER).selectExpr("sum(n_tokens) n").first().n == packed.selectExpr("sum(n_tokens) n").first().n


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df, found = registry.QUERIES[name](spark, FOLDER), c.sql(registry.ORACLES[name])
    columns = list(found.columns)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(map(str, r)) for r in df.select(*columns).collect()) == sorted(tuple(map(str, r)) for r in found.fetchall())


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, columns with names the stages use themselves."""
    prose = table(spark, FOLDER, "documents").where("length(text) > 600").limit(12).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "k", 1) for r in prose]
    first = rows[0]
    rows += [first, (None, *first[1:]), (rows[1][0], *rows[2][1:]), (None, None, None, None, None, None, None), (900, None, "en", "src0", 0, "k", 1), (901, "", None, None, None, "", 0)]
    rows += [(902, " ".join(r.text for r in prose) * 20, "en", None, None, "k", 1), (903, "word " * 5000, "en", "src1", 1, "k", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __key string, size int")


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_documents(spark, empty):
    docs = odd_documents(spark)
    docs = docs.where("false") if empty else docs
    texts = {r.text for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, FOLDER), "stage")
        assert out.columns == docs.columns and {r.text for r in out.collect()} <= texts
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert (packed.count() > 0) == (docs.where("text <> ''").count() > 0) and (not empty or packed.count() == 0)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, FOLDER)
    rows = df.count()
    if "doc_id" in df.columns and name != "op6_decontamination":  # which returns what it finds
        assert rows == table(spark, FOLDER, "documents").count()
    assert rows > 0
