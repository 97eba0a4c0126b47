"""Every query against its DuckDB oracle on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from placemark.plans import registry

FOLDER = "/root/testdata/sf0.001"


def shown(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    if name in registry.ORACLES:
        found = duck.sql(registry.ORACLES[name])
        own = list(found.columns)
        assert sorted(own) == columns
        assert rows == sorted(tuple(shown(r[own.index(c)]) for c in columns) for r in found.fetchall())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
def test_lookalikes_of_the_whole_table(spark, duck):
    sql = registry.ORACLES["lookalike_new_new"].replace(" AND a.id % 10 < 3 AND b.id % 10 < 3", "")
    assert "< 3" not in sql
    columns = ["incoming_id", "metres", "other_id", "word"]
    rows = Counter(tuple(shown(r[c]) for c in columns) for r in registry.QUERIES["lookalike_new_all"](spark, FOLDER).collect())
    assert rows == Counter(tuple(map(shown, r)) for r in duck.sql(f"select {', '.join(columns)} from ({sql})").fetchall())
    assert any(int(r[0]) % 10 >= 3 for r in rows)
