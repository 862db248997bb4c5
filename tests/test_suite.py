"""Every query with SQL gives the rows that DuckDB gives."""

import datetime as dt
import decimal
import hashlib
import math

import duckdb
import pytest

from lattica import suite
from lattica.sources.catalog import TABLES

TIES = {"q_vector_topk"}


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (float, decimal.Decimal)):
        return float(f"{float(value):.9g}")
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(suite.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = suite.QUERIES[name](spark, sf_dir)
    found = duck.execute(suite.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    ours = sorted((tuple(plain(r[n]) for n in sorted(names)) for r in df.collect()), key=repr)
    theirs = sorted((tuple(plain(r[names.index(n)]) for n in sorted(names)) for r in found.fetchall()), key=repr)
    assert ours == theirs


def test_registry_covers_itself():
    assert set(suite.ORACLES) == set(suite.QUERIES)


def test_two_key_relationship_covers_every_line(spark, sf_dir, duck):
    found = suite.QUERIES["q_rel_two_keys"](spark, sf_dir)
    assert {(r["l_orderkey"], r["l_linenumber"]) for r in found.collect()} == set(duck.execute("SELECT l_orderkey, l_linenumber FROM lineitem").fetchall())


def test_null_join_keys_pair_every_order(spark, sf_dir, duck):
    rows = {r["k"]: r["n"] for r in suite.QUERIES["q_null_join_keys"](spark, sf_dir).collect()}
    counts = dict(duck.execute("SELECT CASE WHEN o_totalprice > 150000 THEN o_orderpriority ELSE '-' END, count(*) FROM orders GROUP BY 1").fetchall())
    assert rows == {k: n * n for k, n in counts.items()}


def test_every_query_vector_is_searched(spark, sf_dir, duck):
    found = suite.QUERIES["q_vector_topk_all"](spark, sf_dir).collect()
    (asked,) = duck.execute("SELECT list(vec_id) FROM embeddings WHERE vec_id % 50 = 0").fetchone()
    assert sorted(r["query_id"] for r in found) == sorted(asked * 10)


def test_blocks_of_queries_give_the_same(spark, sf_dir):
    rows = suite.catalog_of(spark, sf_dir).open("embeddings")
    asked = rows.filter("vec_id % 50 = 0")
    whole, parts = (set(map(tuple, suite.nearest(rows, asked, "vec_id", "embedding", 10, block).collect())) for block in (1000, 1))
    assert whole == parts


def test_lower_case_of_whole_texts(spark, sf_dir, duck):
    found = {r["doc_id"]: r["c"] for r in suite.QUERIES["q_strings_3"](spark, sf_dir).collect()}
    assert found == {i: hashlib.md5(t.lower().encode()).hexdigest() for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}
