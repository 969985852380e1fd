import os

import duckdb
import pytest

import corpus_pipeline
from strandloom.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(r[c] for c in columns) for r in df.collect())
    result = con.execute(queries.ORACLES[name])
    at = [sorted(d[0] for d in result.description).index(c) for c in columns]
    names = [d[0] for d in result.description]
    assert sorted(names) == columns and len(at) == len(columns)
    assert got == sorted(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (docs.first().doc_id, "", "en", None, 0)], docs.schema)
    now = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, sf_dir)
        assert after.columns == list(corpus_pipeline.COLUMNS), name
        rows = after.collect()
        assert len(rows) <= now.count()
        now = spark.createDataFrame(rows, docs.schema)
    assert now.filter("text rlike '[a-z]@mail[0-9]'").count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    assert len(mixed) == now.count() and all(r.taken <= 2 * r.size for r in mixed)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).collect() == []
