"""Relational queries against the SQL that is given for them."""

import inspect
import os
from decimal import Decimal

import duckdb
import pytest

from strandloom.operators import resampling
from strandloom.plans import relational

TABLES = "region nation customer supplier part orders lineitem events documents benchmark labels".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.execute(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return c


def plain(v):
    return round(float(v), 6) if isinstance(v, (float, Decimal)) else v


@pytest.mark.parametrize("name", sorted(relational.QUERIES))
def test_query(spark, con, sf_dir, name):
    df = relational.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in relational.SQL:
        assert got
        return
    result = con.execute(relational.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)


@pytest.mark.parametrize(("name", "module", "operator", "full"), [("bootstrap_interval", resampling, "block_interval", {"resamples": 1000, "block": 500, "cap": 512}), ("cluster_bootstrap", resampling, "cluster_interval", {"resamples": 10_000})])
def test_bootstraps_draw_as_often_as_the_reference(spark, sf_dir, monkeypatch, name, module, operator, full):
    inner, calls = getattr(module, operator), []

    def spy(*given, **named):
        calls.append(inspect.signature(inner).bind(*given, **named))
        calls[-1].apply_defaults()
        return inner(*given, **named)

    monkeypatch.setattr(module, operator, spy)
    assert relational.QUERIES[name](spark, sf_dir).count()
    assert [{k: c.arguments[k] for k in full} for c in calls] == [full]
