"""Queries of the sequence operators against the SQL that is given for them."""

import pytest

from strandloom.plans import genomic, scores, truth
from tests.test_relational import con, plain  # noqa: F401


ALL, SQL = genomic.QUERIES | scores.QUERIES | truth.QUERIES, genomic.SQL | scores.SQL | truth.SQL


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, con, sf_dir, name):  # noqa: F811
    df = ALL[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)
    assert got
    assert got == want
