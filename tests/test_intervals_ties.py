"""Islands of rows that are equal in start and end, of which an order leaves the places open."""

from strandloom.operators import intervals
from strandloom.sources.scratch import keeper


def test_copies_of_an_island_s_first_row_stay_in_it(spark):
    rows = [(k, s, e) for k in range(20) for s, e in [(1, 4)] * 7 + [(9, 12)] * 9 + [(10, 20)] * 3 + [(40, 41)] * 5]
    df = spark.createDataFrame(rows, "k int, s long, e long").repartition(6)
    expected = sorted((k, *x) for k in range(20) for x in [(1, 4, 7), (9, 20, 12), (40, 41, 5)])
    for keep in (None, keeper(spark)):
        assert sorted((r.k, r.s, r.e, r.members) for r in intervals.merge(df, ["k"], "s", "e", keep=keep).collect()) == expected
