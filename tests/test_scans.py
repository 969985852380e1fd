import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators import intervals, ranking, scans, stats
from strandloom.sources.scratch import keeper


@pytest.fixture(scope="module")
def spans(spark):
    rng = np.random.default_rng(6)
    rows = [("big", int(s), int(s + w)) for s, w in zip(rng.integers(0, 60_000, 6000), rng.integers(0, 12, 6000))]
    rows += [(None, int(s), int(s + 3)) for s in rng.integers(0, 500, 120)] + [(f"k{i % 40}", int(i), int(i + 1)) for i in range(200)] + [("long", 1, 1_000_000), ("long", 5, 6), ("long", 999_999, 1_000_004)]
    return spark.createDataFrame(rows, "k string, s long, e long").repartition(5).persist()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_key_with_most_rows_lies_in_every_range(spark, spans):
    dealt = scans.dealt(spans, ["k"], ["s", "e"], keeper(spark))
    parts = dealt.filter("k = 'big'").groupBy(scans.RANGE).count().collect()
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in parts) < 3000


def test_islands_equal_those_of_one_task(spark, spans):
    for by in (["k"], []):
        assert rows_of(intervals.with_island(spans, by, "s", "e", 2, keep=keeper(spark))) == rows_of(intervals.with_island(spans, by, "s", "e", 2))
    assert rows_of(intervals.merge(spans, ["k"], "s", "e", keep=keeper(spark))) == rows_of(intervals.merge(spans, ["k"], "s", "e"))
    assert intervals.merge(spans.limit(0), ["k"], "s", "e", keep=keeper(spark)).collect() == []


def test_running_sums_and_numbers(spark, spans):
    rows = spans.withColumn("i", F.monotonically_increasing_id())
    order = ["s", "e", "i"]
    rows = keeper(spark)("rows", rows)
    for by in (["k"], []):
        dealt = scans.dealt(rows, by, order, keeper(spark))
        window = F.expr(f"sum(e) over ({'partition by k' if by else ''} order by s, e, i rows unbounded preceding)")
        number = F.expr(f"cast(row_number() over ({'partition by k' if by else ''} order by s, e, i) as bigint)")
        assert rows_of(scans.running_sum(dealt, by, order, F.col("e"), "x").select("i", "x")) == rows_of(rows.select("i", window.alias("x")))
        assert rows_of(scans.numbered(dealt, by, order, "x").select("i", "x")) == rows_of(rows.select("i", number.alias("x")))


def test_n50_and_blocks(spark, spans):
    lengths = spans.select("k", (F.col("e") - F.col("s") + 1).alias("n"))
    assert rows_of(ranking.n50(lengths, ["k"], "n", keeper(spark))) == rows_of(ranking.n50(lengths, ["k"], "n"))
    assert rows_of(ranking.n50(lengths, [], "n", keeper(spark))) == rows_of(ranking.n50(lengths, [], "n"))
    known = sorted((r.n for r in lengths.filter("k = 'big'").collect()), reverse=True)
    total, run = sum(known), 0
    for n in known:
        run += n
        if 2 * run >= total:
            break
    assert ranking.n50(lengths.filter("k = 'big'"), ["k"], "n", keeper(spark)).first().n50 == n
    numbered = keeper(spark)("rows", spans.withColumn("i", F.monotonically_increasing_id()))
    for by in (["k"], []):
        assert rows_of(stats.thin_blocks(numbered, by, ["s", "i"], 10, 7, keeper(spark))) == rows_of(stats.thin_blocks(numbered, by, ["s", "i"], 10, 7))
