from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from propgraph import batch_edges, batch_heatmap, plan_batches


def largest(df, n):
    return batch_heatmap(batch_edges(df, "s", "t", n)).agg(F.max("rel_count")).first()[0]


def skewed(spark, rows=300_000):
    """Source 0 holds a third of all rows, target 0 a tenth."""
    h = F.xxhash64("id")
    return spark.range(rows).select(
        F.when(h % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000))).alias("s"),
        F.when(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) == 0, F.lit(0))
        .otherwise(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(7000)))
        .alias("t"),
    )


@pytest.mark.parametrize("block", [40_000, 20_000, 13_000])
def test_the_largest_block_is_foreseen(spark, block):
    df = skewed(spark)
    plan = plan_batches(df, "s", "t", block)
    assert plan.largest <= block
    assert plan.largest == pytest.approx(largest(df, plan.n), rel=0.2)
    assert plan.n == 1 or largest(df, plan.n // 2) > 0.8 * block
    assert {(h.side, h.node) for h in plan.hubs} >= {("source", 0)}


def test_hubs_that_no_number_of_groups_spreads(spark):
    df = skewed(spark)
    plan = plan_batches(df, "s", "t", 1000)
    # a third and a tenth of the rows meet in one block
    assert plan.least == pytest.approx(10_000, rel=0.1) and plan.largest > 1000
    assert {(h.side, h.node) for h in plan.hubs} == {("source", 0), ("target", 0)}
    assert plan.largest == pytest.approx(largest(df, plan.n), rel=0.2)


def test_even_degrees_and_small_inputs(spark):
    draw = random.Random(1)
    rows = [(draw.randrange(2000), draw.randrange(2000)) for _ in range(40_000)]
    df = spark.createDataFrame([*rows, (None, 1), (1, None)], "s int, t int")
    plan = plan_batches(df, "s", "t", 500)
    assert plan.largest <= 500 and plan.largest == pytest.approx(largest(df, plan.n), rel=0.2)
    assert plan_batches(df, "s", "t", 10**6).n == 1
    assert plan_batches(df.limit(0), "s", "t", 5).n == 1
    assert plan_batches(spark.createDataFrame([("a", "b")], "s string, t string"), "s", "t", 1).n == 1
    with pytest.raises(ValueError):
        plan_batches(df, "s", "t", 0)
