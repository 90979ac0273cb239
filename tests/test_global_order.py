"""Positions from sorted ranges must equal plain windows: ties, crowded values and NULLs included."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.operators.global_order import bucket_starts, with_ntile, with_rank_desc


def crowded(spark, n: int):
    """A third of the rows share one value, a fifth have none."""
    value = F.when(F.col("id") % 5 == 1, None).when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") * 31 % 53)
    return spark.range(n).select(F.format_string("k%05d", "id").alias("key"), value.cast("int").alias("value"))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 100, 1003])
def test_ntile(spark, n):
    frame = crowded(spark, n)
    plain = frame.withColumn("bucket", F.ntile(5).over(Window.orderBy(F.col("value").asc_nulls_last(), "key")))
    ranged = with_ntile(frame, {"bucket": "value"}, "key", n)
    assert sorted(map(str, plain.collect())) == sorted(map(str, ranged.collect()))


def test_bucket_starts_match_ntile_sizes():
    for n in range(1, 60):
        starts = [0, *bucket_starts(n, 5), n]
        sizes = [b - a for a, b in zip(starts, starts[1:])]
        expected = [n // 5 + (i < n % 5) for i in range(5)]
        assert sizes == [s for s in expected if s]


@pytest.mark.parametrize("n", [1, 2, 10, 500])
def test_rank(spark, n):
    frame = crowded(spark, n)
    plain = frame.withColumn("place", F.rank().over(Window.orderBy(F.col("value").desc_nulls_last())))
    ranged = with_rank_desc(frame, "value", "place")
    assert sorted(map(str, plain.collect())) == sorted(map(str, ranged.collect()))


def test_rfm_of_customers_without_purchase_time(spark, warehouse):
    """A customer whose purchase times are all unknown is scored as the least recent."""
    from tradewind.plans.analytics import agg_customer_rfm

    orders = warehouse["fact_orders"]
    some = [r["customer_key"] for r in orders.select("customer_key").distinct().orderBy("customer_key").limit(20).collect()]
    gone = F.col("customer_key").isin(some)
    orders = orders.withColumns({d: F.when(~gone, F.col(d)) for d in ("order_purchase_date",)})
    rows = agg_customer_rfm(orders, warehouse["dim_customers"]).filter(gone).collect()
    assert rows and {r["recency_score"] for r in rows} == {1} and all(r["rfm_cell"] for r in rows)


def test_first_rows_of_each_group(spark):
    from tradewind.operators.global_order import first_in_group

    rows = [(g, i * 37 % 1009, f"k{i}") for i in range(1000) for g in ([0.0] if i % 3 else [1.0, None])]
    frame = spark.createDataFrame(rows, "g double, h int, k string").repartition(6)
    wanted = {0.0: 133, 1.0: 7, None: 334}
    found = sorted(map(tuple, first_in_group(frame, "g", ["h", "k"], wanted).collect()), key=str)
    expected = [r for g, n in wanted.items() for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1:])[:n]]
    assert found == sorted(expected, key=str)
