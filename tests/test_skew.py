"""One order, customer and seller each hold a third of all rows; results must still equal SQL."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from oracle.check import compare, connect

HOT = (
    "src_order_items",
    "int_order_financials",
    "fact_order_items",
    "agg_revenue_monthly",
    "agg_category_performance",
    "agg_seller_performance",
    "agg_customer_rfm",
    "agg_cohort_retention",
    "customer_location_history",
    "load_merge_products",
)


@pytest.fixture(scope="module")
def crowded_dir(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("crowded")

    def crowd(column):
        return F.when(F.hash("_row") % 3 == 0, F.lit(0)).otherwise(F.col(column)).cast("long").alias(column)

    def write(name, *columns):
        frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        numbered = frame.withColumn("_row", F.monotonically_increasing_id())
        changed = numbered.select(*[crowd(c) if c in columns else F.col(c) for c in frame.columns])
        changed.coalesce(1).write.parquet(f"{folder}/tmp_{name}")
        part = next((folder / f"tmp_{name}").glob("part-*.parquet"))
        shutil.copy(part, folder / f"{name}.parquet")

    write("lineitem", "l_orderkey", "l_suppkey", "l_partkey")
    write("orders", "o_custkey")
    for name in ("customer", "supplier", "part", "documents", "labels", "events"):
        shutil.copy(f"{sf_dir}/{name}.parquet", folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", HOT)
def test_crowded_keys(spark, crowded_dir, name):
    assert compare(connect(crowded_dir), entry.queries()[name](spark, crowded_dir), entry.oracle_sql()[name]) is None


def test_a_hot_order_spreads_over_many_numbering_groups(spark, crowded_dir):
    lines = spark.read.parquet(f"{crowded_dir}/lineitem.parquet").filter("l_orderkey = 0")
    groups = lines.groupBy("l_linenumber", F.col("l_partkey") % 1024).count()
    assert groups.agg(F.max("count")).first()[0] < lines.count() / 3
