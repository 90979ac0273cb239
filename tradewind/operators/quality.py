"""Data-quality checks. Each returns the failing rows, so an empty frame is a pass."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.rules import decimal


# Row checks are predicates, so that many of them can share one scan.
def null_value(column: str) -> Column:
    return F.col(column).isNull()


def unaccepted_value(column: str, values: Sequence[Any]) -> Column:
    """NULL passes."""
    return ~F.col(column).isin(*values)


def negative_value(column: str) -> Column:
    return F.col(column) < 0


def broken_rule(rule: str, where: str | None = None) -> Column:
    """The rule is false; an unknown result passes."""
    broken = ~F.expr(f"({rule})")
    return broken if where is None else broken & F.expr(f"({where})")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_value(column))


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(unaccepted_value(column, values))


def not_negative(df: DataFrame, column: str) -> DataFrame:
    return df.filter(negative_value(column)).select(column)


def expression_is_true(df: DataFrame, rule: str, where: str | None = None) -> DataFrame:
    return df.filter(broken_rule(rule, where))


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose key the parent lacks.

    Only distinct keys are compared, so a key that most rows share is looked up once; ``rows``
    says how many rows carry each orphan key.
    """
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(field).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


def equal_rowcount(df: DataFrame, other: DataFrame) -> DataFrame:
    n = F.count("*")
    return (
        df.agg(n.alias("model_rows"))
        .withColumn("compare_rows", other.agg(n).scalar())
        .filter("model_rows <> compare_rows")
    )


def sums_match(df: DataFrame, column: str, other: DataFrame, other_column: str, tolerance: float = 0.01) -> DataFrame:
    def total(name: str) -> Column:
        return F.coalesce(decimal(F.sum(name), 30, 6), decimal(F.lit(0), 30, 6))

    return (
        df.agg(total(column).alias("model_total"))
        .withColumn("compare_total", other.agg(total(other_column)).scalar())
        .withColumn("difference", F.col("model_total") - F.col("compare_total"))
        .filter(F.abs("difference") > F.lit(tolerance))
    )


def lifecycle_out_of_order(fact_orders: DataFrame) -> DataFrame:
    bought, approved = F.col("order_purchase_timestamp"), F.col("order_approved_at")
    collected, arrived = F.col("order_delivered_carrier_date"), F.col("order_delivered_customer_date")
    return fact_orders.filter((approved < bought) | (collected < bought) | (arrived < collected)).select(
        "order_id",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
    )


def customers_off_order_count(dim_customers: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Customers without orders, or whose rolled-up count is not the fact's."""
    counted = fact_orders.groupBy("customer_key").agg(F.count("order_id").alias("n"))
    actual = F.coalesce("n", F.lit(0).cast("long"))
    return (
        dim_customers.select("customer_key", "lifetime_order_count")
        .join(counted, "customer_key", "left")
        .select("customer_key", "lifetime_order_count", actual.alias("actual_orders"))
        .filter((F.col("actual_orders") == 0) | (F.col("actual_orders") != F.col("lifetime_order_count")))
    )


def orphan_items(fact_order_items: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Orders that only the item fact knows, with their item counts."""
    return (
        fact_order_items.groupBy("order_id")
        .agg(F.count("*").alias("orphan_items"))
        .join(fact_orders.select("order_id"), "order_id", "left_anti")
    )


def unreconciled_orders(fact_orders: DataFrame, fact_order_items: DataFrame) -> DataFrame:
    """Orders whose total and item sum differ by more than a cent."""
    summed = fact_order_items.groupBy("order_id").agg(decimal(F.sum("item_total")).alias("item_total_sum"))
    return (
        fact_orders.select("order_id", "order_total")
        .join(summed, "order_id")
        .withColumn("difference", decimal(F.col("order_total") - F.col("item_total_sum")))
        .filter(F.abs("difference") > F.lit(0.01).cast("decimal(4,2)"))
    )
