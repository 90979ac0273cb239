"""Order-level summaries of items and payments, ready to join one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.rules import decimal, mean


def int_order_financials(stg_order_items: DataFrame) -> DataFrame:
    """Item totals per order.

    Counting distinct values multiplies the rows Spark aggregates, so it runs on the key columns
    alone, beside the sums. Both halves end up partitioned by order and join without a shuffle;
    a reader that needs no distinct counts does not pay for them.
    """
    totals = stg_order_items.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        decimal(F.sum("item_price")).alias("gross_merchandise_value"),
        decimal(F.sum("freight_value")).alias("freight_total"),
        decimal(F.sum("item_total")).alias("order_total"),
        decimal(mean("item_price", 2)).alias("avg_item_price"),
        decimal(F.max("item_price")).alias("max_item_price"),
        F.min("shipping_limit_date").alias("earliest_shipping_limit"),
    )
    variety = stg_order_items.groupBy("order_id").agg(
        F.countDistinct("product_id").alias("distinct_product_count"),
        F.countDistinct("seller_id").alias("distinct_seller_count"),
    )
    return totals.join(variety, "order_id", "left").select(
        "order_id",
        "item_count",
        "distinct_product_count",
        "distinct_seller_count",
        "gross_merchandise_value",
        "freight_total",
        "order_total",
        "avg_item_price",
        "max_item_price",
        "earliest_shipping_limit",
    )


def int_order_payments_summary(stg_order_payments: DataFrame) -> DataFrame:
    """Totals and the primary payment of each order, in one aggregation.

    The primary payment is the largest, the earliest among equals; a missing value counts as
    largest. It is picked as the maximum of a sort key, so no second pass and no window.
    """
    value, kind = F.col("payment_value"), F.col("payment_type")
    size = F.struct(value.isNull(), value, -F.col("payment_sequential"), kind)
    top = F.max_by(F.struct("payment_type", "payment_installments"), size)
    return (
        stg_order_payments.groupBy("order_id")
        .agg(
            F.count("*").alias("payment_count"),
            decimal(F.sum(value)).alias("paid_total"),
            F.max("payment_installments").alias("max_installments"),
            F.bool_or(kind == "voucher").alias("used_voucher"),
            F.bool_or(kind == "credit_card").alias("used_credit_card"),
            top.alias("_top"),
        )
        .select(
            "order_id",
            "payment_count",
            "paid_total",
            "max_installments",
            "used_voucher",
            "used_credit_card",
            F.col("_top.payment_type").alias("primary_payment_type"),
            F.col("_top.payment_installments").alias("primary_payment_installments"),
            (F.col("payment_count") > 1).alias("is_split_payment"),
        )
    )
