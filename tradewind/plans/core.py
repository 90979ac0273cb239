"""The star schema: five dimensions and two facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.rules import (
    WEIGHT_CLASSES,
    date_key,
    decimal,
    delivery_speed_bucket,
    ladder,
    quotient,
    region_of,
    year_month,
)


def dim_customers(stg_orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """One row per person. The latest location is the maximum of a struct led by purchase time,
    so the whole dimension is one join and one aggregation with map-side combine.
    """
    bought = F.col("order_purchase_timestamp")
    latest = F.max(
        F.struct(
            bought.isNull(), bought, "order_id", "customer_zip_code_prefix", "customer_city", "customer_state"
        )
    )
    rolled = (
        stg_orders.select("order_id", "customer_id", "order_status", "order_purchase_timestamp")
        .join(
            stg_customers.select(
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            ),
            "customer_id",
        )
        .groupBy("customer_unique_id")
        .agg(
            latest.alias("_last"),
            F.min(bought).alias("first_order_at"),
            F.max(bought).alias("latest_order_at"),
            F.count("*").alias("lifetime_order_count"),
            F.count_if(F.col("order_status") == "delivered").alias("delivered_order_count"),
            (F.min("customer_state") != F.max("customer_state")).alias("_states_differ"),
        )
    )
    first_day, last_day = F.col("first_order_at").cast("date"), F.col("latest_order_at").cast("date")
    zip_code = F.col("_last.customer_zip_code_prefix")
    return rolled.select(
        F.col("customer_unique_id").alias("customer_key"),
        "customer_unique_id",
        zip_code.alias("geography_key"),
        zip_code.alias("customer_zip_code_prefix"),
        F.col("_last.customer_city").alias("customer_city"),
        F.col("_last.customer_state").alias("customer_state"),
        "first_order_at",
        "latest_order_at",
        first_day.alias("first_order_date"),
        last_day.alias("latest_order_date"),
        year_month("first_order_at").alias("acquisition_cohort_month"),
        "lifetime_order_count",
        "delivered_order_count",
        (F.col("lifetime_order_count") > 1).alias("is_repeat_customer"),
        F.coalesce("_states_differ", F.lit(False)).alias("has_moved_state"),
        F.datediff(last_day, first_day).alias("customer_tenure_days"),
    )


def dim_date(stg_orders: DataFrame) -> DataFrame:
    """Every day from the first order's year to the end of the year after the last order."""
    day = F.col("date_day")
    weekday, quarter = F.weekday(day) + 1, F.quarter(day)
    return (
        stg_orders.agg(
            F.min("order_purchase_timestamp").alias("low"), F.max("order_purchase_timestamp").alias("high")
        )
        .select(
            F.explode(
                F.sequence(
                    F.trunc(F.col("low").cast("date"), "year"),
                    F.date_sub(F.add_months(F.trunc(F.col("high").cast("date"), "year"), 24), 1),
                )
            ).alias("date_day")
        )
        .select(
            "date_day",
            date_key(day).alias("date_key"),
            F.year(day).alias("year_number"),
            quarter.alias("quarter_number"),
            F.month(day).alias("month_number"),
            F.dayofmonth(day).alias("day_of_month"),
            F.weekofyear(day).alias("iso_week_number"),
            weekday.alias("day_of_week"),
            year_month(day).alias("year_month"),
            F.date_format(day, "MMM").alias("month_name_short"),
            F.rpad(F.date_format(day, "MMMM"), 9, " ").alias("month_name"),
            F.date_format(day, "E").alias("day_name_short"),
            F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
            F.concat(F.year(day).cast("string"), F.lit("-Q"), quarter.cast("string")).alias("year_quarter"),
            F.trunc(day, "week").alias("week_start_date"),
            F.trunc(day, "month").alias("month_start_date"),
            F.last_day(day).alias("month_end_date"),
            F.trunc(day, "quarter").alias("quarter_start_date"),
            F.trunc(day, "year").alias("year_start_date"),
            weekday.isin(6, 7).alias("is_weekend"),
            (day == F.last_day(day)).alias("is_month_end"),
        )
    )


def dim_geography(stg_customers: DataFrame, stg_sellers: DataFrame, stg_geolocation: DataFrame) -> DataFrame:
    """One row per prefix that a customer or seller uses, mapped or not."""
    used = (
        stg_customers.select(
            F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
            F.col("customer_city").alias("city"),
            F.col("customer_state").alias("state"),
        )
        .union(stg_sellers.select("seller_zip_code_prefix", "seller_city", "seller_state"))
        .distinct()
    )
    mapped = stg_geolocation.select(
        "zip_code_prefix",
        F.col("city").alias("_city"),
        F.col("state").alias("_state"),
        "latitude",
        "longitude",
        "coordinate_count",
    )
    per_prefix = (
        used.join(mapped, "zip_code_prefix", "left")
        .groupBy("zip_code_prefix")
        .agg(
            F.mode(F.coalesce("_city", "city"), True).alias("city"),
            F.mode(F.coalesce("_state", "state"), True).alias("state"),
            decimal(F.avg("latitude"), 10, 6).alias("latitude"),
            decimal(F.avg("longitude"), 10, 6).alias("longitude"),
            F.max(F.coalesce("coordinate_count", F.lit(0))).alias("coordinate_count"),
        )
    )
    return per_prefix.select(
        F.col("zip_code_prefix").alias("geography_key"),
        "zip_code_prefix",
        "city",
        "state",
        "latitude",
        "longitude",
        "coordinate_count",
        F.col("latitude").isNotNull().alias("has_coordinates"),
        region_of("state").alias("region"),
    )


def dim_products(stg_products: DataFrame) -> DataFrame:
    volume, weight = F.col("product_volume_cm3"), F.col("product_weight_g")
    by_volume = quotient(volume, F.lit(5000), 6)
    by_weight = quotient(F.coalesce(weight, F.lit(0)), F.lit(1000), 6)
    return stg_products.select(
        F.col("product_id").alias("product_key"),
        "product_id",
        "product_category",
        "product_category_name_pt",
        "product_name_length",
        "product_description_length",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_volume_cm3",
        F.when(volume.isNotNull(), decimal(F.greatest(by_volume, by_weight), 10, 3)).alias(
            "chargeable_weight_kg"
        ),
        ladder(weight, WEIGHT_CLASSES, "oversized", "unknown", strict=True).alias("weight_class"),
        (F.col("product_category") == "unknown").alias("is_uncategorised"),
    )


def dim_sellers(stg_sellers: DataFrame, dim_geography: DataFrame) -> DataFrame:
    places = dim_geography.select(
        "geography_key",
        F.col("region").alias("seller_region"),
        F.col("latitude").alias("seller_latitude"),
        F.col("longitude").alias("seller_longitude"),
    )
    return (
        stg_sellers.withColumn("geography_key", F.col("seller_zip_code_prefix"))
        .join(places, "geography_key", "left")
        .select(
            F.col("seller_id").alias("seller_key"),
            "seller_id",
            "geography_key",
            "seller_zip_code_prefix",
            "seller_city",
            "seller_state",
            "seller_region",
            "seller_latitude",
            "seller_longitude",
        )
    )


def fact_orders(
    stg_orders: DataFrame,
    stg_customers: DataFrame,
    int_order_financials: DataFrame,
    int_order_payments_summary: DataFrame,
    stg_order_reviews: DataFrame,
) -> DataFrame:
    """One row per order. Items, payments and reviews arrive already keyed by order, so after
    the customer join each left join keeps the same partitioning.
    """
    people = stg_customers.select(
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state", "customer_city"
    )
    reviews = stg_order_reviews.select("order_id", "review_score", "review_sentiment_label", "has_comment")
    joined = (
        stg_orders.join(people, "customer_id")
        .join(int_order_financials, "order_id", "left")
        .join(int_order_payments_summary, "order_id", "left")
        .join(reviews, "order_id", "left")
    )
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    promised, approved = F.col("order_estimated_delivery_date"), F.col("order_approved_at")
    delivery_days = F.datediff(arrived.cast("date"), bought.cast("date"))
    approval_seconds = F.timestamp_diff("SECOND", bought, approved)
    total = F.coalesce("order_total", decimal(F.lit(0)))
    none, nothing = F.lit(0).cast("long"), decimal(F.lit(0))
    return joined.select(
        "order_id",
        F.col("customer_unique_id").alias("customer_key"),
        F.col("customer_id").alias("source_customer_id"),
        F.col("customer_zip_code_prefix").alias("geography_key"),
        date_key(bought).alias("order_date_key"),
        date_key(arrived).alias("delivered_date_key"),
        "order_status",
        "customer_state",
        "customer_city",
        "order_purchase_timestamp",
        bought.cast("date").alias("order_purchase_date"),
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        F.coalesce("item_count", none).alias("item_count"),
        F.coalesce("distinct_product_count", none).alias("distinct_product_count"),
        F.coalesce("distinct_seller_count", none).alias("distinct_seller_count"),
        F.coalesce("gross_merchandise_value", nothing).alias("gross_merchandise_value"),
        F.coalesce("freight_total", nothing).alias("freight_total"),
        total.alias("order_total"),
        "avg_item_price",
        "paid_total",
        "primary_payment_type",
        "primary_payment_installments",
        F.coalesce("payment_count", none).alias("payment_count"),
        F.coalesce("is_split_payment", F.lit(False)).alias("is_split_payment"),
        "review_score",
        "review_sentiment_label",
        F.coalesce("has_comment", F.lit(False)).alias("has_review_comment"),
        delivery_days.alias("delivery_days"),
        F.datediff(promised.cast("date"), arrived.cast("date")).alias("days_early_vs_estimate"),
        quotient(approval_seconds, F.lit(3600), 2).alias("approval_hours"),
        (F.col("order_status") == "delivered").alias("is_delivered"),
        (F.col("order_status") == "canceled").alias("is_canceled"),
        (arrived > promised).alias("is_late_delivery"),
        delivery_speed_bucket(delivery_days).alias("delivery_speed_bucket"),
        F.when(total != 0, decimal(F.col("paid_total") - total, 14, 2)).alias("payment_variance"),
    )


def fact_order_items(
    stg_order_items: DataFrame, stg_orders: DataFrame, stg_customers: DataFrame, stg_sellers: DataFrame
) -> DataFrame:
    """One row per item. The basket size is aggregated and joined at order grain, so an order
    with very many items never has to fit into one window partition. Every item has a size; the
    join is a left one so that Spark can drop it where nobody reads the size.
    """
    sizes = stg_order_items.groupBy("order_id").agg(F.count("*").alias("items_in_order"))
    heads = (
        stg_orders.select(
            "order_id",
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
        )
        .join(
            stg_customers.select(
                "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state"
            ),
            "customer_id",
        )
        .join(sizes, "order_id", "left")
    )
    shops = stg_sellers.select("seller_id", "seller_zip_code_prefix", "seller_state")
    bought = F.col("order_purchase_timestamp")
    return (
        stg_order_items.join(heads, "order_id")
        .join(shops, "seller_id")
        .select(
            "order_item_key",
            "order_id",
            "order_item_id",
            F.col("product_id").alias("product_key"),
            F.col("seller_id").alias("seller_key"),
            F.col("customer_unique_id").alias("customer_key"),
            F.col("customer_zip_code_prefix").alias("customer_geography_key"),
            F.col("seller_zip_code_prefix").alias("seller_geography_key"),
            date_key(bought).alias("order_date_key"),
            "order_status",
            "customer_state",
            "seller_state",
            (F.col("customer_state") == F.col("seller_state")).alias("is_intrastate_shipment"),
            "order_purchase_timestamp",
            bought.cast("date").alias("order_purchase_date"),
            "order_delivered_customer_date",
            "shipping_limit_date",
            "item_price",
            "freight_value",
            "item_total",
            "items_in_order",
            quotient(F.col("freight_value"), F.col("item_price"), 4).alias("freight_ratio"),
            (F.col("order_status") == "delivered").alias("is_delivered"),
        )
    )
