"""Staging: one cleaned frame per source table. Lineage columns pass through when present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.rules import clean, decimal, zip_prefix

# The bounding box a coordinate must fall into.
LATITUDE_RANGE = (-33.75, 5.27)
LONGITUDE_RANGE = (-73.99, -34.79)


def _lineage(df: DataFrame) -> list[str]:
    return [name for name in df.columns if name == "_loaded_at"]


def _surrogate(*parts: str) -> Column:
    """Hash of a composite natural key; NULL when a part is."""
    joined = [F.col(parts[0])]
    for part in parts[1:]:
        joined += [F.lit("-"), F.col(part).cast("string")]
    return F.md5(F.concat(*joined))


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        zip_prefix("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        clean("customer_city").alias("customer_city"),
        clean("customer_state", F.upper).alias("customer_state"),
        *_lineage(customers),
    )


def stg_geolocation(geolocation: DataFrame) -> DataFrame:
    """One centroid and one majority label per prefix, from points inside the box.

    Coordinates are averaged as decimals: the centroid is then the same however the points were
    split over tasks. Partial aggregation keeps a very common prefix cheap.
    """
    inside = geolocation.filter(
        F.col("geolocation_lat").between(*LATITUDE_RANGE) & F.col("geolocation_lng").between(*LONGITUDE_RANGE)
    )
    return inside.groupBy(zip_prefix("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        decimal(F.avg(decimal("geolocation_lat", 18, 12)), 20, 6).alias("latitude"),
        decimal(F.avg(decimal("geolocation_lng", 18, 12)), 20, 6).alias("longitude"),
        F.count("*").alias("coordinate_count"),
        F.mode(clean("geolocation_city"), True).alias("city"),
        F.mode(clean("geolocation_state", F.upper), True).alias("state"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    price, freight = decimal("price"), decimal("freight_value")
    return order_items.select(
        _surrogate("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        price.alias("item_price"),
        freight.alias("freight_value"),
        decimal(price + freight).alias("item_total"),
        *_lineage(order_items),
    )


def stg_order_payments(order_payments: DataFrame) -> DataFrame:
    kind = clean("payment_type")
    return order_payments.select(
        _surrogate("order_id", "payment_sequential").alias("order_payment_key"),
        "order_id",
        "payment_sequential",
        kind.alias("payment_type"),
        F.nullif(kind, F.lit("not_defined")).alias("payment_method"),
        F.greatest(F.coalesce("payment_installments", F.lit(1)), F.lit(1)).alias("payment_installments"),
        decimal("payment_value").alias("payment_value"),
        *_lineage(order_payments),
    )


def stg_order_reviews(order_reviews: DataFrame) -> DataFrame:
    """The last answered review of each order. The text takes no part in the order, so readers
    that do not use it never read or shuffle it. Whether there is one, and how long, is found before the shuffle.

    Spark prunes each map task to its best row per order before the shuffle, so an order with
    very many reviews does not fill one task.
    """
    message = F.nullif(F.trim("review_comment_message"), F.lit(""))
    latest_first = Window.partitionBy("order_id").orderBy(
        F.col("review_answer_timestamp").desc_nulls_last(),
        F.col("review_creation_date").desc_nulls_last(),
        F.col("review_id").asc_nulls_last(),
        F.col("review_score").asc_nulls_last(),
    )
    score = F.col("review_score")
    return (
        order_reviews.filter(F.col("order_id").isNotNull() & score.between(1, 5))
        .withColumns({"has_comment": message.isNotNull(), "comment_length": F.coalesce(F.length(message), F.lit(0))})
        .withColumn("_position", F.row_number().over(latest_first))
        .filter("_position = 1")
        .select(
            "review_id",
            "order_id",
            score.cast("int").alias("review_score"),
            F.nullif(F.trim("review_comment_title"), F.lit("")).alias("review_comment_title"),
            message.alias("review_comment_message"),
            "review_creation_date",
            "review_answer_timestamp",
            "has_comment",
            "comment_length",
            F.when(score >= 4, F.lit("positive"))
            .when(score == 3, F.lit("neutral"))
            .otherwise(F.lit("negative"))
            .alias("review_sentiment_label"),
            *_lineage(order_reviews),
        )
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "customer_id",
        clean("order_status").alias("order_status"),
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        *_lineage(orders),
    )


def stg_product_category_translation(product_category_translation: DataFrame) -> DataFrame:
    return product_category_translation.filter(F.col("product_category_name").isNotNull()).select(
        clean("product_category_name").alias("product_category_name"),
        clean("product_category_name_english").alias("product_category_name_english"),
        *_lineage(product_category_translation),
    )


def stg_products(products: DataFrame, stg_product_category_translation: DataFrame) -> DataFrame:
    """Products with their English category. The lookup joins on the cleaned name; Spark
    broadcasts it by its measured size.
    """
    names = stg_product_category_translation.select(
        F.col("product_category_name").alias("_name"), "product_category_name_english"
    )
    category = clean("product_category_name")
    return products.join(names, category == F.col("_name"), "left").select(
        "product_id",
        category.alias("product_category_name_pt"),
        F.coalesce("product_category_name_english", category, F.lit("unknown")).alias("product_category"),
        F.col("product_name_lenght").alias("product_name_length"),
        F.col("product_description_lenght").alias("product_description_length"),
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        (
            F.col("product_length_cm").cast("long") * F.col("product_height_cm") * F.col("product_width_cm")
        ).alias("product_volume_cm3"),
        *_lineage(products),
    )


def stg_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        "seller_id",
        zip_prefix("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        clean("seller_city").alias("seller_city"),
        clean("seller_state", F.upper).alias("seller_state"),
        *_lineage(sellers),
    )
