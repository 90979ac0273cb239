"""The nine source tables, derived from the TPC-H-like test tables.

Every value is integer arithmetic on a key or a plain column, so any engine can derive the same
rows. Only ``geolocation`` and ``order_payments`` produce more than one row per input row (at
most three). Numbering items within an order is split into fine groups, so one huge order does
not land in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradewind.functions.rules import decimal

# State code of each nation key; the last one has no region.
NATION_STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT",
    "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "XX",
)

# Payment type of each order priority.
PRIORITY_PAYMENT = {
    "1-URGENT": "credit_card",
    "2-HIGH": "boleto",
    "3-MEDIUM": "debit_card",
    "4-NOT SPECIFIED": " Credit_Card ",
    "5-LOW": "voucher",
}

DAY = 86_400


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(prefix: str, column: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(column) if isinstance(column, str) else column).cast("string"))


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds.cast("int"), ts)


def _state(nation: Column) -> Column:
    return F.get(F.array(*map(F.lit, NATION_STATES)), nation.cast("int"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the customer record taken at order time. One order in forty moved."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    people = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    moved = F.when(F.col("o_orderkey") % 40 == 0, 1).otherwise(0)
    nation = (F.col("c_nationkey") + moved) % 25
    zip_number = nation * 4000 + F.col("o_custkey") % 400
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        _key("c", "o_orderkey").alias("customer_id"),
        _key("u", "o_custkey").alias("customer_unique_id"),
        zip_number.cast("string").alias("customer_zip_code_prefix"),
        F.when(F.col("o_custkey") % 211 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" Cidade "), (zip_number % 97).cast("string"), F.lit(" ")))
        .alias("customer_city"),
        F.concat(F.lower(_state(nation)), F.lit(" ")).alias("customer_state"),
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three points per person; some have no prefix, so it stays unmapped, and some points lie abroad."""
    people = _table(spark, sf_dir, "customer")
    zip_number = F.col("c_nationkey") * 4000 + F.col("c_custkey") % 400
    points = people.select(
        "c_custkey",
        "c_nationkey",
        zip_number.alias("zip"),
        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("j"),
    )
    z, j, k = F.col("zip"), F.col("j"), F.col("c_custkey")
    abroad = (j == 2) & (k % 50 == 0)
    latitude = (z % 1000 * 3000 + j * 100 + k % 7 - 3_000_000).cast("double") / F.lit(100_000.0)
    longitude = (z % 800 * 4000 + j * 70 - 7_000_000).cast("double") / F.lit(100_000.0)
    return points.select(
        F.when(k % 30 != 0, z.cast("string")).alias("geolocation_zip_code_prefix"),
        F.when(abroad, F.lit(45.0)).otherwise(latitude).alias("geolocation_lat"),
        longitude.alias("geolocation_lng"),
        F.concat(F.when(j < 2, F.lit("Cidade ")).otherwise(F.lit("Vila ")), (z % 97).cast("string")).alias(
            "geolocation_city"
        ),
        F.concat(F.lit(" "), F.lower(_state(F.col("c_nationkey")))).alias("geolocation_state"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line. Line numbers repeat within an order, so the item number adds the part
    and a running number among otherwise equal lines. The window groups are that fine on purpose.
    """
    lines = _table(spark, sf_dir, "lineitem")
    price = decimal("l_extendedprice")
    slot = F.col("l_partkey") % 1024
    same = Window.partitionBy("l_orderkey", "l_linenumber", slot).orderBy(
        "l_partkey", "l_suppkey", "l_extendedprice", "l_tax", "l_shipdate", "l_quantity", "l_discount",
        "l_returnflag", "l_linestatus",
    )
    repeat = F.row_number().over(same) - 1
    return lines.select(
        _key("o", "l_orderkey").alias("order_id"),
        (F.col("l_linenumber") + 7 * (slot + 1024 * repeat)).cast("int").alias("order_item_id"),
        _key("p", "l_partkey").alias("product_id"),
        _key("s", "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        decimal(price * decimal("l_tax", 4, 2)).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order, two for every thirty-third, none for a few."""
    k, seq = F.col("o_orderkey"), F.col("payment_sequential")
    total = decimal("o_totalprice")
    second = (
        F.when(k % 66 == 0, decimal(total * decimal(F.lit(0.5), 3, 2)))
        .when(k % 33 == 0, decimal(total * decimal(F.lit(0.3), 3, 2)))
        .otherwise(decimal(F.lit(0)))
    )
    empty = (k % 501 == 0) & (seq == 1)
    kinds = F.coalesce(
        *[F.when(F.col("o_orderpriority") == p, F.lit(kind)) for p, kind in PRIORITY_PAYMENT.items()],
        F.lit("voucher"),
    )
    sequence = F.when(k % 33 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        _table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", "o_orderpriority", F.explode(sequence).alias("payment_sequential"))
        .select(
            F.when(k % 701 != 0, _key("o", "o_orderkey")).otherwise(_key("lost", "o_orderkey")).alias("order_id"),
            "payment_sequential",
            F.when(empty, F.lit("not_defined"))
            .when(seq == 2, F.lit("voucher"))
            .otherwise(kinds)
            .alias("payment_type"),
            F.when(k % 97 != 0, k % 11).cast("int").alias("payment_installments"),
            F.when(empty, decimal(F.lit(0)))
            .when(seq == 2, second)
            .otherwise(decimal(total - second))
            .alias("payment_value"),
        )
    )


def _order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("delivered"))
        .when((F.col("o_orderstatus") == "O") & (k % 2 == 0), F.lit("shipped"))
        .when(F.col("o_orderstatus") == "O", F.lit("processing"))
        .when(k % 8 < 4, F.lit("delivered"))
        .when(k % 8 == 4, F.lit("canceled"))
        .when(k % 8 == 5, F.lit("unavailable"))
        .when(k % 8 == 6, F.lit("invoiced"))
        .when(k % 16 == 7, F.lit("created"))
        .otherwise(F.lit("approved"))
    )
    bought = F.col("bought")
    shipped = F.col("status").isin("shipped", "delivered")
    delivered = F.col("status") == "delivered"
    days_taken = k * 13 % 22 + 3 + F.when(k % 19 == 0, 16).otherwise(0)
    return (
        _table(spark, sf_dir, "orders")
        .select(
            k,
            F.col("o_orderdate").alias("day"),
            _plus_seconds(F.col("o_orderdate"), k * 7919 % DAY).alias("bought"),
            status.alias("status"),
        )
        .select(
            k,
            "status",
            "bought",
            F.when(
                (k % 89 != 0) & (F.col("status") != "created"),
                _plus_seconds(bought, k * 31 % (2 * DAY)),
            ).alias("approved"),
            F.when(shipped, _plus_seconds(bought, (k % 3 + 1) * DAY)).alias("collected"),
            F.when(delivered, _plus_seconds(bought, days_taken * DAY + k * 17 % (DAY // 2))).alias("arrived"),
            _plus_seconds(F.col("day"), (k % 15 + 14) * DAY).alias("promised"),
        )
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_events(spark, sf_dir).select(
        _key("o", "o_orderkey").alias("order_id"),
        _key("c", "o_orderkey").alias("customer_id"),
        F.col("status").alias("order_status"),
        F.col("bought").alias("order_purchase_timestamp"),
        F.col("approved").alias("order_approved_at"),
        F.col("collected").alias("order_delivered_carrier_date"),
        F.col("arrived").alias("order_delivered_customer_date"),
        F.col("promised").alias("order_estimated_delivery_date"),
    )


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Tells one state of a folder of test tables from another by names, sizes and times of its files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{sf_dir}/*.parquet")
    file = F.concat_ws(" ", "path", "length", F.unix_micros("modificationTime"))
    return files.agg(F.md5(F.array_join(F.sort_array(F.collect_list(file)), " "))).first()[0]


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review for each order, some twice; one in nine names an unknown order. Every fifteenth order quotes one document:
    the stars follow the document's quality label, or else, four times in five, its language.
    """
    k = F.col("o_orderkey")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"), "quality")
    base = (
        _order_events(spark, sf_dir)
        .withColumn("doc_key", F.when(k % 15 == 0, F.floor(k / 15).cast("long")))
        .join(documents, F.col("doc_key") == F.col("doc_id"), "left")
        .join(labels, F.col("doc_key") == F.col("label_id"), "left")
        .withColumn("copy", F.explode(F.expr("IF(o_orderkey % 125 = 0, array(1, 2), array(1))")))
    )
    copy = F.col("copy")
    stars = (
        F.when(copy == 2, (k + 1) % 5 + 1)
        .when(F.col("quality") == 0, k % 2 + 1)
        .when(F.col("quality") == 1, k % 2 + 4)
        .when(F.col("lang").isNotNull(), k % 2 + F.when((F.col("lang") == "en") == (k % 5 < 4), 4).otherwise(1))
        .when(F.col("arrived") > F.col("promised"), k % 4 + 1)
        .when(F.col("arrived").isNotNull(), k % 3 + 3)
        .otherwise(k % 5 + 1)
    )
    shared = F.when(k % 100 < 2, k - k % 2).otherwise(k)
    asked = F.date_trunc("day", F.coalesce(F.col("arrived"), F.col("promised"))).cast("timestamp_ntz")
    wait = k * 29 % (3 * DAY) + F.when((copy == 2) & (k % 250 != 0), 3600).otherwise(0)
    return base.select(
        F.concat(_key("r", shared), F.when(copy == 2, F.lit("-b")).otherwise(F.lit(""))).alias("review_id"),
        F.when(k % 9 != 4, _key("o", "o_orderkey")).otherwise(_key("lost", "o_orderkey")).alias("order_id"),
        stars.cast("int").alias("review_score"),
        F.when(k % 20 == 0, F.concat(F.lit(" Avaliacao "), (k % 7).cast("string"))).alias("review_comment_title"),
        F.when(copy == 1, F.when(k % 15 == 1, F.lit("   ")).otherwise(F.col("text"))).alias(
            "review_comment_message"
        ),
        asked.alias("review_creation_date"),
        F.when((copy == 2) | (k % 77 != 0), _plus_seconds(asked, wait)).alias("review_answer_timestamp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    category = F.concat(F.lit(" "), F.col("p_type"), F.lit("_"), F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")))
    return _table(spark, sf_dir, "part").select(
        _key("p", "p_partkey").alias("product_id"),
        F.when(k % 50 != 0, category).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (k % 900 + 50).cast("int").alias("product_description_lenght"),
        (k % 6 + 1).cast("int").alias("product_photos_qty"),
        F.when(k % 97 != 0, size * (k % 7 + 1) * 100).cast("int").alias("product_weight_g"),
        (size + 5).cast("int").alias("product_length_cm"),
        F.when(k % 61 != 0, k % 40 + 2).cast("int").alias("product_height_cm"),
        (size % 20 + 10).cast("int").alias("product_width_cm"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, nation = F.col("s_suppkey"), F.col("s_nationkey")
    zip_number = nation * 4000 + k % 400
    return _table(spark, sf_dir, "supplier").select(
        _key("s", "s_suppkey").alias("seller_id"),
        zip_number.cast("string").alias("seller_zip_code_prefix"),
        F.concat(F.lit("POLO "), (zip_number % 89).cast("string")).alias("seller_city"),
        F.lower(_state(nation)).alias("seller_state"),
    )


def product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per category in use; those of one brand have no translation."""
    kind, brand = F.lower(F.col("p_type")), F.replace(F.col("p_brand"), F.lit("#"), F.lit("_"))
    return (
        _table(spark, sf_dir, "part")
        .select("p_type", "p_brand")
        .distinct()
        .select(
            F.concat(kind, F.lit("_"), brand, F.lit(" ")).alias("product_category_name"),
            F.when(brand != "Brand_13", F.concat(F.lit("English "), kind, F.lit(" "), brand)).alias("product_category_name_english"),
        )
    )


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    reader.__name__: reader
    for reader in (
        customers,
        geolocation,
        order_items,
        order_payments,
        order_reviews,
        orders,
        products,
        sellers,
        product_category_translation,
    )
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return READERS[name](spark, sf_dir)
