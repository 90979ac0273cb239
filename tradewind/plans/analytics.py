"""The nine business aggregates over the star schema.

Each reads a fact once where it can: rates become conditional counts in the same aggregation, and
totals are taken from the small grouped result. Windows without partition keys run only on
results bounded by the calendar, the category list or the list of states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewind.functions.rules import (
    ALL_DELIVERED,
    c,
    decimal,
    lateness_label,
    lateness_position,
    mean,
    month_start,
    percent,
    quotient,
    revenue_recognised,
    share_true,
    year_month,
)
from tradewind.operators.global_order import with_ntile, with_rank_desc
from tradewind.session import materialise


def _total(column: str, precision: int = 14):
    return decimal(F.sum(column), precision, 2)


def agg_kpi_summary(fact_orders: DataFrame, dim_customers: DataFrame, fact_order_items: DataFrame) -> DataFrame:
    """One row of headline figures: one pass over each input, put together as scalar subqueries."""
    billed = F.coalesce(revenue_recognised(), F.lit(False))
    score = F.when(billed, c("review_score"))
    arrived = billed & c("is_delivered") & c("order_delivered_customer_date").isNotNull()
    days = F.when(arrived, c("delivery_days"))
    late = c("is_late_delivery")

    def when_billed(column: str):
        return F.when(billed, c(column))

    head = fact_orders.agg(
        F.count_if(billed).alias("total_orders"),
        F.countDistinct(when_billed("customer_key")).alias("total_customers"),
        decimal(F.sum(when_billed("order_total")), 16, 2).alias("total_revenue"),
        decimal(F.sum(when_billed("gross_merchandise_value")), 16, 2).alias("total_gmv"),
        decimal(F.sum(when_billed("freight_total")), 16, 2).alias("total_freight"),
        F.sum(when_billed("item_count")).alias("total_items"),
        mean(when_billed("order_total"), 2).alias("avg_order_value"),
        F.min(when_billed("order_purchase_date")).alias("first_order_date"),
        F.max(when_billed("order_purchase_date")).alias("last_order_date"),
        mean(score, 3).alias("avg_review_score"),
        percent(F.count_if(score >= 4), F.count(score)).alias("satisfied_pct"),
        mean(days, 2).alias("avg_delivery_days"),
        percent(F.count_if(arrived & late), F.count_if(arrived)).alias("late_delivery_pct"),
        percent(F.count_if(arrived & ~late), F.count_if(arrived)).alias("on_time_delivery_pct"),
        F.count_if("is_canceled").alias("canceled_orders"),
    )
    people = dim_customers.agg(
        F.struct(
            F.count_if("is_repeat_customer").alias("repeat_customers"),
            share_true(c("is_repeat_customer")).alias("repeat_customer_pct"),
        ).alias("v")
    )
    goods = fact_order_items.agg(
        F.struct(
            F.countDistinct("product_key").alias("total_products"),
            F.countDistinct("seller_key").alias("total_sellers"),
        ).alias("v")
    )
    return head.select("*", people.scalar().alias("_people"), goods.scalar().alias("_goods")).select(
        "total_orders",
        "total_customers",
        "total_revenue",
        "total_gmv",
        "total_freight",
        "total_items",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        "_people.repeat_customers",
        "_people.repeat_customer_pct",
        "avg_review_score",
        "satisfied_pct",
        "avg_delivery_days",
        "late_delivery_pct",
        "on_time_delivery_pct",
        "_goods.total_products",
        "_goods.total_sellers",
        "canceled_orders",
    )


def agg_revenue_monthly(fact_orders: DataFrame) -> DataFrame:
    """Monthly revenue with growth rates. Year over year means twelve rows back."""
    month = month_start("order_purchase_date")
    months = (
        fact_orders.filter(revenue_recognised())
        .groupBy(month.alias("month_start_date"))
        .agg(
            F.count("*").alias("order_count"),
            F.countDistinct("customer_key").alias("active_customers"),
            _total("order_total").alias("revenue"),
            _total("gross_merchandise_value").alias("gmv"),
            _total("freight_total").alias("freight_revenue"),
            F.sum("item_count").alias("items_sold"),
            mean("order_total", 2).alias("avg_order_value"),
            mean("review_score", 3).alias("avg_review_score"),
            mean("delivery_days", 2).alias("avg_delivery_days"),
        )
    )
    by_month = Window.orderBy("month_start_date")
    so_far = by_month.rowsBetween(Window.unboundedPreceding, 0)
    last_three = by_month.rowsBetween(-2, 0)
    revenue = c("revenue")
    last_month, last_year = F.lag(revenue).over(by_month), F.lag(revenue, 12).over(by_month)
    start = c("month_start_date")
    quarter = F.quarter(start)
    return months.select(
        start,
        year_month(start).alias("year_month"),
        F.year(start).alias("year_number"),
        quarter.alias("quarter_number"),
        F.concat(F.year(start).cast("string"), F.lit("-Q"), quarter.cast("string")).alias("year_quarter"),
        "order_count",
        "active_customers",
        "revenue",
        "gmv",
        "freight_revenue",
        "items_sold",
        "avg_order_value",
        "avg_review_score",
        "avg_delivery_days",
        last_month.alias("prev_month_revenue"),
        decimal(F.sum(revenue).over(so_far), 20, 2).alias("cumulative_revenue"),
        quotient(F.sum(revenue).over(last_three), F.count(revenue).over(last_three), 2).alias(
            "revenue_3m_moving_avg"
        ),
        percent(revenue - last_month, last_month).alias("mom_growth_pct"),
        percent(revenue - last_year, last_year).alias("yoy_growth_pct"),
    ).orderBy("month_start_date")


def agg_category_performance(
    fact_order_items: DataFrame, dim_products: DataFrame, fact_orders: DataFrame
) -> DataFrame:
    """Category league table at item grain, sales and satisfaction in one aggregation.

    Order counts are distinct orders touching the category; review and lateness figures weigh
    each order by its items, as the inputs do. Items without an order still count as sales. The
    four distinct counts run on the key columns alone, as they multiply the rows they read.
    """
    outcomes = fact_orders.filter(revenue_recognised()).select(
        "order_id", "review_score", "is_late_delivery", F.lit(True).alias("_known")
    )
    sales = fact_order_items.filter(revenue_recognised()).join(
        dim_products.select("product_key", "product_category"), "product_key"
    )
    reach = sales.groupBy("product_category").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.countDistinct("customer_key").alias("customer_count"),
        F.countDistinct("product_key").alias("distinct_products"),
        F.countDistinct("seller_key").alias("distinct_sellers"),
    )
    figures = sales.join(outcomes, "order_id", "left").groupBy("product_category").agg(
        F.count("*").alias("items_sold"),
        _total("item_total").alias("revenue"),
        _total("item_price").alias("product_revenue"),
        _total("freight_value").alias("freight_revenue"),
        mean("item_price", 2).alias("avg_item_price"),
        mean("freight_ratio", 4).alias("avg_freight_ratio"),
        mean("review_score", 3).alias("avg_review_score"),
        percent(F.count_if("is_late_delivery"), F.count("_known")).alias("late_delivery_pct"),
        F.min("order_purchase_date").alias("first_sale_date"),
        F.max("order_purchase_date").alias("last_sale_date"),
    )
    same_category = figures["product_category"].eqNullSafe(reach["product_category"])
    categories = figures.join(reach, same_category).drop(reach["product_category"])
    everything = Window.partitionBy()
    by_revenue = Window.orderBy(c("revenue").desc())
    down_to_here = Window.orderBy(c("revenue").desc(), "product_category").rowsBetween(
        Window.unboundedPreceding, 0
    )
    all_revenue = F.sum("revenue").over(everything)
    return categories.select(
        "product_category",
        "items_sold",
        "order_count",
        "customer_count",
        "distinct_products",
        "distinct_sellers",
        "revenue",
        "product_revenue",
        "freight_revenue",
        "avg_item_price",
        "avg_freight_ratio",
        "avg_review_score",
        "late_delivery_pct",
        "first_sale_date",
        "last_sale_date",
        percent(c("revenue"), all_revenue).alias("revenue_share_pct"),
        F.rank().over(by_revenue).alias("revenue_rank"),
        percent(F.sum("revenue").over(down_to_here), all_revenue).alias("cumulative_revenue_share_pct"),
    ).orderBy(c("revenue").desc())


def agg_seller_performance(
    fact_order_items: DataFrame,
    dim_sellers: DataFrame,
    fact_orders: DataFrame,
) -> DataFrame:
    """Seller league table.

    Items collapse to one row per seller and order first. That grouping needs no shuffle beyond
    the one on the order, shrinks hot sellers, and makes each order count once in the review and
    lateness figures.
    """
    items = fact_order_items.filter(revenue_recognised())
    outcomes = fact_orders.select(
        "order_id",
        "review_score",
        "is_late_delivery",
        "delivery_days",
        F.lit(True).alias("_known"),
    )
    baskets = items.groupBy("seller_key", "order_id", "customer_key").agg(
        F.count("*").alias("items"),
        F.sum("item_total").alias("total"),
        F.sum("freight_value").alias("freight"),
        F.sum("item_price").alias("price"),
        F.count("item_price").alias("priced"),
        F.min("order_purchase_date").alias("day"),
    )
    trade = (
        baskets.join(outcomes, "order_id", "left")
        .groupBy("seller_key")
        .agg(
            F.sum("items").alias("items_sold"),
            F.count("*").alias("order_count"),
            F.countDistinct("customer_key").alias("customer_count"),
            _total("total").alias("revenue"),
            _total("freight").alias("freight_revenue"),
            quotient(F.sum("price"), F.sum("priced"), 2).alias("avg_item_price"),
            mean("review_score", 3).alias("avg_review_score"),
            percent(F.count_if("is_late_delivery"), F.count("_known")).alias("late_delivery_pct"),
            mean("delivery_days", 2).alias("avg_delivery_days"),
            F.count_if(c("review_score") <= 2).alias("poor_review_count"),
            F.min("day").alias("first_sale_date"),
            F.max("day").alias("last_sale_date"),
        )
    )
    ranges = items.groupBy("seller_key").agg(F.countDistinct("product_key").alias("distinct_products"))
    shops = dim_sellers.select("seller_key", "seller_id", "seller_city", "seller_state", "seller_region")
    league = materialise(trade.join(ranges, "seller_key").join(shops, "seller_key"), "sellers")
    total = league.agg(F.sum("revenue")).first()[0]
    ranked = with_rank_desc(league, "revenue", "revenue_rank")
    return ranked.select(
        "seller_key",
        "seller_id",
        "seller_city",
        "seller_state",
        "seller_region",
        "items_sold",
        "order_count",
        "customer_count",
        "distinct_products",
        "revenue",
        "freight_revenue",
        "avg_item_price",
        "avg_review_score",
        "late_delivery_pct",
        "avg_delivery_days",
        "poor_review_count",
        "first_sale_date",
        "last_sale_date",
        F.datediff("last_sale_date", "first_sale_date").alias("active_days"),
        percent(c("revenue"), F.lit(total), 3).alias("revenue_share_pct"),
        "revenue_rank",
        ((c("order_count") >= 20) & (c("late_delivery_pct") > 15)).alias("is_at_risk_seller"),
    ).orderBy(c("revenue").desc())


def agg_delivery_performance(fact_orders: DataFrame) -> DataFrame:
    score = c("review_score")
    groups = (
        fact_orders.filter(c("is_delivered") & c("order_delivered_customer_date").isNotNull())
        .groupBy(
            month_start("order_purchase_date").alias("month_start_date"),
            "delivery_speed_bucket",
            "is_late_delivery",
        )
        .agg(
            F.count("*").alias("order_count"),
            _total("order_total").alias("revenue"),
            mean("delivery_days", 2).alias("avg_delivery_days"),
            mean("days_early_vs_estimate", 2).alias("avg_days_early_vs_estimate"),
            mean("review_score", 3).alias("avg_review_score"),
            F.count(score).alias("reviewed_orders"),
            F.count_if(score <= 2).alias("poor_reviews"),
            F.count_if(score >= 4).alias("good_reviews"),
        )
    )
    in_month = F.sum("order_count").over(Window.partitionBy("month_start_date"))
    return groups.select(
        "month_start_date",
        year_month("month_start_date").alias("year_month"),
        "delivery_speed_bucket",
        "is_late_delivery",
        "order_count",
        "revenue",
        "avg_delivery_days",
        "avg_days_early_vs_estimate",
        "avg_review_score",
        "reviewed_orders",
        "poor_reviews",
        "good_reviews",
        percent(c("poor_reviews"), c("reviewed_orders")).alias("poor_review_pct"),
        percent(c("good_reviews"), c("reviewed_orders")).alias("good_review_pct"),
        percent(c("order_count"), in_month).alias("share_of_month_pct"),
    ).orderBy("month_start_date", "delivery_speed_bucket")


def agg_delivery_review_correlation(fact_orders: DataFrame) -> DataFrame:
    """Review score by lateness, plus a total row with the Pearson correlation.

    Days and stars are whole numbers, so their sums and products per bucket are exact. The total
    row, correlation included, is a rollup of the seven bucket rows and needs no second pass. It holds the money of
    all orders, which has outgrown 14 digits at some tens of millions of them.
    """
    late_by = F.datediff(
        c("order_delivered_customer_date").cast("date"), c("order_estimated_delivery_date").cast("date")
    )
    x, y = c("days_late").cast("long"), c("review_score").cast("long")
    parts = {
        "orders": F.count("*"),
        "stars": F.sum(y),
        "ones": F.count_if(y == 1),
        "fours": F.count_if(y >= 4),
        "days": F.sum("delivery_days"),
        "timed": F.count("delivery_days"),
        "total": F.sum("order_total"),
        "pairs": F.count(x),
        "sx": F.sum(x),
        "sy": F.sum(F.when(x.isNotNull(), y)),
        "sxx": F.sum(x * x),
        "syy": F.sum(F.when(x.isNotNull(), y * y)),
        "sxy": F.sum(x * y),
    }
    buckets = (
        fact_orders.filter(
            c("is_delivered") & c("order_delivered_customer_date").isNotNull() & c("review_score").isNotNull()
        )
        .withColumn("days_late", late_by)
        .groupBy(F.coalesce(lateness_position(c("days_late")), F.lit(7)).alias("position"))
        .agg(*[value.alias(name) for name, value in parts.items()])
    )
    rows = buckets.rollup("position").agg(*[F.sum(name).alias(name) for name in parts]).filter("orders > 0")

    def spread(n: str, ab: str, a: str, b: str):
        n, ab, a, b = (decimal(name, 19, 0) for name in (n, ab, a, b))
        return (n * ab - a * b).cast("double")

    scale = F.sqrt(spread("pairs", "sxx", "sx", "sx")) * F.sqrt(spread("pairs", "syy", "sy", "sy"))
    correlation = spread("pairs", "sxy", "sx", "sy") / F.nullif(scale, F.lit(0.0))
    is_total = c("position").isNull()
    return (
        rows.withColumn("_orders", F.sum(F.when(~is_total, c("orders"))).over(Window.partitionBy()))
        .select(
            F.when(is_total, F.lit(ALL_DELIVERED)).otherwise(lateness_label(c("position"))).alias("lateness_bucket"),
            c("orders").alias("order_count"),
            quotient(c("stars"), c("orders"), 3).alias("avg_review_score"),
            percent(c("ones"), c("orders")).alias("one_star_pct"),
            percent(c("fours"), c("orders")).alias("four_plus_star_pct"),
            quotient(c("days"), c("timed"), 2).alias("avg_delivery_days"),
            decimal("total", 20, 2).alias("revenue"),
            F.when(is_total, decimal(correlation, 20, 4)).alias("correlation_coefficient"),
            percent(c("orders"), c("_orders")).alias("share_of_delivered_pct"),
            c("position"),
        )
        .orderBy(c("position").asc_nulls_last())
        .drop("position")
    )


def rfm_segment(recency, frequency, monetary):
    """Named segment of a score triple; the first rule that fits wins."""
    recent, rare, rich = recency >= 4, frequency <= 2, monetary >= 4
    rules = (
        (recent & (frequency >= 4), "Champions"),
        ((recency >= 3) & (frequency >= 3) & rich, "Loyal"),
        (recent & rare & rich, "Big Spenders"),
        (recent & rare, "New / Promising"),
        (recency == 3, "Needs Attention"),
        ((recency == 2) & rich, "At Risk"),
        (recency == 2, "Hibernating"),
        (rich, "Lost High Value"),
    )
    return F.coalesce(*[F.when(rule, F.lit(name)) for rule, name in rules], F.lit("Lost"))


def agg_customer_rfm(fact_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Recency, frequency and monetary scores per customer against the last billed day.

    The per-customer figures are written once; quintiles, the reference day and the scores all
    come from that small table.
    """
    figures = materialise(
        fact_orders.filter(revenue_recognised())
        .groupBy("customer_key")
        .agg(
            F.count("*").alias("frequency"),
            _total("order_total").alias("monetary"),
            mean("order_total", 2).alias("avg_order_value"),
            F.sum("item_count").alias("total_items"),
            mean("review_score", 2).alias("avg_review_score"),
            F.min("order_purchase_date").alias("first_order_date"),
            F.max("order_purchase_date").alias("last_order_date"),
        ),
        "rfm",
    )
    facts = figures.agg(F.count("*").alias("n"), F.max("last_order_date").alias("day")).first()
    dated = figures.withColumn("as_of_date", F.lit(facts["day"]).cast("date")).withColumn(
        "recency_days", F.datediff("as_of_date", "last_order_date")
    )
    ranked = with_ntile(
        dated,
        {"_recency_band": "recency_days", "monetary_score": "monetary"},
        "customer_key",
        facts["n"],
    )
    recency, frequency, monetary = c("recency_score"), c("frequency_score"), c("monetary_score")
    scored = ranked.withColumns(
        {
            "recency_score": 6 - c("_recency_band"),
            "frequency_score": F.least(c("frequency"), F.lit(5)).cast("int"),
        }
    )
    people = dim_customers.select(
        "customer_key", "customer_state", "customer_city", "geography_key", "acquisition_cohort_month"
    )
    return scored.join(people, "customer_key").select(
        "customer_key",
        "customer_state",
        "customer_city",
        "geography_key",
        "acquisition_cohort_month",
        "as_of_date",
        "recency_days",
        "frequency",
        "monetary",
        "avg_order_value",
        "total_items",
        "avg_review_score",
        "first_order_date",
        "last_order_date",
        recency,
        frequency,
        monetary,
        (recency + frequency + monetary).alias("rfm_score"),
        F.concat(*[score.cast("string") for score in (recency, frequency, monetary)]).alias("rfm_cell"),
        rfm_segment(recency, frequency, monetary).alias("rfm_segment"),
        F.when(recency >= 4, F.lit("Active"))
        .when(recency >= 2, F.lit("Cooling"))
        .otherwise(F.lit("Lost"))
        .alias("lifecycle_stage"),
    )


def agg_cohort_retention(fact_orders: DataFrame) -> DataFrame:
    """Retention by acquisition month.

    Orders shrink to one row per customer and month before anything is compared, so very active
    customers weigh no more than others, the cohort month is a window over at most as many rows
    as there are months, and active customers are a plain count.
    """
    active = (
        fact_orders.filter(revenue_recognised())
        .groupBy("customer_key", month_start("order_purchase_date").alias("activity_month"))
        .agg(F.count("*").alias("orders"), F.sum("order_total").alias("spent"))
        .withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy("customer_key")))
    )
    cells = active.groupBy("cohort_month", "activity_month").agg(
        F.count("*").alias("active_customers"),
        F.sum("orders").alias("order_count"),
        _total("spent").alias("revenue"),
    )
    joined_up = c("cohort_month") == c("activity_month")
    size = F.max(F.when(joined_up, c("active_customers"))).over(Window.partitionBy("cohort_month"))
    return (
        cells.withColumn("cohort_size", size)
        .select(
            "cohort_month",
            year_month("cohort_month").alias("cohort_label"),
            "activity_month",
            F.months_between("activity_month", "cohort_month").cast("int").alias("months_since_acquisition"),
            "cohort_size",
            "active_customers",
            "order_count",
            "revenue",
            percent(c("active_customers"), c("cohort_size")).alias("retention_pct"),
            quotient(c("revenue"), c("cohort_size"), 2).alias("revenue_per_cohort_customer"),
        )
        .orderBy("cohort_month", "months_since_acquisition")
    )


def agg_geographic_revenue(fact_orders: DataFrame, dim_geography: DataFrame) -> DataFrame:
    places = dim_geography.select("geography_key", "region", "latitude", "longitude")
    states = (
        fact_orders.filter(revenue_recognised())
        .join(places, "geography_key")
        .groupBy(c("customer_state").alias("state"), "region")
        .agg(
            F.count("*").alias("order_count"),
            F.countDistinct("customer_key").alias("customer_count"),
            _total("order_total").alias("revenue"),
            _total("gross_merchandise_value").alias("gmv"),
            _total("freight_total").alias("freight_revenue"),
            mean("order_total", 2).alias("avg_order_value"),
            mean("freight_total", 2).alias("avg_freight"),
            mean("delivery_days", 2).alias("avg_delivery_days"),
            mean("review_score", 3).alias("avg_review_score"),
            share_true(c("is_late_delivery")).alias("late_delivery_pct"),
            mean("latitude", 4).alias("latitude"),
            mean("longitude", 4).alias("longitude"),
        )
    )
    revenue = c("revenue")
    return states.select(
        "*",
        percent(c("freight_revenue"), c("gmv")).alias("freight_to_gmv_pct"),
        percent(revenue, F.sum(revenue).over(Window.partitionBy())).alias("revenue_share_pct"),
        quotient(revenue, c("customer_count"), 2).alias("revenue_per_customer"),
        F.rank().over(Window.orderBy(revenue.desc())).alias("revenue_rank"),
    ).orderBy(revenue.desc())
