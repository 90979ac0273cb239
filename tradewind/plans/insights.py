"""Figures derived from published datasets: each takes small frames and returns a smaller one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.rules import ALL_DELIVERED, c, decimal, mean, percent, quotient


def _first_by(value: str, order: Column) -> Column:
    return F.min_by(value, order)


def peak_month(agg_revenue_monthly: DataFrame) -> DataFrame:
    """The best month (the earliest among equals), and average growth over the last six."""
    newest = Window.orderBy(c("month_start_date").desc())
    best = F.struct(-c("revenue"), c("month_start_date"))
    recent = F.when(c("_age") <= 6, c("mom_growth_pct"))
    return agg_revenue_monthly.withColumn("_age", F.row_number().over(newest)).agg(
        _first_by("year_month", best).alias("peak_month"),
        F.max("revenue").alias("peak_revenue"),
        mean(recent, 2).alias("recent_mom_growth_pct"),
    )


def review_gap(agg_delivery_review_correlation: DataFrame) -> DataFrame:
    """Mean score and one-star rate of the punctual and the late buckets, each bucket counting once."""
    label = c("lateness_bucket")
    bucket = label != ALL_DELIVERED
    punctual, late = bucket & label.rlike("early|promise"), bucket & label.rlike("late")

    def over(which: Column, column: str, scale: int) -> Column:
        return mean(F.when(which, c(column)), scale)

    figures = agg_delivery_review_correlation.agg(
        over(punctual, "avg_review_score", 6).alias("punctual_review_score"),
        over(late, "avg_review_score", 6).alias("late_review_score"),
        over(punctual, "one_star_pct", 6).alias("punctual_one_star_pct"),
        over(late, "one_star_pct", 6).alias("late_one_star_pct"),
        F.max(F.when(~bucket, c("correlation_coefficient"))).alias("correlation_coefficient"),
    )
    return figures.withColumn(
        "review_gap", decimal(c("punctual_review_score") - c("late_review_score"), 20, 6)
    )


def years_in_view(agg_revenue_monthly: DataFrame, years: Iterable[int] | None = None) -> DataFrame:
    """Totals over the chosen years; all years when none are chosen."""
    chosen = list(years or [])
    months = agg_revenue_monthly.filter(c("year_number").isin(chosen)) if chosen else agg_revenue_monthly
    best = F.struct(-c("revenue"), c("month_start_date"))
    return months.agg(
        F.sum("revenue").cast("decimal(20,2)").alias("revenue"),
        F.sum("order_count").alias("orders"),
        quotient(F.sum("revenue"), F.greatest(F.sum("order_count"), F.lit(1)), 2).alias("avg_order_value"),
        _first_by("year_month", best).alias("best_month"),
    )


def quarterly_rollup(agg_revenue_monthly: DataFrame) -> DataFrame:
    quarters = agg_revenue_monthly.groupBy("year_quarter").agg(
        F.sum("revenue").cast("decimal(20,2)").alias("revenue"),
        F.sum("order_count").alias("orders"),
        F.sum("active_customers").alias("customers"),
        mean("avg_order_value", 6).alias("avg_order_value"),
        mean("avg_review_score", 6).alias("avg_review"),
    )
    before = F.lag("revenue").over(Window.orderBy("year_quarter"))
    return quarters.withColumn("qoq_growth_pct", percent(c("revenue") - before, before, 1)).orderBy("year_quarter")


def category_concentration(agg_category_performance: DataFrame, top: int = 10) -> DataFrame:
    """Revenue share of the leading categories, number of categories and largest share."""
    place = F.row_number().over(Window.orderBy(c("revenue").desc(), "product_category"))
    return agg_category_performance.withColumn("_place", place).agg(
        F.sum(F.when(c("_place") <= top, c("revenue_share_pct"))).cast("decimal(20,2)").alias("top_share_pct"),
        F.count("*").alias("categories"),
        F.max("revenue_share_pct").alias("largest_share_pct"),
    )


def leading_categories(agg_category_performance: DataFrame, top: int = 12) -> DataFrame:
    return (
        agg_category_performance.select("product_category", "revenue", "revenue_share_pct", "avg_review_score")
        .orderBy(c("revenue").desc(), "product_category")
        .limit(top)
    )


def leading_sellers(agg_seller_performance: DataFrame, top: int = 20) -> DataFrame:
    """The leading sellers with abbreviated ids."""
    return (
        agg_seller_performance.orderBy(c("revenue").desc(), "seller_id")
        .limit(top)
        .select(
            F.concat(F.substring("seller_id", 1, 10), F.lit("…")).alias("seller"),
            "seller_state",
            "revenue",
            "order_count",
            "avg_review_score",
            "late_delivery_pct",
            "is_at_risk_seller",
        )
    )


def at_risk_sellers(agg_seller_performance: DataFrame) -> DataFrame:
    return agg_seller_performance.agg(F.count_if("is_at_risk_seller").alias("at_risk_sellers"))


def customer_totals(rfm_segments: DataFrame) -> DataFrame:
    active = F.sum(F.when(c("lifecycle_stage") == "Active", c("customer_count")).otherwise(0))
    everyone = F.sum("customer_count")
    worth = F.struct(-c("total_monetary"), c("rfm_segment"), c("lifecycle_stage"))
    return rfm_segments.agg(
        everyone.alias("customers"),
        F.sum("total_monetary").cast("decimal(20,2)").alias("lifetime_value"),
        percent(active, F.greatest(everyone, F.lit(1))).alias("active_pct"),
        _first_by("rfm_segment", worth).alias("most_valuable_segment"),
    )


RETENTION_MONTHS = 12


def retention_triangle(agg_cohort_retention: DataFrame) -> DataFrame:
    """One line per cohort, one column per month since acquisition, up to twelve."""
    months = list(range(RETENTION_MONTHS + 1))
    triangle = (
        agg_cohort_retention.filter(c("months_since_acquisition") <= RETENTION_MONTHS)
        .groupBy("cohort_label")
        .pivot("months_since_acquisition", months)
        .agg(mean("retention_pct", 2))
    )
    return triangle.select("cohort_label", *[c(f"`{m}`").alias(f"month_{m}") for m in months]).orderBy("cohort_label")


def first_month_retention(agg_cohort_retention: DataFrame) -> DataFrame:
    return agg_cohort_retention.agg(
        mean(F.when(c("months_since_acquisition") == 1, c("retention_pct")), 2).alias("month_one_retention_pct")
    )


def monthly_late_rate(agg_delivery_performance: DataFrame) -> DataFrame:
    late = F.sum(F.when(c("is_late_delivery"), c("order_count")).otherwise(0))
    return (
        agg_delivery_performance.groupBy("year_month")
        .agg(F.sum("order_count").alias("all_orders"), late.alias("late_orders"))
        .withColumn("late_pct", percent(c("late_orders"), c("all_orders")))
        .orderBy("year_month")
    )


def late_reviews_read_negative(sentiment_summary: DataFrame) -> DataFrame:
    """Share of reviews on late orders whose text reads as negative."""
    late = F.when(c("is_late_delivery"), c("review_count")).otherwise(0)
    negative = F.when(c("predicted_sentiment") == "negative", late).otherwise(0)
    return sentiment_summary.agg(
        F.sum(late).alias("late_reviews"),
        F.sum(negative).alias("late_negative_reviews"),
        percent(F.sum(negative), F.sum(late)).alias("late_negative_pct"),
    )


def region_rollup(agg_geographic_revenue: DataFrame) -> DataFrame:
    return (
        agg_geographic_revenue.groupBy("region")
        .agg(
            F.sum("revenue").cast("decimal(20,2)").alias("revenue"),
            F.sum("order_count").alias("orders"),
            F.sum("customer_count").alias("customers"),
            mean("avg_delivery_days", 6).alias("avg_delivery_days"),
            mean("avg_review_score", 6).alias("avg_review_score"),
            mean("freight_to_gmv_pct", 6).alias("freight_to_gmv_pct"),
        )
        .orderBy(c("revenue").desc())
    )


def state_spread(agg_geographic_revenue: DataFrame) -> DataFrame:
    """How many states, the largest, the median freight burden and the range of delivery times."""
    largest = F.struct(-c("revenue"), c("state"))
    return agg_geographic_revenue.agg(
        F.count("*").alias("states"),
        _first_by("state", largest).alias("largest_state"),
        _first_by("revenue_share_pct", largest).alias("largest_share_pct"),
        decimal(F.median("freight_to_gmv_pct"), 20, 4).alias("median_freight_pct"),
        F.min("avg_delivery_days").alias("fastest_days"),
        F.max("avg_delivery_days").alias("slowest_days"),
    )


def north_against_southeast(agg_geographic_revenue: DataFrame) -> DataFrame:
    side = (
        F.when(c("region").isin("North", "Northeast"), F.lit("north"))
        .when(c("region") == "Southeast", F.lit("southeast"))
    )
    return (
        agg_geographic_revenue.withColumn("side", side)
        .filter("side is not null")
        .groupBy("side")
        .agg(
            mean("freight_to_gmv_pct", 6).alias("freight_to_gmv_pct"),
            mean("avg_delivery_days", 6).alias("avg_delivery_days"),
            mean("avg_review_score", 6).alias("avg_review_score"),
        )
    )


def forecast_horizon(revenue_forecast_daily: DataFrame) -> DataFrame:
    ahead = revenue_forecast_daily.filter("is_forecast")
    return ahead.agg(
        F.count("*").alias("days"),
        *[decimal(F.sum(name), 20, 2).alias(name) for name in ("forecast_revenue", "forecast_lower", "forecast_upper")],
    )


def forecast_improvement(forecast_model_metrics: DataFrame, model: str = "trend_fourier") -> DataFrame:
    """Best model by holdout RMSE, and how far the trained model beats the naive one."""
    trained = F.max(F.when(c("model") == model, c("rmse")))
    naive = F.max(F.when(c("model") == "seasonal_naive", c("rmse")))
    return forecast_model_metrics.agg(
        F.min_by("model", F.struct("rmse", "model")).alias("best_model"),
        ((1 - trained / F.nullif(naive, F.lit(0.0))) * 100).alias("rmse_improvement_pct"),
        F.max(F.when(c("model") == model, c("mape"))).alias("holdout_mape"),
    )


def forecast_months(revenue_forecast_monthly: DataFrame) -> DataFrame:
    return revenue_forecast_monthly.select(
        F.date_format("month_start_date", "yyyy-MM").alias("month"),
        "actual_revenue",
        "forecast_revenue",
        "forecast_lower",
        "forecast_upper",
        "is_forecast_month",
    ).orderBy("month")
