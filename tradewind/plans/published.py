"""Datasets for readers, and parameterised serving queries.

Nothing here exposes customer or item rows, except the lookup of one named customer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.rules import mean, quotient, round_double

if TYPE_CHECKING:
    from tradewind.sources.store import Store

MAX_PAGE_SIZE = 500


def page(limit: int) -> int:
    if not 1 <= limit <= MAX_PAGE_SIZE:
        raise ValueError(f"limit must lie between 1 and {MAX_PAGE_SIZE}")
    return limit


# --------------------------------------------------------------- serving queries
def kpis(agg_kpi_summary: DataFrame) -> DataFrame:
    return agg_kpi_summary


def customer_segment(agg_customer_rfm: DataFrame, customer_key: str, customer_segments: DataFrame | None = None) -> DataFrame:
    """One customer's segment; the cluster label is NULL until clusters exist."""
    person = agg_customer_rfm.filter(F.col("customer_key") == customer_key).select(
        "customer_key",
        "customer_state",
        "recency_days",
        "frequency",
        "monetary",
        "rfm_segment",
        "lifecycle_stage",
    )
    if customer_segments is None:
        return person.withColumn("cluster_label", F.lit(None).cast("string"))
    label = customer_segments.filter(F.col("customer_key") == customer_key).select("customer_key", "cluster_label")
    return person.join(label, "customer_key", "left")


def _segment_groups(agg_customer_rfm: DataFrame, *more) -> DataFrame:
    return (
        agg_customer_rfm.groupBy("rfm_segment", "lifecycle_stage")
        .agg(
            F.count("*").alias("customer_count"),
            mean("recency_days", 0).alias("avg_recency_days"),
            mean("frequency", 2).alias("avg_frequency"),
            mean("monetary", 2).alias("avg_monetary"),
            F.sum("monetary").cast("decimal(20,2)").alias("total_monetary"),
            *more,
        )
        .orderBy(F.col("total_monetary").desc())
    )


def segments(agg_customer_rfm: DataFrame) -> DataFrame:
    return _segment_groups(agg_customer_rfm)


def rfm_segments(agg_customer_rfm: DataFrame) -> DataFrame:
    return _segment_groups(agg_customer_rfm, mean("avg_review_score", 2).alias("avg_review_score"))


def forecast(revenue_forecast_daily: DataFrame, horizon_only: bool = True, limit: int = 180) -> DataFrame:
    days = revenue_forecast_daily.filter("is_forecast") if horizon_only else revenue_forecast_daily
    return (
        days.select(
            F.col("ds").cast("date").alias("date"),
            "forecast_revenue",
            "forecast_lower",
            "forecast_upper",
            "is_forecast",
        )
        .orderBy("date")
        .limit(page(limit))
    )


def categories(agg_category_performance: DataFrame, limit: int = 25) -> DataFrame:
    return (
        agg_category_performance.select(
            "product_category", "revenue", "order_count", "revenue_share_pct", "avg_review_score"
        )
        .orderBy(F.col("revenue").desc(), "product_category")
        .limit(page(limit))
    )


def sellers(agg_seller_performance: DataFrame, limit: int = 50, at_risk_only: bool = False) -> DataFrame:
    shops = agg_seller_performance.filter("is_at_risk_seller") if at_risk_only else agg_seller_performance
    return (
        shops.select(
            "seller_id",
            "seller_state",
            "revenue",
            "order_count",
            "avg_review_score",
            "late_delivery_pct",
            "is_at_risk_seller",
        )
        .orderBy(F.col("revenue").desc(), "seller_id")
        .limit(page(limit))
    )


def delivery_impact(agg_delivery_review_correlation: DataFrame) -> DataFrame:
    return agg_delivery_review_correlation


def sentiment_summary(review_sentiment: DataFrame) -> DataFrame:
    return review_sentiment.groupBy("predicted_sentiment", "rating_sentiment", "is_late_delivery").agg(
        F.count("*").alias("review_count"),
        round_double(F.avg("sentiment_probability"), 4).alias("avg_probability"),
        quotient(F.sum("review_score"), F.count("review_score"), 2).alias("avg_review_score"),
    )


# ------------------------------------------------------------- dataset registry
@dataclass(frozen=True)
class Dataset:
    """A published dataset: the relation it needs and, if not all of it, what to read from it."""

    name: str
    relation: str
    description: str
    required: bool = True
    row_limit: int | None = None
    order_by: str | None = None
    query: Callable[[DataFrame], DataFrame] | None = None

    def frame(self, store: Store) -> DataFrame:
        df = store.read(self.relation)
        if self.query:
            return self.query(df)
        if self.row_limit:
            return df.orderBy(F.col(self.order_by).desc()).limit(self.row_limit)
        return df


def _aggregate(name: str, table: str, description: str, **more) -> Dataset:
    return Dataset(name, f"analytics.{table}", description, **more)


def _model(name: str, table: str, description: str, **more) -> Dataset:
    return Dataset(name, f"ml.{table}", description, required=False, **more)


DATASETS: tuple[Dataset, ...] = (
    _aggregate("kpi_summary", "agg_kpi_summary", "Headline figures."),
    _aggregate("revenue_monthly", "agg_revenue_monthly", "Monthly revenue and growth."),
    _aggregate("category_performance", "agg_category_performance", "Categories by revenue."),
    _aggregate(
        "seller_performance",
        "agg_seller_performance",
        "The 500 sellers with most revenue.",
        row_limit=500,
        order_by="revenue",
    ),
    _aggregate("delivery_performance", "agg_delivery_performance", "Delivery speed per month."),
    _aggregate("delivery_review", "agg_delivery_review_correlation", "Review score by lateness."),
    _aggregate("cohort_retention", "agg_cohort_retention", "Retention by acquisition month."),
    _aggregate("geographic_revenue", "agg_geographic_revenue", "Revenue and freight by state."),
    _model("segment_profiles", "segment_profiles", "Cluster profiles."),
    _model("segment_metrics", "segment_model_metrics", "Quality of each candidate cluster count."),
    _model("forecast_daily", "revenue_forecast_daily", "Daily actuals and forecast."),
    _model("forecast_monthly", "revenue_forecast_monthly", "Forecast by month."),
    _model("forecast_metrics", "forecast_model_metrics", "Backtest against the baseline."),
    _model("sentiment_metrics", "sentiment_model_metrics", "Holdout quality of the review classifier."),
    _model("sentiment_terms", "sentiment_top_terms", "Most telling terms."),
    _aggregate("rfm_segments", "agg_customer_rfm", "Segments in total, never by customer.", query=rfm_segments),
    _model("sentiment_summary", "review_sentiment", "Text against stars, by lateness.", query=sentiment_summary),
)
DATASETS_BY_NAME = {dataset.name: dataset for dataset in DATASETS}


def dataset_named(name: str) -> Dataset:
    if name not in DATASETS_BY_NAME:
        raise KeyError(f"Unknown dataset '{name}'. Available: {', '.join(sorted(DATASETS_BY_NAME))}")
    return DATASETS_BY_NAME[name]
