"""Which check applies to which column, and running them.

Row checks of one table share one scan. Keys and relationships aggregate first. A summary holds
one line per check; failing rows are only produced, and written, for checks that fail.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.operators import quality as q
from tradewind.plans.warehouse import LAYERS, Warehouse
from tradewind.session import scratch_path

STATUSES = (
    "delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved",
)
SCORES = (1, 2, 3, 4, 5)
SEGMENTS = (
    "Champions", "Loyal", "Big Spenders", "New / Promising", "Needs Attention", "At Risk", "Hibernating",
    "Lost High Value", "Lost",
)
SPEEDS = ("0-3 days", "4-7 days", "8-14 days", "15-30 days", "30+ days", "not_delivered")
REGIONS = ("North", "Northeast", "Central-West", "Southeast", "South", "Unknown")


@dataclass(frozen=True)
class Check:
    layer: str
    model: str
    kind: str
    column: str = ""
    values: tuple = ()
    other: str = ""
    other_column: str = ""
    rule: str = ""
    where: str | None = None
    tolerance: float = 0.01
    label: str = ""

    @property
    def name(self) -> str:
        scope = "source_" if self.layer == "sources" else ""
        return f"{scope}{self.label or '_'.join(filter(None, (self.kind, self.model, self.column)))}"

    @property
    def needs(self) -> tuple[str, ...]:
        return (self.model, self.other) if self.other else (self.model,)


def _declare(layer: str, model: str, *, key="", required="", positive="", accepted=(), parents=(), rules=(), combos=()):
    """Checks of one model. ``key`` columns are required and unique, ``positive`` ones required
    and not negative."""
    for column in key.split():
        yield Check(layer, model, "not_null", column)
        yield Check(layer, model, "unique", column)
    for column in required.split():
        yield Check(layer, model, "not_null", column)
    for column in positive.split():
        yield Check(layer, model, "not_null", column)
        yield Check(layer, model, "not_negative", column)
    for column, values in accepted:
        yield Check(layer, model, "accepted_values", column, values=values)
    for column, parent, field in parents:
        yield Check(layer, model, "relationships", column, other=parent, other_column=field)
    for label, rule, where in rules:
        yield Check(layer, model, "expression_is_true", rule=rule, where=where, label=label)
    for columns in combos:
        yield Check(layer, model, "unique_combination", columns)


def _sources():
    on = lambda *a, **k: _declare("sources", *a, **k)
    yield from on("customers", key="customer_id", required="customer_unique_id")
    yield from on("geolocation", required="geolocation_zip_code_prefix")
    yield from on("order_items", required="order_id order_item_id price")
    yield from on("order_payments", required="order_id payment_value")
    yield from on("order_reviews", required="order_id review_score", accepted=[("review_score", SCORES)])
    yield from on(
        "orders",
        key="order_id",
        required="customer_id",
        accepted=[("order_status", STATUSES)],
        parents=[("customer_id", "customers", "customer_id")],
    )
    yield from on("products", key="product_id")
    yield from on("sellers", key="seller_id")
    yield from on("product_category_translation", key="product_category_name")


def _staging():
    on = lambda *a, **k: _declare("staging", *a, **k)
    to_orders = ("order_id", "stg_orders", "order_id")
    yield from on(
        "stg_customers",
        key="customer_id",
        required="customer_unique_id customer_zip_code_prefix customer_state",
    )
    yield from on(
        "stg_orders",
        key="order_id",
        required="customer_id order_status order_purchase_timestamp",
        accepted=[("order_status", STATUSES)],
        parents=[("customer_id", "stg_customers", "customer_id")],
        rules=[
            (
                "stg_orders_delivery_after_purchase",
                "order_delivered_customer_date is null or order_delivered_customer_date >= order_purchase_timestamp",
                None,
            )
        ],
    )
    yield from on(
        "stg_order_items",
        key="order_item_key",
        required="order_id product_id seller_id",
        positive="item_price freight_value",
        parents=[
            to_orders,
            ("product_id", "stg_products", "product_id"),
            ("seller_id", "stg_sellers", "seller_id"),
        ],
    )
    yield from on(
        "stg_order_payments",
        key="order_payment_key",
        required="order_id",
        positive="payment_value payment_installments",
        parents=[to_orders],
    )
    yield from on(
        "stg_order_reviews",
        key="order_id",
        required="review_score",
        accepted=[("review_score", SCORES), ("review_sentiment_label", ("positive", "neutral", "negative"))],
        parents=[to_orders],
    )
    yield from on("stg_products", key="product_id", required="product_category")
    yield from on("stg_sellers", key="seller_id", required="seller_state")
    yield from on(
        "stg_product_category_translation",
        key="product_category_name",
        required="product_category_name_english",
    )
    yield from on("stg_geolocation", key="zip_code_prefix", required="latitude longitude")


def _marts():
    on = lambda *a, **k: _declare("marts", *a, **k)
    to_places = ("geography_key", "dim_geography", "geography_key")
    to_dates = ("order_date_key", "dim_date", "date_key")
    yield from on("dim_date", key="date_key date_day", required="year_month")
    yield from on(
        "dim_customers",
        key="customer_key",
        required="geography_key acquisition_cohort_month customer_state",
        positive="lifetime_order_count",
        parents=[to_places],
        rules=[
            ("dim_customers_tenure_non_negative", "latest_order_at >= first_order_at", None),
            ("dim_customers_repeat_flag_consistent", "is_repeat_customer = (lifetime_order_count > 1)", None),
        ],
    )
    yield from on(
        "dim_products",
        key="product_key",
        required="product_category",
        accepted=[("weight_class", ("light", "medium", "heavy", "oversized", "unknown"))],
    )
    yield from on("dim_sellers", key="seller_key", required="seller_state")
    yield from on("dim_geography", key="geography_key", required="state region", accepted=[("region", REGIONS)])
    yield from on(
        "fact_orders",
        key="order_id",
        required="customer_key geography_key order_date_key delivery_speed_bucket",
        positive="order_total gross_merchandise_value freight_total",
        accepted=[("review_score", SCORES), ("delivery_speed_bucket", SPEEDS)],
        parents=[("customer_key", "dim_customers", "customer_key"), to_places, to_dates],
        rules=[
            (
                "fact_orders_total_is_gmv_plus_freight",
                "order_total = gross_merchandise_value + freight_total",
                None,
            ),
            ("fact_orders_delivery_days_non_negative", "delivery_days >= 0", "delivery_days is not null"),
            (
                "fact_orders_delivered_rows_have_lateness_flag",
                "is_late_delivery is not null",
                "is_delivered",
            ),
        ],
    )
    yield Check("marts", "fact_orders", "equal_rowcount", other="stg_orders")
    yield Check(
        "marts",
        "fact_orders",
        "sums_match",
        "gross_merchandise_value",
        other="stg_order_items",
        other_column="item_price",
        tolerance=0.05,
    )
    yield from on(
        "fact_order_items",
        key="order_item_key",
        required="order_id product_key seller_key order_date_key",
        positive="item_price freight_value",
        parents=[
            ("order_id", "fact_orders", "order_id"),
            ("product_key", "dim_products", "product_key"),
            ("seller_key", "dim_sellers", "seller_key"),
            to_dates,
        ],
        combos=["order_id order_item_id"],
    )
    yield Check("marts", "fact_order_items", "equal_rowcount", other="stg_order_items")
    yield Check("marts", "fact_orders", "lifecycle_out_of_order")
    yield Check("marts", "dim_customers", "customers_off_order_count", other="fact_orders")
    yield Check("marts", "fact_order_items", "orphan_items", other="fact_orders")
    yield Check("marts", "fact_orders", "unreconciled_orders", other="fact_order_items")


def _analytics():
    on = lambda *a, **k: _declare("analytics", *a, **k)
    yield from on(
        "agg_kpi_summary",
        required="repeat_customer_pct",
        positive="total_orders total_revenue",
        rules=[
            ("agg_kpi_summary_has_data", "total_orders > 0 and total_customers > 0", None),
            (
                "agg_kpi_summary_delivery_rates_sum_to_100",
                "on_time_delivery_pct + late_delivery_pct between 99.9 and 100.1",
                None,
            ),
        ],
    )
    yield from on(
        "agg_revenue_monthly",
        key="month_start_date year_month",
        positive="revenue order_count",
        rules=[("agg_revenue_monthly_revenue_includes_freight", "revenue >= gmv", None)],
    )
    yield from on("agg_category_performance", key="product_category", required="revenue_rank", positive="revenue")
    yield from on("agg_seller_performance", key="seller_key", positive="revenue")
    yield Check("analytics", "agg_seller_performance", "not_negative", "late_delivery_pct")
    yield from on(
        "agg_delivery_performance",
        required="delivery_speed_bucket",
        positive="order_count",
        combos=["month_start_date delivery_speed_bucket is_late_delivery"],
    )
    yield from on(
        "agg_delivery_review_correlation",
        key="lateness_bucket",
        required="avg_review_score",
        positive="order_count",
    )
    yield from on(
        "agg_customer_rfm",
        key="customer_key",
        required="rfm_segment",
        positive="recency_days frequency monetary",
        accepted=[("rfm_segment", SEGMENTS), ("lifecycle_stage", ("Active", "Cooling", "Lost"))],
        parents=[("customer_key", "dim_customers", "customer_key")],
        rules=[
            ("agg_customer_rfm_recency_score_in_range", "recency_score between 1 and 5", None),
            ("agg_customer_rfm_total_score_in_range", "rfm_score between 3 and 15", None),
        ],
    )
    yield from on(
        "agg_cohort_retention",
        required="cohort_month retention_pct",
        positive="months_since_acquisition",
        combos=["cohort_month months_since_acquisition"],
        rules=[("agg_cohort_retention_active_within_cohort", "active_customers <= cohort_size", None)],
    )
    yield from on("agg_geographic_revenue", key="state", required="region", positive="revenue")


CHECKS: tuple[Check, ...] = (*_sources(), *_staging(), *_marts(), *_analytics())

_ROW_CHECKS = {
    "not_null": lambda k: q.null_value(k.column),
    "accepted_values": lambda k: q.unaccepted_value(k.column, k.values),
    "not_negative": lambda k: q.negative_value(k.column),
    "expression_is_true": lambda k: q.broken_rule(k.rule, k.where),
}


def failing_rows(check: Check, frames: Warehouse | dict[str, DataFrame]) -> DataFrame:
    df = frames[check.model]
    other = frames[check.other] if check.other else None
    if check.kind in _ROW_CHECKS:
        return df.filter(_ROW_CHECKS[check.kind](check))
    match check.kind:
        case "unique":
            return q.unique(df, check.column)
        case "unique_combination":
            return q.unique_combination(df, check.column.split())
        case "relationships":
            return q.relationships(df, check.column, other, check.other_column)
        case "equal_rowcount":
            return q.equal_rowcount(df, other)
        case "sums_match":
            return q.sums_match(df, check.column, other, check.other_column, check.tolerance)
        case "lifecycle_out_of_order":
            return q.lifecycle_out_of_order(df)
        case "customers_off_order_count":
            return q.customers_off_order_count(df, other)
        case "orphan_items":
            return q.orphan_items(df, other)
        case "unreconciled_orders":
            return q.unreconciled_orders(df, other)
    raise ValueError(f"unknown check kind '{check.kind}'")


def _failures(check: Check, frames) -> Column:
    rows = failing_rows(check, frames)
    counted = F.coalesce(F.sum("rows"), F.lit(0)) if check.kind == "relationships" else F.count("*")
    return rows.agg(counted.cast("long").alias("failures"))


def summary(checks: Iterable[Check], frames: Warehouse | dict[str, DataFrame]) -> DataFrame:
    """(test, model, failures), one line per check."""
    lines: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for check in checks:
        if check.kind in _ROW_CHECKS:
            by_model.setdefault(check.model, []).append(check)
        else:
            lines.append(
                _failures(check, frames).select(
                    F.lit(check.name).alias("test"), F.lit(check.model).alias("model"), "failures"
                )
            )
    for model, group in by_model.items():
        scanned = frames[model].agg(
            F.array(
                *[
                    F.struct(
                        F.lit(k.name).alias("test"),
                        F.lit(model).alias("model"),
                        F.count_if(_ROW_CHECKS[k.kind](k)).alias("failures"),
                    )
                    for k in group
                ]
            ).alias("lines")
        )
        lines.append(scanned.select(F.inline("lines")))
    return reduce(DataFrame.unionByName, lines)


def of_layer(layer: str) -> list[Check]:
    return [check for check in CHECKS if check.layer == layer]


def layer_summary(warehouse: Warehouse, layer: str) -> DataFrame:
    """Summary of one layer, over tables built for the purpose so that no check derives them again."""
    checks = of_layer(layer)
    if layer == "sources":
        return summary(checks, warehouse)
    needed = {name for check in checks for name in check.needs}
    if layer == "analytics":
        needed |= {model.__name__ for model in LAYERS["marts"]}
    return summary(checks, warehouse.build(scratch_path(warehouse.spark, "checked"), needed, by_month=False))


class ChecksFailed(RuntimeError):
    pass


def run(warehouse: Warehouse, folder: str, checks: Iterable[Check] = CHECKS) -> DataFrame:
    """Write the summary and the failing rows of failed checks, then raise if there were any."""
    checks = list(checks)
    table = f"{folder.rstrip('/')}/summary"
    summary(checks, warehouse).write.mode("overwrite").parquet(table)
    written = warehouse.spark.read.parquet(table)
    failed = {row["test"]: row["failures"] for row in written.filter("failures > 0").collect()}
    for check in checks:
        if check.name in failed:
            failing_rows(check, warehouse).write.mode("overwrite").parquet(f"{folder}/failures/{check.name}")
    if failed:
        listing = ", ".join(f"{name} ({count})" for name, count in sorted(failed.items()))
        raise ChecksFailed(f"{len(failed)} check(s) failed: {listing}")
    return written
