"""Semantics of single models on small literal inputs, and invariants of the built star schema."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.functions import rules
from tradewind.plans import analytics, core, orders, staging
from tradewind.plans.warehouse import MODELS, Warehouse
from tradewind.tables import source_table

T0 = dt.datetime(2018, 1, 1, 12)


def raw(spark, name, *rows):
    table = source_table(name)
    return spark.createDataFrame([tuple(row.get(c) for c in table.columns) for row in rows], table.schema)


def test_exact_rounding(spark):
    row = spark.createDataFrame([("1.00", "1.03")], "a string, b string").selectExpr("1").first()
    assert row is not None
    frame = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.03"),)], "x decimal(12,2)")
    assert frame.agg(rules.mean("x", 2)).first()[0] == Decimal("1.02")
    zero = spark.range(1).select(rules.quotient(F.lit(1), F.lit(0), 2)).first()[0]
    assert zero is None


def test_recognised_revenue_drops_unknown_status(spark):
    frame = spark.createDataFrame([("delivered",), ("canceled",), ("unavailable",), (None,)], "order_status string")
    assert [r[0] for r in frame.filter(rules.revenue_recognised()).collect()] == ["delivered"]


@pytest.mark.parametrize(
    ("days", "speed", "lateness"),
    [
        (None, "not_delivered", None),
        (3, "0-3 days", "1-3 days late"),
        (4, "4-7 days", "4-7 days late"),
        (14, "8-14 days", "8-14 days late"),
        (30, "15-30 days", "15+ days late"),
        (31, "30+ days", "15+ days late"),
        (-10, "0-3 days", "10+ days early"),
        (-9, "0-3 days", "1-9 days early"),
        (0, "0-3 days", "on the promise date"),
    ],
)
def test_buckets(spark, days, speed, lateness):
    frame = spark.createDataFrame([(days,)], "d int")
    row = frame.select(
        rules.delivery_speed_bucket(F.col("d")), rules.lateness_label(rules.lateness_position(F.col("d")))
    ).first()
    assert row[0] == speed
    if lateness:
        assert row[1] == lateness


def test_regions(spark):
    states = [state for group in rules.REGION_STATES.values() for state in group]
    assert len(states) == len(set(states)) == 27
    row = spark.range(1).select(rules.region_of(F.lit("SP")), rules.region_of(F.lit("ZZ"))).first()
    assert tuple(row) == ("Southeast", "Unknown")


def test_customers_are_padded_and_cleaned(spark):
    source = raw(
        spark,
        "customers",
        {"customer_id": "c", "customer_zip_code_prefix": " 123 ", "customer_city": "  ", "customer_state": " sp"},
    )
    row = staging.stg_customers(source).first()
    assert row.customer_zip_code_prefix == "00123" and row.customer_city is None and row.customer_state == "SP"


def test_geolocation_drops_points_abroad(spark):
    def point(lat, city):
        return {
            "geolocation_zip_code_prefix": "1",
            "geolocation_lat": lat,
            "geolocation_lng": -50.0,
            "geolocation_city": city,
            "geolocation_state": "sp",
        }

    source = raw(spark, "geolocation", point(-10.0, "b"), point(-12.0, "a"), point(45.0, "c"))
    row = staging.stg_geolocation(source).first()
    assert (row.latitude, row.coordinate_count, row.city) == (Decimal("-11.000000"), 2, "a")


def test_payments(spark):
    source = raw(
        spark,
        "order_payments",
        {"order_id": "o", "payment_sequential": 1, "payment_type": " Not_Defined ", "payment_installments": 0},
    )
    row = staging.stg_order_payments(source).first()
    assert (row.payment_type, row.payment_method, row.payment_installments) == ("not_defined", None, 1)


def test_latest_answered_review_wins(spark):
    def review(rid, score, answered, created=T0, order="o"):
        return {
            "review_id": rid,
            "order_id": order,
            "review_score": score,
            "review_creation_date": created,
            "review_answer_timestamp": answered,
        }

    later = T0 + dt.timedelta(days=1)
    source = raw(
        spark,
        "order_reviews",
        review("a", 5, None, later),
        review("b", 1, later),
        review("c", 2, T0),
        review("d", 9, later + dt.timedelta(days=9)),
        review("z", 3, T0, order="tie"),
        review("y", 4, T0, order="tie"),
        review("q", 4, T0, order=None),
    )
    rows = {r.order_id: r for r in staging.stg_order_reviews(source).collect()}
    assert set(rows) == {"o", "tie"}
    assert rows["o"].review_id == "b" and rows["o"].review_sentiment_label == "negative"
    assert rows["tie"].review_id == "y" and rows["tie"].has_comment is False


def test_comments_are_measured_before_reviews_are_shuffled(spark):
    source = raw(
        spark,
        "order_reviews",
        {"review_id": "a", "order_id": "o", "review_score": 5, "review_comment_message": " fine "},
        {"review_id": "b", "order_id": "p", "review_score": 1, "review_comment_message": "  "},
    )
    frame = staging.stg_order_reviews(source).select("order_id", "has_comment", "comment_length")
    assert sorted(map(tuple, frame.collect())) == [("o", True, 4), ("p", False, 0)]
    above_the_scan = frame._jdf.queryExecution().optimizedPlan().toString().rpartition("Project [")[0]
    assert "Window" in above_the_scan and "review_comment_message" not in above_the_scan


def test_products_fall_back_to_the_source_category(spark):
    names = raw(
        spark,
        "product_category_translation",
        {"product_category_name": "Moveis ", "product_category_name_english": "Furniture"},
        {"product_category_name": None, "product_category_name_english": "x"},
    )
    source = raw(
        spark,
        "products",
        {"product_id": "1", "product_category_name": " moveis", "product_length_cm": 2, "product_height_cm": 3, "product_width_cm": 4},
        {"product_id": "2", "product_category_name": "Outros", "product_weight_g": 499},
        {"product_id": "3", "product_weight_g": 10000},
    )
    staged = staging.stg_products(source, staging.stg_product_category_translation(names))
    rows = {r.product_id: r for r in core.dim_products(staged).collect()}
    assert [rows[i].product_category for i in "123"] == ["furniture", "outros", "unknown"]
    assert rows["1"].product_volume_cm3 == 24 and rows["1"].chargeable_weight_kg == Decimal("0.005")
    assert rows["2"].product_volume_cm3 is None and rows["2"].chargeable_weight_kg is None
    assert [rows[i].weight_class for i in "123"] == ["unknown", "light", "oversized"]
    assert rows["3"].is_uncategorised


def test_primary_payment(spark):
    def pay(order, seq, value, kind):
        return {"order_id": order, "payment_sequential": seq, "payment_value": value, "payment_type": kind, "payment_installments": seq}

    ten, five = Decimal("10"), Decimal("5")
    source = raw(
        spark,
        "order_payments",
        pay("a", 1, five, "voucher"),
        pay("a", 2, ten, "boleto"),
        pay("b", 2, ten, "voucher"),
        pay("b", 1, ten, "credit_card"),
        pay("c", 1, ten, "boleto"),
        pay("c", 2, None, "debit_card"),
    )
    rows = {r.order_id: r for r in orders.int_order_payments_summary(staging.stg_order_payments(source)).collect()}
    assert [rows[o].primary_payment_type for o in "abc"] == ["boleto", "credit_card", "debit_card"]
    assert rows["a"].used_voucher and not rows["a"].used_credit_card and rows["a"].is_split_payment
    assert rows["a"].paid_total == Decimal("15.00")


def test_segment_rules(spark):
    cases = {
        (5, 4, 1): "Champions", (3, 3, 4): "Loyal", (5, 1, 5): "Big Spenders", (4, 2, 3): "New / Promising",
        (3, 1, 5): "Needs Attention", (2, 1, 4): "At Risk", (2, 5, 1): "Hibernating", (1, 5, 4): "Lost High Value",
        (1, 1, 1): "Lost", (4, 3, 3): "Lost", (3, 4, 4): "Loyal",
    }
    frame = spark.createDataFrame(list(cases), "r int, f int, m int")
    for row in frame.withColumn("s", analytics.rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect():
        assert row.s == cases[(row.r, row.f, row.m)]


# ------------------------------------------------------------------ built star schema
def test_grain_and_reconciliation(warehouse):
    fact, items = warehouse["fact_orders"], warehouse["fact_order_items"]
    assert fact.count() == fact.select("order_id").distinct().count() == warehouse["orders"].count()
    assert items.count() == warehouse["order_items"].count()
    totals = fact.agg(F.sum("order_total")).first()[0], items.agg(F.sum("item_total")).first()[0]
    assert totals[0] == totals[1]


def test_dimension_keys_are_unique(warehouse):
    keys = {
        "dim_customers": "customer_key",
        "dim_products": "product_key",
        "dim_sellers": "seller_key",
        "dim_geography": "geography_key",
        "dim_date": "date_key",
    }
    for name, key in keys.items():
        assert warehouse[name].count() == warehouse[name].select(key).distinct().count()
    assert warehouse["dim_customers"].count() < warehouse["fact_orders"].count()


def test_dates_cover_a_year_ahead(warehouse):
    row = warehouse["dim_date"].agg(F.min("date_day"), F.max("date_day")).first()
    last = warehouse["fact_orders"].agg(F.max("order_purchase_date")).first()[0]
    assert (row[0].month, row[0].day) == (1, 1) and row[1] == dt.date(last.year + 1, 12, 31)


def test_kpis(warehouse):
    rows = warehouse["agg_kpi_summary"].collect()
    assert len(rows) == 1
    assert Decimal("99.9") <= rows[0].on_time_delivery_pct + rows[0].late_delivery_pct <= Decimal("100.1")
    everything = warehouse["fact_orders"].agg(F.sum("order_total")).first()[0]
    assert rows[0].total_revenue <= everything


def test_late_delivery_lowers_scores(warehouse):
    row = warehouse["agg_delivery_review_correlation"].filter("lateness_bucket = 'ALL DELIVERED'").first()
    assert row.correlation_coefficient < 0 and row.share_of_delivered_pct == 100


def test_the_lateness_total_holds_more_money_than_fourteen_digits(spark):
    fact = spark.range(300).selectExpr(
        "true as is_delivered",
        "timestamp_ntz'2018-01-02 00:00:00' as order_delivered_customer_date",
        "timestamp_ntz'2018-01-05 00:00:00' as order_estimated_delivery_date",
        "cast(id % 5 + 1 as int) as review_score",
        "1 as delivery_days",
        "9999999999.99BD as order_total",
    )
    rows = {r.lateness_bucket: r for r in analytics.agg_delivery_review_correlation(fact).collect()}
    assert rows["1-9 days early"].revenue == rows["ALL DELIVERED"].revenue == Decimal("2999999999997.00")
    assert rows["ALL DELIVERED"].order_count == 300


def test_same_day_delivery_after_the_promise_is_late_but_in_the_promise_bucket(warehouse):
    fact = warehouse["fact_orders"]
    assert fact.filter("is_late_delivery and days_early_vs_estimate = 0").count() > 0


def test_rfm_covers_billed_customers(warehouse):
    billed = warehouse["fact_orders"].filter(rules.revenue_recognised()).select("customer_key").distinct().count()
    assert warehouse["agg_customer_rfm"].count() == billed


def test_unknown_model(warehouse):
    with pytest.raises(KeyError, match="Unknown model"):
        warehouse["nope"]
    assert len(MODELS) == 27


def test_facts_are_laid_out_by_month(warehouse, spark):
    stored = spark.read.parquet(warehouse.path("fact_orders"))
    plan = stored.filter("order_month = '1997-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert "order_month" not in warehouse["fact_orders"].columns


def test_unused_halves_of_the_fact_are_not_computed(spark, sf_dir):
    from tradewind import Warehouse

    lazy = Warehouse.over_market(spark, sf_dir)
    plan = lazy["agg_revenue_monthly"]._jdf.queryExecution().executedPlan().toString()
    read = " ".join(re.findall(r"ReadSchema: (\S+)", plan))
    assert "l_extendedprice" in read
    for unused in ("o_totalprice", "l_partkey", "text", "c_nationkey"):
        assert unused not in read
    assert "Expand" not in plan


# ------------------------------------------------------------------ facts by month
def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fact", ["fact_orders", "fact_order_items"])
def test_a_range_of_days_reads_only_its_months(warehouse, fact):
    chosen = warehouse.between(fact, "1996-11-20", "1997-02-10")
    assert "order_month" in plan_of(chosen.agg(F.count("*"))).split("PartitionFilters: [")[1].split("]")[0]
    files = chosen.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("order_month=")[1][:7] for r in files} == {"1996-11", "1996-12", "1997-01", "1997-02"}
    day = F.col("order_purchase_date")
    whole = warehouse[fact].filter(day.between("1996-11-20", "1997-02-10"))
    assert chosen.columns == whole.columns and chosen.exceptAll(whole).count() == 0 == whole.exceptAll(chosen).count()


def test_chosen_days_of_the_calendar_prune_while_the_query_runs(warehouse):
    days = warehouse["dim_date"].filter("year_number = 1997 and month_number in (3, 4) and is_weekend")
    joined = warehouse.on_dates("fact_orders", days)
    assert "dynamicpruning" in plan_of(joined.agg(F.sum("order_total")))
    want = warehouse["fact_orders"].join(days, F.col("order_purchase_date") == F.col("date_day"))
    assert joined.count() == want.count() > 0


def test_ranges_over_facts_that_are_not_built(spark, sf_dir, warehouse):
    lazy = Warehouse.over_market(spark, sf_dir)
    ranged = lazy.between("fact_orders", "1997-03-01", "1997-03-31")
    assert ranged.count() == warehouse.between("fact_orders", "1997-03-01", "1997-03-31").count()
    with pytest.raises(KeyError, match="no fact"):
        lazy.between("dim_sellers", "1997-03-01", "1997-03-31")


def test_larger_input_means_more_tasks_not_larger_ones(spark, sf_dir):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    Warehouse.over_market(spark, sf_dir)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "200"


def test_facts_for_whole_readers_are_not_dealt_by_month(spark, sf_dir, warehouse, tmp_path):
    star = Warehouse.over_market(spark, sf_dir).build(str(tmp_path), ["fact_orders", "dim_date"], by_month=False)
    assert not list(tmp_path.glob("marts/fact_orders/order_month=*"))
    assert sorted(star["fact_orders"].collect(), key=str) == sorted(warehouse["fact_orders"].collect(), key=str)
    days = ("1996-11-20", "1997-02-10")
    assert star.between("fact_orders", *days).count() == warehouse.between("fact_orders", *days).count() > 0
