"""Every query by name: a function of the session and the folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tradewind.functions import text
from tradewind.functions.rules import c
from tradewind.ml import forecasting, ngrams, segmentation, sentiment
from tradewind.ml.common import ModelRun
from tradewind.plans import checks, insights, published
from tradewind.plans.warehouse import LAYERS, MODELS, Warehouse
from tradewind.session import materialise, scratch_path
from tradewind.sources import csv_files, market
from tradewind.sources.raw_zone import RawZone, merged
from tradewind.sources.store import Store, export_snapshot
from tradewind.streaming import jobs
from tradewind.tables import SOURCE_TABLES, source_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        return function

    return register


def _over(function: Callable[..., DataFrame], *inputs: str, **options) -> Query:
    """A query that feeds named models to ``function``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse.over_market(spark, sf_dir)
        return function(*(warehouse[name] for name in inputs), **options)

    return run


# ------------------------------------------------------------------ sources and models
def _source(name: str) -> Query:
    return lambda spark, sf_dir: market.read(spark, sf_dir, name)


for _name in market.READERS:
    QUERIES[f"src_{_name}"] = _source(_name)
for _name in MODELS:
    QUERIES[_name] = _over(lambda frame: frame, _name)


# ------------------------------------------------------------------------ loading
def _csv_copy(name: str) -> Query:
    """Write a source table as CSV and read it back through permissive typing."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = source_table(name)
        folder = scratch_path(spark, "csv")
        path = f"{folder}/{table.file.replace('*', '')}"
        market.read(spark, sf_dir, name).write.option("escape", '"').csv(path, header=True)
        return csv_files.read_table(spark, folder, name).drop("_source_file")

    return run


for _table in ("orders", "order_items", "order_reviews", "geolocation"):
    QUERIES[f"load_csv_{_table}"] = _csv_copy(_table)


@query()
def load_merge_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert one correction per line item into the products: many rows per key, most keys hit."""
    target = market.read(spark, sf_dir, "products")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    columns = source_table("products").schema
    known = {
        "product_id": F.concat(F.lit("p"), c("l_partkey").cast("string")),
        "product_category_name": F.concat(F.lit("flag_"), c("l_returnflag")),
        "product_name_lenght": c("l_linenumber"),
        "product_weight_g": (c("l_quantity") * 10).cast("int"),
    }
    incoming = lines.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in columns.fields]
    )
    return merged(target, incoming, ["product_id"])


@query()
def load_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all nine tables twice and report what the raw zone then holds."""
    zone = RawZone(spark, scratch_path(spark, "zone"))
    sources = {table.name: market.read(spark, sf_dir, table.name) for table in SOURCE_TABLES}
    sources["order_items"] = materialise(sources["order_items"], "source")  # numbering items sorts all lines: done once
    for _ in range(2):
        for name, source in sources.items():
            zone.load(name, source)
    loads = zone.audit().groupBy("table_name").agg(F.count("*").alias("loads"))
    return zone.load_status().join(loads, "table_name").drop("last_loaded")


@query()
def load_bucket_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the customers, then correct one of them: rows, and buckets written by each load."""
    zone = RawZone(spark, scratch_path(spark, "zone"))
    customers = market.read(spark, sf_dir, "customers")
    zone.load("customers", customers)
    one = customers.agg(F.min("customer_id")).scalar()
    zone.load("customers", customers.filter(c("customer_id") == one).withColumn("customer_city", F.lit("moved")))
    moved = zone.read("customers").agg(F.count_if(c("customer_city") == "moved")).scalar()
    step = F.row_number().over(Window.orderBy("sequence")).alias("step")  # two audit rows
    return zone.audit().select(step, "rows_in_source", "rows_loaded", "buckets_written").withColumn("moved", moved)


@query()
def validate_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all nine tables and check them, published sizes included."""
    zone = RawZone(spark, scratch_path(spark, "zone"))
    for table in SOURCE_TABLES:
        zone.load(table.name, market.read(spark, sf_dir, table.name))
    return zone.validation(strict=True).withColumn("measured", F.round("measured", 6))


@query()
def raw_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and rows that repeat a key, of each keyed source table."""
    frames = []
    for table in SOURCE_TABLES:
        if table.primary_key:
            groups = market.read(spark, sf_dir, table.name).groupBy(*table.primary_key).agg(F.count("*").alias("n"))
            frames.append(
                groups.agg(F.sum("n").alias("rows"), F.sum(c("n") - 1).alias("duplicate_rows")).select(
                    F.lit(table.name).alias("table_name"), "rows", "duplicate_rows"
                )
            )
    return reduce(DataFrame.unionByName, frames)


# ------------------------------------------------------------------- data quality
def _quality(layer: str) -> Query:
    return lambda spark, sf_dir: checks.layer_summary(Warehouse.over_market(spark, sf_dir), layer)


for _layer in ("sources", "staging", "marts", "analytics"):
    QUERIES[f"quality_{_layer}"] = _quality(_layer)


# ------------------------------------------------------------------------- serving
QUERIES |= {
    "serve_kpis": _over(published.kpis, "agg_kpi_summary"),
    "serve_customer_segment": _over(published.customer_segment, "agg_customer_rfm", customer_key="u7"),
    "serve_segments": _over(published.segments, "agg_customer_rfm"),
    "serve_categories": _over(published.categories, "agg_category_performance"),
    "serve_sellers": _over(published.sellers, "agg_seller_performance"),
    "serve_sellers_at_risk": _over(published.sellers, "agg_seller_performance", at_risk_only=True),
    "serve_delivery_impact": _over(published.delivery_impact, "agg_delivery_review_correlation"),
    "serve_rfm_segments": _over(published.rfm_segments, "agg_customer_rfm"),
}


@query()
def snapshot_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the star schema and the aggregates, publish them, and list rows per dataset."""
    warehouse = Warehouse.over_market(spark, sf_dir).build(scratch_path(spark, "star"), by_month=False)
    store = Store(spark, scratch_path(spark, "store"))
    for model in LAYERS["analytics"]:
        store.write(warehouse[model.__name__], f"analytics.{model.__name__}")
    written = export_snapshot(store, scratch_path(spark, "snapshot"))
    return spark.createDataFrame(sorted(written.items()), "dataset string, rows long")


def _built_facts(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.over_market(spark, sf_dir).build(scratch_path(spark, "facts"), ["fact_orders", "fact_order_items", "dim_date"])


def _orders_and_revenue(orders: DataFrame, *by: str) -> DataFrame:
    return orders.groupBy(*by).agg(F.count("*").alias("orders"), F.sum("order_total").cast("decimal(20,2)").alias("revenue"))


@query()
def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and revenue by status over a range of days of the built fact, whose other months are not read."""
    return _orders_and_revenue(_built_facts(spark, sf_dir).between("fact_orders", "1996-11-20", "1997-02-10"), "order_status")


@query()
def dated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and freight by seller state over a range of days of the built item fact."""
    items = _built_facts(spark, sf_dir).between("fact_order_items", "1998-02-01", "1998-02-28")
    return items.groupBy("seller_state").agg(F.count("*").alias("items"), F.sum("freight_value").cast("decimal(20,2)").alias("freight"))


@query()
def holiday_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekend orders of two quarters by quarter, chosen in the calendar."""
    warehouse = _built_facts(spark, sf_dir)
    days = warehouse["dim_date"].filter(c("is_weekend") & c("year_quarter").isin("1996-Q4", "1997-Q4"))
    return _orders_and_revenue(warehouse.on_dates("fact_orders", days.select("date_day", "year_quarter")), "year_quarter")


# ------------------------------------------------------------------------- insights
QUERIES |= {
    "insight_peak_month": _over(insights.peak_month, "agg_revenue_monthly"),
    "insight_review_gap": _over(insights.review_gap, "agg_delivery_review_correlation"),
    "insight_years_in_view": _over(insights.years_in_view, "agg_revenue_monthly", years=(1996, 1998)),
    "insight_quarterly_rollup": _over(insights.quarterly_rollup, "agg_revenue_monthly"),
    "insight_category_concentration": _over(insights.category_concentration, "agg_category_performance"),
    "insight_leading_categories": _over(insights.leading_categories, "agg_category_performance"),
    "insight_leading_sellers": _over(insights.leading_sellers, "agg_seller_performance"),
    "insight_at_risk_sellers": _over(insights.at_risk_sellers, "agg_seller_performance"),
    "insight_customer_totals": _over(
        lambda rfm: insights.customer_totals(published.rfm_segments(rfm)), "agg_customer_rfm"
    ),
    "insight_retention_triangle": _over(insights.retention_triangle, "agg_cohort_retention"),
    "insight_first_month_retention": _over(insights.first_month_retention, "agg_cohort_retention"),
    "insight_monthly_late_rate": _over(insights.monthly_late_rate, "agg_delivery_performance"),
    "insight_region_rollup": _over(insights.region_rollup, "agg_geographic_revenue"),
    "insight_state_spread": _over(insights.state_spread, "agg_geographic_revenue"),
    "insight_north_against_southeast": _over(insights.north_against_southeast, "agg_geographic_revenue"),
}

# --------------------------------------------------------------------------- models
_runs: dict[tuple, ModelRun] = {}


def _model_run(job: Callable[..., ModelRun], *inputs: str):
    """The saved outputs of one job over a folder; a session runs each job once for the same files."""

    def run(spark: SparkSession, sf_dir: str) -> ModelRun:
        key = (job, spark.sparkContext.applicationId, market.fingerprint(spark, sf_dir))
        if key not in _runs:
            warehouse = Warehouse.over_market(spark, sf_dir)
            done = job(*(warehouse[name] for name in inputs))
            done.save(Store(spark, scratch_path(spark, "models")), run_id="catalog")
            _runs[key] = done
        return _runs[key]

    return run


_segmentation = _model_run(segmentation.run, "agg_customer_rfm")
_forecast = _model_run(forecasting.run, "fact_orders")
_sentiment = _model_run(sentiment.run, "stg_order_reviews", "fact_orders")
_baseline = _model_run(sentiment.baseline, "stg_order_reviews", "fact_orders")


def _output(job, table: str, then: Callable[[DataFrame], DataFrame] = lambda frame: frame) -> Query:
    return lambda spark, sf_dir: then(job(spark, sf_dir).tables[table].drop("generated_at"))


QUERIES |= {
    "segment_customers": _output(_segmentation, "customer_segments"),
    "segment_profiles": _output(_segmentation, "segment_profiles"),
    "segment_model_metrics": _output(_segmentation, "segment_model_metrics"),
    "forecast_daily": _output(_forecast, "revenue_forecast_daily"),
    "forecast_monthly": _output(_forecast, "revenue_forecast_monthly"),
    "forecast_model_metrics": _output(_forecast, "forecast_model_metrics"),
    "sentiment_reviews": _output(_sentiment, "review_sentiment"),
    "sentiment_model_metrics": _output(_sentiment, "sentiment_model_metrics"),
    "sentiment_top_terms": _output(_sentiment, "sentiment_top_terms"),
    "serve_forecast": _output(_forecast, "revenue_forecast_daily", published.forecast),
    "serve_sentiment_summary": _output(_sentiment, "review_sentiment", published.sentiment_summary),
    "insight_late_reviews_read_negative": _output(
        _sentiment,
        "review_sentiment",
        lambda frame: insights.late_reviews_read_negative(published.sentiment_summary(frame)),
    ),
    "sentiment_log_odds": _output(_baseline, "log_odds"),
    "sentiment_baseline": _output(_baseline, "review_sentiment"),
    "serve_sentiment_baseline": _output(_baseline, "review_sentiment", published.sentiment_summary),
    "insight_late_reviews_baseline": _output(
        _baseline,
        "review_sentiment",
        lambda frame: insights.late_reviews_read_negative(published.sentiment_summary(frame)),
    ),
    "insight_forecast_horizon": _output(_forecast, "revenue_forecast_daily", insights.forecast_horizon),
    "insight_forecast_improvement": _output(_forecast, "forecast_model_metrics", insights.forecast_improvement),
    "insight_forecast_months": _output(_forecast, "revenue_forecast_monthly", insights.forecast_months),
}

QUERIES |= {
    "forecast_daily_revenue": _over(forecasting.daily_revenue, "fact_orders"),
    "forecast_prepared_series": _over(forecasting.prepared_series, "fact_orders"),
}


def _holdout(fact_orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    series = materialise(forecasting.prepared_series(fact_orders), "series")
    train, test = forecasting.split(series)
    return test, forecasting.seasonal_naive(train, test)


QUERIES["forecast_seasonal_naive"] = _over(lambda fact: _holdout(fact)[1], "fact_orders")
QUERIES["forecast_naive_accuracy"] = _over(
    lambda fact: forecasting.accuracy(_holdout(fact)[1]).select(
        *[F.round(name, 4).alias(name) for name in ("mae", "rmse", "mape", "bias")]
    ),
    "fact_orders",
)


@query()
def segment_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised log features per customer, as columns."""
    from pyspark.ml.functions import vector_to_array

    points = segmentation.features(Warehouse.over_market(spark, sf_dir)["agg_customer_rfm"])
    values = vector_to_array("features")
    return points.select(
        "customer_key", *[F.round(values[i], 5).alias(f"z_{name}") for i, name in enumerate(segmentation.FEATURES)]
    )


@query()
def text_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = text.normalise(c("text"))
    return documents.select("doc_id", F.length(clean).alias("length"), F.md5(clean).alias("digest"))


def _gram_counts(block: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
        # Dealt out once: a file may hold all of its texts in one group of rows.
        documents = texts.repartition("doc_id").select("doc_id", text.normalise(c("text")).alias("clean_text"))
        return ngrams.summed(ngrams.counts(documents, "doc_id", (block,))).select("term", "occurrences", "documents")

    return run


QUERIES["text_word_ngrams"] = _gram_counts("words")
QUERIES["text_char_ngrams"] = _gram_counts("chars")
QUERIES["sentiment_corpus"] = _over(
    lambda reviews, orders: sentiment.weak_labels(sentiment.corpus(reviews, orders))
    .withColumn("digest", F.md5("clean_text"))
    .drop("clean_text"),
    "stg_order_reviews",
    "fact_orders",
)

QUERIES["sentiment_split"] = _over(
    lambda reviews, orders: sentiment.with_holdout(
        sentiment.weak_labels(sentiment.corpus(reviews, orders)).select("order_id", "label")
    ),
    "stg_order_reviews",
    "fact_orders",
)


def _vocabulary(reviews: DataFrame, orders: DataFrame) -> DataFrame:
    texts = materialise(sentiment.dealt(sentiment.weak_labels(sentiment.corpus(reviews, orders)).select("order_id", "label", "clean_text")), "texts")
    training = materialise(sentiment.with_holdout(texts).filter("not held_out"), "training")
    known = sentiment.vocabulary(sentiment.term_rows(training), training.count())
    return known.select("block", "term", "occurrences", "documents", F.round("idf", 6).alias("idf"), "index")


QUERIES["sentiment_vocabulary"] = _over(_vocabulary, "stg_order_reviews", "fact_orders")


# ------------------------------------------------------------------------- streaming
@query()
def stream_upsert_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert the event stream by user: the latest event of each."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    upserts = jobs.UpsertStream(spark, scratch_path(spark, "upsert"), ["user_id"], newest=["ts", "event_id"])
    upserts.run(jobs.parquet_stream(spark, sf_dir, schema, "events.parquet"))
    return upserts.current()


@query()
def stream_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event value per day."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = jobs.parquet_stream(spark, sf_dir, schema, "events.parquet")
    return jobs.run_windowed_revenue(events, scratch_path(spark, "windows"), time="ts", amount="value")


@query()
def monthly_totals_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the monthly mart in full, then refresh its last months in place."""
    fact = Warehouse.over_market(spark, sf_dir)["fact_orders"]
    folder = scratch_path(spark, "months")
    jobs.refresh_monthly_totals(fact, folder)
    return jobs.refresh_monthly_totals(fact, folder, lookback=2)


@query()
def fact_orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lay the order fact out by month, backfill one month, and count rows per partition."""
    fact = Warehouse.over_market(spark, sf_dir)["fact_orders"]
    folder = scratch_path(spark, "fact")
    jobs.write_fact_by_month(fact, folder)
    jobs.write_fact_by_month(fact, folder, month="1997-03")
    return (
        spark.read.parquet(folder)
        .groupBy(c("order_month").cast("string").alias("order_month"))
        .agg(F.count("*").alias("orders"), F.sum("order_total").cast("decimal(20,2)").alias("revenue"))
    )


@query()
def customer_location_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history of where each person lives, from the record taken at each order."""
    warehouse = Warehouse.over_market(spark, sf_dir)
    visits = warehouse["stg_orders"].join(warehouse["stg_customers"], "customer_id")
    return jobs.scd2_history(
        visits, ["customer_unique_id"], ["customer_zip_code_prefix", "customer_state"], "order_purchase_timestamp"
    )
