from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewind.plans import insights, published
from tradewind.plans.warehouse import LAYERS
from tradewind.sources.store import Store, export_snapshot, load_dataset


def test_registry():
    names = [d.name for d in published.DATASETS]
    assert len(names) == len(set(names)) == 17
    assert all("." in d.relation for d in published.DATASETS)
    assert sum(d.required for d in published.DATASETS) == 9
    assert not published.dataset_named("forecast_daily").required
    with pytest.raises(KeyError, match="Unknown dataset"):
        published.dataset_named("nope")


def test_no_customer_or_item_rows_are_published():
    for dataset in published.DATASETS:
        assert dataset.relation not in ("ml.customer_segments", "marts.fact_order_items")
        if dataset.relation in ("analytics.agg_customer_rfm", "ml.review_sentiment"):
            assert dataset.query is not None


@pytest.fixture(scope="module")
def store(spark, warehouse, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    for model in LAYERS["analytics"]:
        store.write(warehouse[model.__name__], f"analytics.{model.__name__}")
    return store


def test_snapshot_and_fallback(spark, store, tmp_path):
    snapshot = str(tmp_path / "snapshot")
    written = export_snapshot(store, snapshot, strict=True)
    assert set(written) == {d.name for d in published.DATASETS if d.required}
    manifest = spark.read.json(f"{snapshot}/manifest").first()
    assert manifest.generated_at and "ml.segment_profiles" in manifest.skipped
    empty = Store(spark, str(tmp_path / "empty"))
    assert load_dataset(empty, snapshot, "kpi_summary").count() == 1
    assert load_dataset(empty, snapshot, "forecast_daily") is None
    assert load_dataset(store, snapshot, "rfm_segments").columns[0] == "rfm_segment"
    with pytest.raises(RuntimeError, match="does not exist"):
        export_snapshot(empty, str(tmp_path / "none"), strict=True)
    assert export_snapshot(empty, str(tmp_path / "none")) == {}


def test_relations(store):
    assert store.exists("analytics.agg_kpi_summary") and not store.exists("ml.review_sentiment")
    with pytest.raises(LookupError, match="not available"):
        store.read("ml.review_sentiment")


def test_model_output_is_stamped_and_replaced(spark, store):
    for run in ("first", "second"):
        store.write_model_output(spark.range(2), "sample", run)
    rows = store.read("ml.sample").collect()
    assert len(rows) == 2 and {r.run_id for r in rows} == {"second"} and all(r.generated_at for r in rows)


def test_customer_lookup_before_and_after_clusters(spark, warehouse):
    rfm = warehouse["agg_customer_rfm"]
    key = rfm.agg(F.min("customer_key")).first()[0]
    assert published.customer_segment(rfm, key).first().cluster_label is None
    clusters = spark.createDataFrame([(key, "Active")], "customer_key string, cluster_label string")
    assert published.customer_segment(rfm, key, clusters).first().cluster_label == "Active"
    assert published.customer_segment(rfm, "nobody").count() == 0


def test_limits(warehouse):
    assert published.categories(warehouse["agg_category_performance"], 3).count() == 3
    for bad in (0, 501):
        with pytest.raises(ValueError, match="limit"):
            published.sellers(warehouse["agg_seller_performance"], bad)


def test_improvement_over_the_baseline(spark):
    metrics = spark.createDataFrame(
        [("trend_fourier", 50.0, 14.0), ("seasonal_naive", 100.0, 30.0)], "model string, rmse double, mape double"
    )
    row = insights.forecast_improvement(metrics).first()
    assert row.best_model == "trend_fourier" and row.rmse_improvement_pct == 50.0 and row.holdout_mape == 14.0


def test_late_reviews(spark):
    summary = spark.createDataFrame(
        [("negative", True, 3), ("positive", True, 1), ("negative", None, 9)],
        "predicted_sentiment string, is_late_delivery boolean, review_count long",
    )
    row = insights.late_reviews_read_negative(summary).first()
    assert (row.late_reviews, row.late_negative_reviews, float(row.late_negative_pct)) == (4, 3, 75.0)
