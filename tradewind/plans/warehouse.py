"""The model graph: names, inputs and layers, and building them into tables."""

from __future__ import annotations

import inspect
from collections import Counter
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.plans import analytics, core, orders, staging
from tradewind.session import bound_tasks, split_crowded_keys
from tradewind.sources import market
from tradewind.tables import BY_NAME

LAYERS: dict[str, tuple[Callable[..., DataFrame], ...]] = {
    "staging": (
        staging.stg_customers,
        staging.stg_geolocation,
        staging.stg_order_items,
        staging.stg_order_payments,
        staging.stg_order_reviews,
        staging.stg_orders,
        staging.stg_product_category_translation,
        staging.stg_products,
        staging.stg_sellers,
    ),
    "intermediate": (orders.int_order_financials, orders.int_order_payments_summary),
    "marts": (
        core.dim_customers,
        core.dim_date,
        core.dim_geography,
        core.dim_products,
        core.dim_sellers,
        core.fact_orders,
        core.fact_order_items,
    ),
    "analytics": (
        analytics.agg_kpi_summary,
        analytics.agg_revenue_monthly,
        analytics.agg_category_performance,
        analytics.agg_seller_performance,
        analytics.agg_delivery_performance,
        analytics.agg_delivery_review_correlation,
        analytics.agg_customer_rfm,
        analytics.agg_cohort_retention,
        analytics.agg_geographic_revenue,
    ),
}
MODELS = {model.__name__: model for models in LAYERS.values() for model in models}
LAYER_OF = {model.__name__: layer for layer, models in LAYERS.items() for model in models}
FACTS = ("fact_orders", "fact_order_items")
MONTH_PARTITION = "order_month"
BUILD_THREADS = 4


def inputs_of(name: str) -> list[str]:
    """Names of the frames a model takes: its parameters without defaults."""
    parameters = inspect.signature(MODELS[name]).parameters.values()
    return [p.name for p in parameters if p.default is inspect.Parameter.empty]


class Warehouse:
    """Models by name, lazily, over nine source frames.

    Nothing runs until a frame is used. ``build`` writes models as tables; a warehouse opened on
    that folder then reads those tables instead of deriving them again.
    """

    def __init__(self, spark: SparkSession, source: Callable[[str], DataFrame], tables: str | None = None):
        split_crowded_keys(spark)
        bound_tasks(spark)
        self.spark = spark
        self.tables = tables
        self._source = source
        self._frames: dict[str, DataFrame] = {}
        self._built: set[str] = set()
        self._by_month = True

    @classmethod
    def over_market(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        return cls(spark, lambda name: market.read(spark, sf_dir, name))

    @classmethod
    def over_raw_zone(cls, spark: SparkSession, raw_zone) -> Warehouse:
        return cls(spark, raw_zone.read)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in self._built:
                frame = self.spark.read.parquet(self.path(name))
                self._frames[name] = frame.drop(MONTH_PARTITION) if name in FACTS else frame
            elif name in BY_NAME:
                self._frames[name] = self._source(name)
            elif name in MODELS:
                self._frames[name] = MODELS[name](*(self[i] for i in inputs_of(name)))
            else:
                raise KeyError(f"Unknown model '{name}'. Known models: {', '.join(sorted(MODELS))}")
        return self._frames[name]

    def between(self, name: str, first: str, last: str) -> DataFrame:
        """Rows of a fact dated ``first`` to ``last`` (both included). Of a built fact only the months that the range
        touches are read."""
        day, months = F.col("order_purchase_date"), (first[:7], last[:7])
        frame = self._with_month(name).filter(F.col(MONTH_PARTITION).between(*map(F.lit, months)))
        return frame.filter(day.between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).drop(MONTH_PARTITION)

    def on_dates(self, name: str, dates: DataFrame) -> DataFrame:
        """Rows of a fact on the days of ``dates``, a choice of ``dim_date``, with its columns beside them.

        The join is on day and month, so that the months of the chosen days prune a built fact while the query runs."""
        fact = self._with_month(name)
        chosen = dates.withColumns({"_day": F.col("date_day"), "_month": F.date_format("date_day", "yyyy-MM")})
        same = (fact[MONTH_PARTITION] == chosen["_month"]) & (fact["order_purchase_date"] == chosen["_day"])
        return fact.join(chosen, same).drop("_day", "_month", MONTH_PARTITION)

    def _with_month(self, name: str) -> DataFrame:
        if name not in FACTS:
            raise KeyError(f"'{name}' is no fact, only {', '.join(FACTS)} are laid out by month")
        if name in self._built and self._by_month:  # partition names are read as text, whatever they look like
            kinds = self.spark.read.parquet(self.path(name)).drop(MONTH_PARTITION).schema
            return self.spark.read.schema(kinds.add(MONTH_PARTITION, "string")).parquet(self.path(name))
        return self[name].withColumn(MONTH_PARTITION, F.date_format("order_purchase_date", "yyyy-MM"))

    def path(self, name: str) -> str:
        if not self.tables:
            raise ValueError("this warehouse has no table folder")
        return f"{self.tables.rstrip('/')}/{LAYER_OF[name]}/{name}"

    def build(self, tables: str, names: Iterable[str] | None = None, by_month: bool = True) -> Warehouse:
        """Write models as tables (the star schema by default), in dependency order, independent
        ones side by side. A model outside ``names`` that several of them are derived from is
        written first, so that its joins and shuffles run once.

        Facts are laid out by order month. The rebalance hint lets adaptive execution split a
        crowded month over several files and merge thin ones. That moves every row of them once more: without
        ``by_month`` they lie as they come, for readers of whole tables.
        """
        chosen = set(names) if names is not None else {m.__name__ for m in LAYERS["marts"]}
        built = Warehouse(self.spark, self._source, tables)
        built._by_month = by_month
        needed = chosen.union(*(built._upstream(name) for name in chosen))
        uses = Counter(i for name in needed for i in inputs_of(name))
        chosen |= {name for name in needed if uses[name] > 1}
        waiting = [name for name in MODELS if name in chosen]
        with ThreadPoolExecutor(BUILD_THREADS) as pool:
            while waiting:
                ready = [n for n in waiting if not built._upstream(n).intersection(waiting)]
                frames = [(name, built[name]) for name in ready]
                for _ in pool.map(lambda item: built._write(*item), frames):
                    pass
                built.use_built(ready)
                waiting = [n for n in waiting if n not in ready]
        return built

    def _upstream(self, name: str) -> set[str]:
        direct = {i for i in inputs_of(name) if i in MODELS}
        return direct.union(*(self._upstream(i) for i in direct))

    def _write(self, name: str, frame: DataFrame) -> None:
        if name in FACTS and self._by_month:
            month = F.date_format("order_purchase_date", "yyyy-MM").alias(MONTH_PARTITION)
            frame = frame.select("*", month).hint("rebalance", MONTH_PARTITION)
            writer = frame.write.partitionBy(MONTH_PARTITION)
        else:
            writer = frame.write
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(name))

    def use_built(self, names: Iterable[str]) -> Warehouse:
        """Declare tables that an earlier build left in the folder."""
        self._built.update(names)
        self._frames.clear()
        return self
