"""Daily revenue forecast with a backtest against a seasonal-naive baseline.

The fact is read once, into one row per calendar day; everything after works on those rows, so
the windows here are bounded by the calendar however large the fact is.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.functions.rules import c, month_start, revenue_recognised, round_double
from tradewind.ml.common import ModelRun
from tradewind.session import materialise

# Fixed values of the tail trim, the split and the baseline.
TRIM_MIN_DAYS, TRIM_RECENT, TRIM_REACH, TRIM_SHARE = 60, 90, 45, 0.25
MIN_TEST_DAYS, MIN_TRAIN_DAYS, HOLDOUT_MONTH_DAYS = 14, 180, 30
SAME_WEEKDAY_LAST_YEAR, NAIVE_FALLBACK_DAYS = 364, 28

MODEL, BASELINE = "trend_fourier", "seasonal_naive"
INTERVAL = (0.10, 0.90)
WEEKLY_ORDER, MONTHLY_PERIOD, MONTHLY_ORDER = 3, 30.5, 5
CHANGEPOINTS, CHANGEPOINT_RANGE, RIDGE = 12, 0.8, 0.001


def daily_revenue(fact_orders: DataFrame) -> DataFrame:
    return (
        fact_orders.filter(revenue_recognised())
        .groupBy(c("order_purchase_date").alias("ds"))
        .agg(F.sum("order_total").cast("double").alias("y"), F.count("*").alias("order_count"))
    )


def trim_tail(daily: DataFrame, share: float = TRIM_SHARE) -> DataFrame:
    """Drop the trailing days, at most 45, whose volume fell below a quarter of the recent median."""
    age = F.row_number().over(Window.orderBy(c("ds").desc()))
    aged = daily.withColumn("_age", age)
    days = daily.agg(F.count("*")).scalar()
    typical = aged.filter(c("_age") <= TRIM_RECENT).agg(F.median("order_count")).scalar()
    healthy = aged.filter((c("_age") <= TRIM_REACH) & (c("order_count") >= typical * share))
    newest_healthy = F.coalesce(healthy.agg(F.min("_age")).scalar(), F.lit(TRIM_REACH + 1))
    return aged.filter((days < TRIM_MIN_DAYS) | (c("_age") >= newest_healthy)).drop("_age")


def densify(daily: DataFrame) -> DataFrame:
    """A row for every day between the first and the last; days without orders count zero."""
    spine = daily.agg(F.min("ds").alias("low"), F.max("ds").alias("high")).select(
        F.explode(F.sequence("low", "high")).alias("ds")
    )
    return spine.join(daily, "ds", "left").select(
        "ds",
        F.coalesce("y", F.lit(0.0)).alias("y"),
        F.coalesce("order_count", F.lit(0).cast("long")).alias("order_count"),
    )


def split(daily: DataFrame, holdout_months: int = 3) -> tuple[DataFrame, DataFrame]:
    """Train and test days; the last ``holdout_months`` times 30 days are the test."""
    cut = F.date_sub(daily.agg(F.max("ds")).scalar(), holdout_months * HOLDOUT_MONTH_DAYS)
    return daily.filter(c("ds") <= cut), daily.filter(c("ds") > cut)


def seasonal_naive(history: DataFrame, horizon: DataFrame) -> DataFrame:
    """``horizon`` with ``predicted``: the value 364 days earlier, else the last 28-day mean."""
    age = F.row_number().over(Window.orderBy(c("ds").desc()))
    recent = history.withColumn("_age", age).filter(c("_age") <= NAIVE_FALLBACK_DAYS)
    earlier = history.select(F.date_add("ds", SAME_WEEKDAY_LAST_YEAR).alias("ds"), c("y").alias("_then"))
    return (
        horizon.join(earlier, "ds", "left")
        .withColumn("predicted", F.coalesce("_then", recent.agg(F.avg("y")).scalar()))
        .drop("_then")
    )


def accuracy(scored: DataFrame, actual: str = "y", predicted: str = "predicted") -> DataFrame:
    """One row: mae, rmse, mape over non-zero actuals (NaN when there are none), bias."""
    error = c(predicted) - c(actual)
    relative = F.when(c(actual) != 0, F.abs(error / F.nullif(c(actual), F.lit(0.0))))
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(F.avg(relative) * 100, F.lit(math.nan)).alias("mape"),
        F.avg(error).alias("bias"),
    )


@dataclass(frozen=True)
class Calendar:
    """Turns dates into regressors: hinged trend, weekly and monthly waves."""

    first: dt.date
    days: int

    def _position(self) -> Column:
        return F.datediff(c("ds"), F.lit(self.first)).cast("double")

    def trend(self) -> dict[str, Column]:
        t = self._position() / float(self.days)
        knots = [CHANGEPOINT_RANGE * (i + 1) / CHANGEPOINTS for i in range(CHANGEPOINTS)]
        hinges = {f"hinge_{i}": F.greatest(t - knot, F.lit(0.0)) for i, knot in enumerate(knots)}
        return {"slope": t, **hinges}

    def waves(self, name: str, period: float, order: int) -> dict[str, Column]:
        angle = self._position() * (2 * math.pi / period)
        pairs = {}
        for n in range(1, order + 1):
            pairs[f"{name}_sin_{n}"] = F.sin(angle * n)
            pairs[f"{name}_cos_{n}"] = F.cos(angle * n)
        return pairs

    def weekly(self) -> dict[str, Column]:
        return self.waves("weekly", 7.0, WEEKLY_ORDER)

    def columns(self) -> dict[str, Column]:
        return {**self.trend(), **self.weekly(), **self.waves("monthly", MONTHLY_PERIOD, MONTHLY_ORDER)}


@dataclass(frozen=True)
class TrendModel:
    """Log-linear revenue model: effects multiply, and the interval follows the residuals."""

    calendar: Calendar
    fitted: LinearRegressionModel
    low: float
    high: float

    def _effect(self, parts: dict[str, Column]) -> Column:
        weights = dict(zip(self.calendar.columns(), self.fitted.coefficients.toArray()))
        return sum((column * float(weights[name]) for name, column in parts.items()), F.lit(0.0))

    def predict(self, dates: DataFrame) -> DataFrame:
        regressors = self.calendar.columns()
        level = self._effect(regressors) + self.fitted.intercept
        return dates.select(
            "*",
            F.expm1(level).alias("forecast_revenue"),
            F.expm1(level + min(self.low, 0.0)).alias("forecast_lower"),
            F.expm1(level + max(self.high, 0.0)).alias("forecast_upper"),
            F.expm1(self._effect(self.calendar.trend()) + self.fitted.intercept).alias("trend"),
            F.expm1(self._effect(self.calendar.weekly())).alias("weekly"),
        )


def fit(history: DataFrame) -> TrendModel:
    edge = history.agg(F.min("ds"), F.max("ds")).first()
    calendar = Calendar(edge[0], max((edge[1] - edge[0]).days, 1))
    regressors = calendar.columns()
    table = VectorAssembler(inputCols=list(regressors), outputCol="features").transform(
        history.withColumns(regressors).withColumn("label", F.log1p("y"))
    )
    fitted = LinearRegression(regParam=RIDGE, elasticNetParam=0.0, solver="normal").fit(table)
    residual = fitted.transform(table).select((c("label") - c("prediction")).alias("residual"))
    low, high = residual.agg(F.percentile("residual", F.array(*map(F.lit, INTERVAL)))).first()[0]
    return TrendModel(calendar, fitted, float(low), float(high))


def daily_forecast(model: TrendModel, history: DataFrame, horizon_days: int) -> DataFrame:
    """Every day of history and horizon; days ahead have no actual revenue."""
    dates = history.agg(F.min("ds").alias("low"), F.max("ds").alias("high")).select(
        F.explode(F.sequence("low", F.date_add("high", horizon_days))).alias("ds")
    )
    actual = history.select("ds", c("y").alias("actual_revenue"))
    money = {
        name: round_double(F.greatest(c(name), F.lit(0.0)), 2).cast("double")
        for name in ("forecast_revenue", "forecast_lower", "forecast_upper")
    }
    return (
        model.predict(dates)
        .join(actual, "ds", "left")
        .withColumns(money)
        .withColumn("is_forecast", c("actual_revenue").isNull())
    )


def monthly_forecast(daily: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return round_double(F.coalesce(F.sum(name), F.lit(0.0)), 2).cast("double").alias(name)

    return (
        daily.groupBy(month_start("ds").alias("month_start_date"))
        .agg(
            total("forecast_revenue"),
            total("forecast_lower"),
            total("forecast_upper"),
            total("actual_revenue"),
            F.count("ds").alias("days_in_month"),
            F.count_if("is_forecast").alias("forecast_days"),
        )
        .withColumn("is_forecast_month", c("forecast_days") > 0)
    )


def prepared_series(fact_orders: DataFrame) -> DataFrame:
    """The trimmed, gapless daily series. The per-day totals are written before the trim reads them."""
    return densify(trim_tail(materialise(daily_revenue(fact_orders), "daily")))


def backtest(daily: DataFrame, holdout_months: int = 3) -> list[tuple]:
    """(model, holdout days, mae, rmse, mape, bias) of model and baseline; empty if history is short."""
    train, test = split(daily, holdout_months)
    test_days, train_days = test.count(), train.count()
    if test_days < MIN_TEST_DAYS or train_days < MIN_TRAIN_DAYS:
        return []
    predicted = fit(train).predict(test).withColumnRenamed("forecast_revenue", "predicted")
    return [
        (name, test_days, *accuracy(scored).first())
        for name, scored in ((MODEL, predicted), (BASELINE, seasonal_naive(train, test)))
    ]


METRICS_SCHEMA = "model string, holdout_days long, mae double, rmse double, mape double, bias double"


def run(fact_orders: DataFrame, horizon_days: int = 90, holdout_months: int = 3) -> ModelRun:
    spark = fact_orders.sparkSession
    daily = materialise(prepared_series(fact_orders), "series")
    history_days = daily.count()
    if history_days == 0:
        raise RuntimeError("the order fact is empty, build the star schema first")
    evaluation = backtest(daily, holdout_months)
    forecast = materialise(daily_forecast(fit(daily), daily, horizon_days), "forecast")
    tables = {"revenue_forecast_daily": forecast, "revenue_forecast_monthly": monthly_forecast(forecast)}
    if evaluation:
        tables["forecast_model_metrics"] = spark.createDataFrame(evaluation, METRICS_SCHEMA)
    total = forecast.filter("is_forecast").agg(F.sum("forecast_revenue")).first()[0]
    return ModelRun(
        tables,
        {
            "history_days": history_days,
            "horizon_days": horizon_days,
            "forecast_total": round(total or 0.0, 2),
            "best_model": min(evaluation, key=lambda row: row[3])[0] if evaluation else None,
            "evaluation": evaluation,
        },
    )
