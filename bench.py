"""Time the star-schema build, the nine aggregates over it, the flagship query end to end, and
checks, streams and models from the test tables.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tradewind import Warehouse, get_spark
from tradewind.catalog import QUERIES
from tradewind.plans.warehouse import LAYERS
from tradewind.session import scratch_path


# Each starts from the test tables; the models train.
JOBS = ("quality_marts", "stream_upsert_users", "stream_daily_revenue", "segment_customers", "forecast_daily", "sentiment_reviews")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", master=f"local[{cpus}]")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    lazy = Warehouse.over_market(spark, sf_dir)
    seconds["end_to_end_agg_revenue_monthly"] = timed(lambda: drain(lazy["agg_revenue_monthly"]))
    built: list[Warehouse] = []
    seconds["build_star_schema"] = timed(lambda: built.append(lazy.build(scratch_path(spark, "star"))))
    for model in LAYERS["analytics"]:
        name = model.__name__
        seconds[name] = timed(lambda name=name: drain(built[0][name]))
    for name in JOBS:
        seconds[name] = timed(lambda name=name: drain(QUERIES[name](spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "star schema build, nine aggregates, one end-to-end aggregate, checks, streams and models",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
