"""Customer clusters on the RFM aggregate.

All numbers of clusters and all random starts are fitted together: a round is one aggregation over the
points, keyed by model and cluster, and models that have settled leave the round. A round sends out the
centres, a few per model; a task returns a row per model and cluster.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from tradewind.functions.rules import c, decimal, percent, quotient
from tradewind.ml.common import ModelRun
from tradewind.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of it

FEATURES = ("recency_days", "frequency", "monetary", "avg_order_value")
REPEAT_THRESHOLD = 1.5
# Random starts for each number of clusters, and rounds at most in one fit.
STARTS = 10
MAX_ITERATIONS = 300
# A model has settled when no centre moves further than this. A start is chosen from so many points.
TOLERANCE = 1e-4
POOL = 2000
BLOCK = 4096  # points at a time in a task

# Names of the thirds of the recency and the value ordering.
RECENCY_TIERS = ("Active", "Cooling", "Dormant")
VALUE_TIERS = ("High-Value", "Mid-Value", "Low-Value")


def features(agg_customer_rfm: DataFrame) -> DataFrame:
    """The customers with a standardised ``features`` vector of log values, and the same as array ``x``, written once."""
    logs = {f"_{name}": F.log1p(F.greatest(c(name).cast("double"), F.lit(0.0))) for name in FEATURES}
    assembled = VectorAssembler(inputCols=list(logs), outputCol="_raw").transform(
        agg_customer_rfm.withColumns(logs)
    )
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    scaled = scaler.fit(assembled).transform(assembled)
    return materialise(scaled.drop("_raw", *logs).withColumn("x", vector_to_array("features")), "features")


@dataclass(frozen=True)
class Candidate:
    k: int
    inertia: float
    silhouette: float
    davies_bouldin: float
    calinski_harabasz: float
    centers: np.ndarray


def seeded(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the points as first centres, each new one likelier the further it is from those chosen."""
    chosen = [points[rng.integers(len(points))]]
    while len(chosen) < k:
        gaps = ((points[:, None, :] - np.stack(chosen)[None, :, :]) ** 2).sum(axis=2).min(axis=1)
        total = gaps.sum()
        at = rng.choice(len(points), p=gaps / total) if total > 0 else rng.integers(len(points))
        chosen.append(points[at])
    return np.stack(chosen)


def pool_of(points: DataFrame, key: str, size: int = POOL) -> np.ndarray:
    """About ``size`` points chosen by a hash of their key, in its order."""
    rows = points.count()
    hashed = F.pmod(F.xxhash64(key), F.lit(1 << 32))
    chosen = points.filter(hashed < F.lit(float(1 << 32)) * min(1.0, size / max(rows, 1))).select(hashed.alias("h"), F.col(key).cast("string").alias("k"), "x")
    found = sorted(chosen.collect()) or sorted(points.select(hashed.alias("h"), F.col(key).cast("string").alias("k"), "x").limit(1).collect())
    return np.array([r["x"] for r in found])


def nearest(centers: np.ndarray, value: str = "x") -> Column:
    """The place of the nearest centre, the first of equals."""

    def to(center) -> Column:
        gaps = [F.get(value, F.lit(d)) - F.lit(float(v)) for d, v in enumerate(center)]
        return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])

    gaps = F.array(*[to(center) for center in centers])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


SUMS = "model int, cluster int, n long, q double, within double, radius double, sums array<double>"


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    """The points, some at a time, as a row per dimension."""
    for batch in batches:
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        for start in range(0, len(values), BLOCK):
            yield np.ascontiguousarray(values[start : start + BLOCK].T)


def _dealt(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One for the centre, a row each, that is nearest to a point, the first of equals, and the squared distance. A matrix
    product serves all centres and points: distances up to the point's own square."""
    gaps = -2 * centers @ x + (centers * centers).sum(axis=1)[:, None]
    mine = gaps == gaps.min(axis=0)
    if np.count_nonzero(mine) != x.shape[1]:
        mine = np.arange(len(centers))[:, None] == gaps.argmin(axis=0)
    mine = mine.astype(np.float64)
    return mine, ((x - centers.T @ mine) ** 2).sum(axis=0)


def sums_of(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, dict[int, Row]]:
    """One pass for all models: of each (model, cluster) the number ``n``, coordinate ``sums`` and sum of squares ``q`` of its
    points, their squared distances ``within`` and distances ``radius`` in all.

    Every task adds up its own points and hands on a row per model and cluster."""
    dims = len(next(iter(models.values()))[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {m: np.zeros((len(centers), 4 + dims)) for m, centers in models.items()}
        for x in _blocks(batches, dims):
            squares = (x * x).sum(axis=0)
            facts = np.stack([np.ones_like(squares), squares, squares, squares, *x])
            for m, centers in models.items():
                mine, facts[2] = _dealt(x, centers)
                np.sqrt(facts[2], out=facts[3])
                held[m] += mine @ facts.T
        rows = [(m, k, *row) for m, table in held.items() for k, row in enumerate(table) if row[0]]
        names = ("model", "cluster", "n", "q", "within", "radius")
        out = {name: [row[i] for row in rows] for i, name in enumerate(names)} | {"sums": [list(row[len(names) :]) for row in rows]}
        out["n"] = [int(n) for n in out["n"]]
        yield pa.RecordBatch.from_pydict(out, pa.schema([("model", pa.int32()), ("cluster", pa.int32()), ("n", pa.int64()), *[(c, pa.float64()) for c in names[3:]], ("sums", pa.list_(pa.float64()))]))

    parts = points.select("x").mapInArrow(add, SUMS)
    coordinates = F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(dims)]).alias("sums")
    rows = parts.groupBy("model", "cluster").agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in ("q", "within", "radius")], coordinates)
    found: dict[int, dict[int, Row]] = {m: {} for m in models}
    for row in rows.collect():  # a row per model and cluster
        found[row["model"]][row["cluster"]] = row
    return found


def fit_all(points: DataFrame, models: dict[int, np.ndarray], rounds: int = MAX_ITERATIONS) -> dict[int, tuple[float, np.ndarray]]:
    """Lloyd's rounds over all models at once: cost and centres of each. ``points`` has ``x`` and is a written table."""
    moving, settled = dict(models), {}
    for _ in range(rounds + 1):
        told = sums_of(points, moving)
        for number, before in list(moving.items()):
            centers = before.copy()
            for k, row in told[number].items():
                centers[k] = np.array(row["sums"]) / row["n"]
            cost = sum(row["within"] for row in told[number].values())
            if np.sqrt(((centers - before) ** 2).sum(axis=1)).max() <= TOLERANCE:
                settled[number] = (cost, moving.pop(number))
            else:
                moving[number] = centers
        if not moving:
            break
    return settled | {m: (cost, x) for m, x in moving.items() for cost in [sum(r["within"] for r in sums_of(points, {m: x})[m].values())]}


def silhouettes(points: DataFrame, models: dict[int, np.ndarray], told: dict[int, dict[int, Row]]) -> dict[int, float]:
    """Mean silhouette of each model by squared distances over all points.

    With n, s and q the number, sum and sum of squares of a cluster's points, the mean squared distance of x to
    it is |x|^2 - 2 x.s/n + q/n, so a point needs the few rows of the pass before and no other point."""
    dims = len(next(iter(models.values()))[0])
    facts = {m: {k: (row["n"], row["q"], np.array(row["sums"])) for k, row in clusters.items()} for m, clusters in told.items()}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = dict.fromkeys(models, 0.0)
        for x in _blocks(batches, dims):
            squares = (x * x).sum(axis=0)
            for m, centers in models.items():
                used = sorted(facts[m])
                n, q, s = (np.array([facts[m][k][i] for k in used]) for i in range(3))
                all_of = np.maximum(squares[:, None] * n + q - 2 * x.T @ s.T, 0.0)  # squared distances to all of each cluster
                own = np.searchsorted(used, _dealt(x, centers)[0].argmax(axis=0))
                at = np.arange(len(own))
                within = all_of[at, own] / np.maximum(n[own] - 1, 1)
                means = all_of / n
                means[at, own] = np.inf
                other = means.min(axis=1) if len(used) > 1 else np.zeros(len(x))
                larger = np.maximum(within, other)
                usable = (n[own] > 1) & (larger > 0)
                totals[m] += float(((other - within)[usable] / larger[usable]).sum())
        yield pa.RecordBatch.from_pydict({"model": pa.array(totals, pa.int32()), "s": pa.array(totals.values(), pa.float64())})

    rows = points.select("x").mapInArrow(add, "model int, s double").groupBy("model").agg(F.sum("s").alias("s")).collect()
    return {r["model"]: r["s"] / sum(n for n, _, _ in facts[r["model"]].values()) for r in rows}


def figures(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, tuple[float, float, float, float]]:
    """Inertia, silhouette, Davies-Bouldin and Calinski-Harabasz of several models in two passes."""
    told = sums_of(points, models)
    averages = silhouettes(points, models, told)
    apart = lambda a, b: float(np.sqrt(((a - b) ** 2).sum()))
    found = {}
    for m, centers in models.items():
        size = {k: row["n"] for k, row in told[m].items()}
        radius = {k: row["radius"] / row["n"] for k, row in told[m].items()}
        total, k = sum(size.values()), len(size)
        worst = [max((radius[i] + radius[j]) / (apart(centers[i], centers[j]) or float("inf")) for j in size if j != i) for i in size] if k > 1 else [0.0]
        middle = sum(n * centers[i] for i, n in size.items()) / total
        between = sum(n * apart(centers[i], middle) ** 2 for i, n in size.items())
        within = sum(row["within"] for row in told[m].values())
        spread = between / (k - 1) / (within / (total - k)) if within and k > 1 else float("inf")
        found[m] = (within, averages[m], sum(worst) / k, spread)
    return found


def sweep(points: DataFrame, k_range: range, seed: int, starts: int, key: str = "customer_key") -> list[Candidate]:
    """The lowest-cost start of each number of clusters, with its figures."""
    pool = pool_of(points, key)
    named = [(k, start) for k in k_range for start in range(starts)]
    models = {i: seeded(pool, k, np.random.default_rng((seed, k, start))) for i, (k, start) in enumerate(named)}
    fitted = fit_all(points, models)
    best = {k: min((i for i, (own, _) in enumerate(named) if own == k), key=lambda i: (fitted[i][0], i)) for k in k_range}
    told = figures(points, {i: fitted[i][1] for i in best.values()})
    return [Candidate(k, *map(float, told[i]), fitted[i][1]) for k, i in best.items()]


def sweep_table(spark: SparkSession, candidates: list[Candidate]) -> DataFrame:
    chosen = chosen_k(candidates)
    rows = [
        (r.k, r.inertia, r.silhouette, r.davies_bouldin, r.calinski_harabasz, r.k == chosen) for r in candidates
    ]
    return spark.createDataFrame(
        rows,
        "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double, selected boolean",
    )


def chosen_k(candidates: list[Candidate]) -> int:
    return max(candidates, key=lambda r: (r.silhouette, -r.k)).k


def profile(assigned: DataFrame) -> DataFrame:
    """Size, averages and revenue of each cluster, rounded to cents."""

    def avg(name: str):
        return decimal(F.avg(c(name).cast("double")), 20, 2).alias(name if name.startswith("avg") else f"avg_{name}")

    return assigned.groupBy("cluster_id").agg(
        F.count("*").alias("customer_count"),
        avg("recency_days"),
        avg("frequency"),
        avg("monetary"),
        avg("avg_order_value"),
        avg("avg_review_score"),
        decimal(F.sum("monetary"), 20, 2).alias("total_revenue"),
    )


def label_clusters(profiles: DataFrame) -> DataFrame:
    """Name clusters by where their averages stand among the others.

    Names follow the averages, not the ids, which change between runs. A name already taken by a
    lower id gets its place in the recency order.
    """
    count = F.count("*").over(Window.partitionBy())
    recency_place = F.row_number().over(Window.orderBy("avg_recency_days", "cluster_id")) - 1
    value_place = F.row_number().over(Window.orderBy(c("avg_monetary").desc(), "cluster_id")) - 1

    def tier(place, names):
        return (
            F.when(place * 3 < c("_count"), F.lit(names[0]))
            .when(place * 3 < c("_count") * 2, F.lit(names[1]))
            .otherwise(F.lit(names[2]))
        )

    placed = profiles.withColumns({"_count": count, "_recency": recency_place, "_value": value_place})
    repeaters = F.when(c("avg_frequency") >= REPEAT_THRESHOLD, F.lit("Repeaters"))
    named = placed.withColumn(
        "_name",
        F.concat_ws(" ", tier(c("_recency"), RECENCY_TIERS), tier(c("_value"), VALUE_TIERS), repeaters),
    )
    taken = F.row_number().over(Window.partitionBy("_name").orderBy("cluster_id")) > 1
    rank = (c("_recency") + 1).cast("string")
    return named.withColumn(
        "cluster_label",
        F.when(taken, F.concat(c("_name"), F.lit(" (recency rank "), rank, F.lit(")"))).otherwise(c("_name")),
    ).drop("_count", "_recency", "_value", "_name")


def run(agg_customer_rfm: DataFrame, k_min: int = 3, k_max: int = 8, seed: int = 42, starts: int = STARTS) -> ModelRun:
    """Choose k by silhouette, cluster, profile and name the clusters."""
    spark = agg_customer_rfm.sparkSession
    points = features(agg_customer_rfm)
    customers = points.count()
    if customers == 0:
        raise RuntimeError("the RFM aggregate is empty, build the analytics layer first")
    candidates = sweep(points, range(k_min, k_max + 1), seed, starts)
    best = next(r for r in candidates if r.k == chosen_k(candidates))
    placed = points.withColumn("cluster_id", nearest(best.centers)).drop("features", "x")
    assigned = materialise(placed, "assigned")
    profiles = materialise(label_clusters(profile(assigned)), "profiles")
    everything = Window.partitionBy()
    shares = profiles.select(
        "*",
        percent(c("total_revenue"), F.sum("total_revenue").over(everything)).alias("revenue_share_pct"),
        quotient(c("customer_count") * 100, F.sum("customer_count").over(everything), 2).alias("customer_share_pct"),
        F.lit(best.k).alias("selected_k"),
    )
    labels = F.broadcast(profiles.select("cluster_id", "cluster_label"))  # one row per cluster
    segments = assigned.join(labels, "cluster_id").select(
        "customer_key",
        "customer_state",
        "acquisition_cohort_month",
        "recency_days",
        "frequency",
        "monetary",
        "avg_order_value",
        "rfm_score",
        "rfm_segment",
        "cluster_id",
        "cluster_label",
    )
    return ModelRun(
        {
            "customer_segments": segments,
            "segment_profiles": shares,
            "segment_model_metrics": sweep_table(spark, candidates),
        },
        {"customers_scored": customers, "selected_k": best.k, "silhouette": best.silhouette},
    )
