from __future__ import annotations

import datetime as dt
import math
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradewind.functions import text
from tradewind.ml import forecasting, ngrams, segmentation, sentiment


# ------------------------------------------------------------------------------ text
def grams_by_hand(word_text: str, low=3, high=5):
    out = []
    for word in word_text.split():
        padded = f" {word} "
        for n in range(low, high + 1):
            out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return sorted(out)


def test_ngrams(spark):
    sample = "a bom produto"
    row = (
        spark.createDataFrame([(sample,)], "t string")
        .select(text.word_ngrams(F.col("t")), text.char_ngrams(F.col("t")))
        .first()
    )
    assert row[0] == ["bom", "produto", "bom produto"]
    assert sorted(row[1]) == grams_by_hand(sample)
    empty = spark.createDataFrame([("",)], "t string").select(text.word_ngrams(F.col("t")), text.char_ngrams(F.col("t")))
    assert empty.first()[0] == [] and empty.first()[1] == []


# ---------------------------------------------------------------------------- clusters
def labels(spark, rows):
    frame = spark.createDataFrame(
        [(i, float(r), float(f), float(m)) for i, (r, f, m) in enumerate(rows)],
        "cluster_id int, avg_recency_days double, avg_frequency double, avg_monetary double",
    )
    return {r.cluster_id: r.cluster_label for r in segmentation.label_clusters(frame).collect()}


def test_each_cluster_has_a_name_of_its_own(spark):
    alike = [(50 + i % 2, 1.1, 100 + i) for i in range(7)]
    assert len(set(labels(spark, alike).values())) == len(alike)


def test_thirds_of_recency_and_value(spark):
    named = labels(spark, [(300, 1.2, 80), (90, 1.0, 500), (5, 1.4, 210)])
    assert named == {0: "Dormant Low-Value", 1: "Cooling High-Value", 2: "Active Mid-Value"}


@pytest.mark.parametrize(("orders", "repeats"), [(1.0, False), (1.49, False), (1.5, True), (6.0, True)])
def test_repeaters_from_the_threshold_on(spark, orders, repeats):
    named = labels(spark, [(30, orders, 120), (60, 1.0, 60)])
    assert named[0].endswith("Repeaters") == repeats


def test_names_follow_the_averages_in_any_order(spark):
    rows = [(12, 2.0, 75), (140, 1.0, 600), (33, 1.1, 20), (260, 4.0, 310)]
    turned = rows[2:] + rows[:2]
    first, second = labels(spark, rows), labels(spark, turned)
    assert [first[i] for i in range(4)] == [second[(i + 2) % 4] for i in range(4)]


def lloyd(points, centers, rounds=300):
    """Plain rounds of one model: cost and centres."""
    for _ in range(rounds):
        gaps = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        own = gaps.argmin(axis=1)
        moved = np.array([points[own == k].mean(axis=0) if (own == k).any() else centers[k] for k in range(len(centers))])
        if np.sqrt(((moved - centers) ** 2).sum(axis=1)).max() <= segmentation.TOLERANCE:
            break
        centers = moved
    return ((points[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum(), centers


def blobs(spark, n=900):
    rng = np.random.default_rng(3)
    middles = np.array([[0, 0], [6, 0], [0, 7], [8, 8], [3, 3]])
    points = middles[rng.integers(5, size=n)] + rng.normal(size=(n, 2))
    frame = spark.createDataFrame([(f"c{i}", p.tolist()) for i, p in enumerate(points)], "customer_key string, x array<double>")
    return points, frame.repartition(5).cache()


def test_all_models_in_one_pass_equal_separate_fits(spark):
    points, frame = blobs(spark)
    rng = np.random.default_rng(1)
    starts = {i: segmentation.seeded(points, k, rng) for i, k in enumerate((2, 3, 3, 5, 6))}
    together = segmentation.fit_all(frame, starts)
    for i, first in starts.items():
        cost, centers = lloyd(points, first)
        assert together[i][0] == pytest.approx(cost) and np.allclose(together[i][1], centers)


def test_a_round_holds_no_distance_per_point_centre_and_dimension():
    """Equal centres go to the first, distances are exact, and one block of points needs little time with many centres."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(4096, 4))
    centers = np.vstack([rng.normal(size=(6, 4)), points[:1], points[:1]])
    points[7] = points[0]
    mine, least = segmentation._dealt(np.ascontiguousarray(points.T), centers)
    gaps = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
    assert mine.argmax(axis=0).tolist() == gaps.argmin(axis=1).tolist()
    assert mine.sum(axis=0).tolist() == [1] * len(points) and least.tolist() == gaps.min(axis=1).tolist()
    assert least[0] == least[7] == 0 and mine[7].sum() == 0


def test_sweep_takes_the_best_start_and_any_layout_gives_the_same(spark):
    points, frame = blobs(spark)
    found = segmentation.sweep(frame, range(3, 7), 42, 4)
    assert segmentation.chosen_k(found) == 5
    again = segmentation.sweep(frame.repartition(3), range(3, 7), 42, 4)
    assert [r.inertia for r in found] == pytest.approx([r.inertia for r in again])
    for r in found:
        assert r.inertia == pytest.approx(lloyd(points, r.centers, 1)[0])


def test_figures_against_brute_force(spark):
    points, frame = blobs(spark, 200)
    for centers in (lloyd(points, points[:4])[1], np.vstack([lloyd(points, points[:3])[1], [[90.0, 90.0]]]), np.vstack([points[:1], [[4.0, 4.0]]])):
        inertia, silhouette, davies_bouldin, calinski_harabasz = segmentation.figures(frame, {7: centers})[7]
        gaps = ((points[:, None] - centers[None]) ** 2).sum(axis=2)
        own = gaps.argmin(axis=1)
        used = sorted(set(own.tolist()))
        pairs = ((points[:, None] - points[None]) ** 2).sum(axis=2)
        values = []
        for i in range(len(points)):
            same = (own == own[i]).sum()
            a = pairs[i][own == own[i]].sum() / (same - 1) if same > 1 else 0
            b = min(pairs[i][own == k].mean() for k in used if k != own[i])
            values.append((b - a) / max(a, b) if same > 1 else 0)
        radius = {k: np.sqrt(gaps[own == k, k]).mean() for k in used}
        worst = [max((radius[i] + radius[j]) / math.dist(centers[i], centers[j]) for j in used if j != i) for i in used]
        middle = sum((own == k).sum() * centers[k] for k in used) / len(points)
        between = sum((own == k).sum() * math.dist(centers[k], middle) ** 2 for k in used)
        within = gaps.min(axis=1).sum()
        assert inertia == pytest.approx(within) and silhouette == pytest.approx(np.mean(values))
        assert davies_bouldin == pytest.approx(sum(worst) / len(used))
        assert calinski_harabasz == pytest.approx(between / (len(used) - 1) / (within / (len(points) - len(used))))


def test_segmentation_run(warehouse):
    run = segmentation.run(warehouse["agg_customer_rfm"], k_max=4, starts=1)
    customers = run.tables["customer_segments"]
    assert customers.count() == warehouse["agg_customer_rfm"].count() == run.summary["customers_scored"]
    assert customers.filter("cluster_label is null").count() == 0
    profiles = run.tables["segment_profiles"].collect()
    assert len(profiles) == run.summary["selected_k"]
    assert float(sum(p.customer_share_pct for p in profiles)) == pytest.approx(100, abs=0.1)
    sweep = run.tables["segment_model_metrics"].collect()
    assert [r.k for r in sweep] == [3, 4] and sum(r.selected for r in sweep) == 1


# ---------------------------------------------------------------------------- forecast
def series(spark, counts, value=1000.0):
    start = dt.date(2018, 1, 1)
    rows = [(start + dt.timedelta(days=i), value, n) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "ds date, y double, order_count long")


@pytest.mark.parametrize(
    ("counts", "kept"),
    [
        ([80] * 200 + [19] * 9, 200),  # under a quarter of what is usual
        ([80] * 200 + [20] * 9, 209),
        ([30, 60] * 70, 140),
        ([80] * 30 + [2] * 7, 37),  # too short a series to judge
        ([80] * 150 + [2] * 45, 150),
        ([80] * 150 + [2] * 46, 196),  # longer than any tail
        ([80] * 150 + [2, 70, 2, 2], 152),
    ],
)
def test_tail_trim(spark, counts, kept):
    assert forecasting.trim_tail(series(spark, counts)).count() == kept


def test_densify(spark):
    frame = series(spark, [5, 5, 5]).filter("ds <> date '2018-01-02'")
    rows = forecasting.densify(frame).orderBy("ds").collect()
    assert [(r.y, r.order_count) for r in rows] == [(1000.0, 5), (0.0, 0), (1000.0, 5)]


def accuracy(spark, pairs):
    return forecasting.accuracy(spark.createDataFrame(pairs, "y double, predicted double")).first()


def test_accuracy(spark):
    row = accuracy(spark, [(40.0, 50.0), (80.0, 72.0), (0.0, 3.0)])
    assert row.mae == pytest.approx(7.0) and row.bias == pytest.approx(5 / 3)
    assert row.rmse == pytest.approx(math.sqrt((100 + 64 + 9) / 3))
    assert row.mape == pytest.approx((25 + 10) / 2), "a day without sales has no percentage"
    exact = accuracy(spark, [(3.5, 3.5), (8.0, 8.0)])
    assert (exact.mae, exact.rmse, exact.mape, exact.bias) == (0, 0, 0, 0)
    assert math.isnan(accuracy(spark, [(0.0, 4.0)]).mape)


def test_seasonal_naive(spark):
    history = series(spark, [1] * 400).withColumn("y", F.dayofyear("ds").cast("double"))
    last = dt.date(2018, 1, 1) + dt.timedelta(days=399)
    ahead = spark.createDataFrame([(last + dt.timedelta(days=1),), (last + dt.timedelta(days=900),)], "ds date")
    rows = [r.predicted for r in forecasting.seasonal_naive(history, ahead).orderBy("ds").collect()]
    matched = last + dt.timedelta(days=1 - 364)
    recent = [(last - dt.timedelta(days=i)).timetuple().tm_yday for i in range(28)]
    assert rows == [float(matched.timetuple().tm_yday), pytest.approx(sum(recent) / 28)]


def test_model_learns_a_weekly_pattern(spark):
    start = dt.date(2018, 1, 1)
    rows = [(start + dt.timedelta(days=i), 1000.0 * (2.0 if i % 7 in (5, 6) else 1.0), 10) for i in range(400)]
    history = spark.createDataFrame(rows, "ds date, y double, order_count long")
    evaluation = {row[0]: row for row in forecasting.backtest(history)}
    assert evaluation["trend_fourier"][4] < 8, "mape stays small on a regular series"
    assert forecasting.backtest(history.limit(100)) == []


def test_forecast_run(warehouse):
    run = forecasting.run(warehouse["fact_orders"], horizon_days=30)
    daily = run.tables["revenue_forecast_daily"]
    assert daily.filter("is_forecast").count() == 30
    outside = "forecast_lower > forecast_revenue or forecast_upper < forecast_revenue or forecast_lower < 0"
    assert daily.filter(outside).count() == 0
    monthly = run.tables["revenue_forecast_monthly"]
    assert monthly.filter("is_forecast_month <> (forecast_days > 0)").count() == 0
    assert monthly.agg(F.sum("days_in_month")).first()[0] == daily.count()


# --------------------------------------------------------------------------- sentiment
def reviews(spark, n=400):
    good, bad = ["otimo", "adorei", "perfeito", "rapido"], ["ruim", "atrasado", "quebrado", "pessimo"]
    filler = ["produto", "loja", "compra", "entrega", "caixa"]
    rows = []
    for i in range(n):
        score = (1, 2, 3, 4, 5)[i % 5]
        pool = good if score >= 4 else bad if score <= 2 else filler
        words = [pool[(i // 5) % len(pool)], filler[i % 5], filler[(i * 3) % 5]]
        if i % 17 == 0:
            words[0] = (bad if score >= 4 else good)[i % 4]
        rows.append((f"o{i}", score, " ".join(words) + f" {i}!"))
    return spark.createDataFrame(rows, "order_id string, review_score int, review_comment_message string").withColumn(
        "review_creation_date", F.lit(dt.datetime(2018, 1, 1)).cast("timestamp_ntz")
    )


def orders_of(corpus):
    return corpus.select(
        "order_id",
        F.lit("SP").alias("customer_state"),
        (F.col("review_score") <= 2).alias("is_late_delivery"),
        F.lit(5).alias("delivery_days"),
        F.lit(10).cast("decimal(12,2)").alias("order_total"),
    )


def observe_something(spark):
    """After this the session holds an observation manager, which cannot travel to executors."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3


def test_sentiment_run_after_an_observation(spark):
    observe_something(spark)
    corpus = reviews(spark)
    orders = orders_of(corpus)
    with pytest.raises(RuntimeError, match="at least 500"):
        sentiment.run(corpus, orders)
    run = sentiment.run(corpus, orders, min_rows=100)
    assert run.summary["reviews_scored"] == 400 and run.summary["roc_auc"] > 0.7
    scored = run.tables["review_sentiment"]
    assert scored.filter("sentiment_probability not between 0 and 1").count() == 0
    wrong = "predicted_sentiment = 'positive' and sentiment_probability < 0.6"
    assert scored.filter(wrong).count() == 0
    terms = run.tables["sentiment_top_terms"].collect()
    positive = {r.term for r in terms if r.direction == "positive"}
    negative = {r.term for r in terms if r.direction == "negative"}
    assert "otimo" in positive and "ruim" in negative
    assert run.tables["sentiment_model_metrics"].first()["holdout_rows"] == 64  # a fifth of 160 rows of each label


def test_scores_equal_sql_over_the_model_table(spark, tmp_path):
    """The saved model and plain SQL in another engine give every review the probability of the run."""
    corpus = reviews(spark)
    run = sentiment.run(corpus, orders_of(corpus), min_rows=100)
    run.tables["sentiment_model_terms"].write.parquet(str(tmp_path / "model"))
    corpus.write.parquet(str(tmp_path / "reviews"))
    run.tables["review_sentiment"].write.parquet(str(tmp_path / "scored"))
    rows = duckdb.sql(f"""
        with r as (select order_id, trim(regexp_replace(lower(review_comment_message), '[^a-z]+', ' ', 'g')) as t from '{tmp_path}/reviews/*.parquet'),
        w as (select order_id, list_filter(string_split(t, ' '), lambda x: length(x) >= 2) as ws, string_split(t, ' ') as every from r),
        words as (select order_id, 'words' as block, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as term from w),
        padded as (select order_id, ' ' || unnest(every) || ' ' as p from w),
        chars as (select order_id, 'chars' as block, substring(p, i::int, n) as term from padded cross join (values (3), (4), (5)) as v(n)
                  cross join lateral (select unnest(range(1, length(p) - n + 2)) as i)),
        counted as (select order_id, block, term, count(*) as n from (from words union all from chars) group by all),
        valued as (select order_id, block, (1 + ln(n)) * idf as value, weight from counted join '{tmp_path}/model/*.parquet' using (block, term)),
        blocks as (select order_id, sum(value * weight) / sqrt(sum(value * value)) as part from valued group by order_id, block),
        margins as (select order_id, coalesce(sum(part), 0) + (select weight from '{tmp_path}/model/*.parquet' where block = 'intercept') as m from r left join blocks using (order_id) group by order_id)
        select count(*), max(abs(1 / (1 + exp(-m)) - sentiment_probability)) from margins join '{tmp_path}/scored/*.parquet' using (order_id)""").fetchall()[0]
    assert rows[0] == 400 and rows[1] < 0.000051


def test_tfidf_weights_against_brute_force(spark):
    rows = [("aa bb aa",), ("aa cc",), ("aa bb",), ("bb cc cc",), ("cc aa",)]
    frame = spark.createDataFrame([(f"o{i}", t, t) for i, (t,) in enumerate(rows)], "order_id string, clean_text string, kept string")
    known = sentiment.vocabulary(sentiment.term_rows(frame), len(rows)).cache()
    place = {r["term"]: r["index"] for r in known.filter("block = 'words'").collect()}
    assert set(place) == {"aa", "bb", "cc"}
    for row in sentiment.features(frame, known).collect():
        held = dict(zip(row.features["indices"], row.features["values"], strict=True))
        tokens = row.kept.split()
        raw = {}
        for term in set(tokens):
            df = sum(term in other[0].split() for other in rows)
            raw[term] = (1 + math.log(tokens.count(term))) * (math.log((1 + len(rows)) / (1 + df)) + 1)
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for term, weight in raw.items():
            assert held[place[term]] == pytest.approx(weight / norm)


def test_reviews_without_known_terms_get_the_intercept(spark):
    frame = spark.createDataFrame([("a", "zz"), ("b", "")], "order_id string, clean_text string")
    known = spark.createDataFrame([("words", "aa", 3, 3, 1.0, 0)], "block string, term string, occurrences long, documents long, idf double, index int")
    weights = spark.createDataFrame([(0, 2.0)], "index int, weight double")
    model = sentiment.model_table(known, weights, -1.0)
    scored = sentiment.score(sentiment.features(frame, known), model).collect()
    assert {r["sentiment_probability"] for r in scored} == {1 / (1 + math.exp(1.0))}


def test_the_fit_reads_few_vectors_at_once(spark, monkeypatch):
    frame = spark.createDataFrame([(1.0, "good ware"), (0.0, "bad ware"), (0.0, "bad bad ware")], "label double, clean_text string")
    known = spark.createDataFrame([("words", "bad", 0, 1.5), ("words", "ware", 1, 1.0)], "block string, term string, index int, idf double")
    setting, seen = "spark.sql.parquet.columnarReaderBatchSize", {}

    class Fit:
        def __init__(self, **options):
            seen.update(options)

        def fit(self, training):
            seen["held"] = int(spark.conf.get(setting))
            seen["rows"] = sorted((r.label, r.features.numNonzeros(), r.weight) for r in training.collect())
            return SimpleNamespace(coefficients=DenseVector([0.5, 0.0]), intercept=0.25)

    monkeypatch.setattr(sentiment, "LogisticRegression", Fit)
    weights, intercept = sentiment.fit_weights(sentiment.features(frame, known, "label"))
    assert seen["held"] <= 64 < int(spark.conf.get(setting))
    assert seen["rows"] == [(0.0, 2, 0.75), (0.0, 2, 0.75), (1.0, 1, 1.5)] and seen["regParam"] == 1 / 12
    assert [tuple(r) for r in weights.collect()] == [(0, 0.5)] and intercept == 0.25


def test_vectors_are_neither_kept_nor_dealt_out(spark, monkeypatch):
    kept, plans, keep, fit = [], [], sentiment.materialise, sentiment.fit_weights

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(sentiment, "materialise", lambda df, name: kept.extend(df.columns) or keep(df, name))
    monkeypatch.setattr(sentiment, "fit_weights", lambda training: plans.append(plan(training)) or fit(training))
    corpus = reviews(spark)
    sentiment.run(corpus, orders_of(corpus), min_rows=100)
    assert "clean_text" in kept and "features" not in kept
    above, _, below = plans[0].partition("MapInArrow")
    assert "Join" in below and "Join" not in above and "Exchange" not in above


def test_holdout_is_exact_for_each_label(spark):
    frame = spark.range(20_003).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 4 == 0).cast("double").alias("label"))
    split = sentiment.with_holdout(frame)
    rows = {r["label"]: (r["n"], r["held"]) for r in split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("held_out").alias("held")).collect()}
    assert rows == {0.0: (15_002, 3000), 1.0: (5001, 1000)}
    again = sentiment.with_holdout(frame.repartition(5))
    assert split.filter("held_out").select("order_id").exceptAll(again.filter("held_out").select("order_id")).count() == 0


def test_sums_equal_counted_columns(spark):
    """Counts of Arrow batches against the listed n-grams, with repeated and missing keys, short words and no text."""
    rows = [(1, "a bom produto bom"), (1, "bom dia"), (2, "bom"), (None, "dia a"), (None, "dia"), (3, ""), (4, None), (5, "xx  yy")]
    frame = spark.createDataFrame([(k, t, float(i % 2)) for i, (k, t) in enumerate(rows)], "doc_id int, clean_text string, label double").repartition(3)
    for block, grams in ngrams.BLOCKS.items():
        each = frame.select("doc_id", F.col("label") == 1.0, F.explode(grams(F.col("clean_text"))).alias("term")).collect()
        found = {r["term"]: (r["occurrences"], r["documents"]) for r in ngrams.summed(ngrams.counts(frame, "doc_id", (block,))).collect()}
        assert found == {t: (sum(r[2] == t for r in each), len({r[0] for r in each if r[2] == t})) for t in {r[2] for r in each}}
    alone = frame.filter("doc_id in (2, 3, 4, 5)")
    words = ngrams.summed(ngrams.counts(alone, "doc_id")).filter("block = 'words'").collect()
    assert {r["term"]: (r["documents"], r["positive"]) for r in words} == {"bom": (1, 0), "xx": (1, 1), "yy": (1, 1), "xx yy": (1, 1)}


def test_no_row_per_text_and_term(spark):
    """Terms of a text are counted where it lies; each text is folded once."""
    frame = spark.createDataFrame([(i, "bom dia") for i in range(50)], "order_id int, clean_text string").coalesce(1)
    assert sentiment.term_rows(frame, ("words",)).count() == 3
    corpus = reviews(spark, 10)
    plan = sentiment.corpus(corpus, orders_of(corpus)).withColumn("digest", F.md5("clean_text"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1


def test_baseline_counts_each_training_row(spark):
    """An order that comes twice is two documents, as in the SQL."""
    corpus = reviews(spark, 60)
    orders = orders_of(corpus)
    once = sentiment.baseline(corpus, orders).tables["log_odds"].filter("block = 'intercept'").first()
    twice = sentiment.baseline(corpus, orders.union(orders)).tables["log_odds"]
    assert twice.filter("block = 'intercept'").first()["documents"] == 2 * once["documents"]
    assert twice.filter("block = 'words'").agg(F.min("documents")).first()[0] >= 4
