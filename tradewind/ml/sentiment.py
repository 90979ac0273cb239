"""Review text sentiment, trained on star ratings as weak labels.

A fitted model is a table: one row per term with its block, inverse document frequency and weight,
and one row for the intercept. Scoring joins counted terms with it and sums, so nothing of the
training session is needed, and SQL over the same table gives the same scores.
"""

from __future__ import annotations

import logging
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tradewind.functions import text
from tradewind.functions.rules import c
from tradewind.ml import ngrams
from tradewind.ml.common import ModelRun
from tradewind.operators.global_order import first_in_group
from tradewind.session import SCRATCH_CODEC, materialise, remove, scratch_path, wide_rows

log = logging.getLogger(__name__)

MIN_TRAINING_ROWS = 500
SUSPICIOUS_AUC = 0.995
MAX_FEATURES, MIN_DOCUMENTS = 40_000, 3
INVERSE_PENALTY = 4.0
MAX_ITERATIONS = 2_000
POSITIVE_FROM, NEGATIVE_TO = 0.6, 0.4
SEED, TEST_SHARE = 42, 0.2
INTERCEPT = "intercept"
TASKS_A_CORE = 4  # of the fit: each sends a gradient, as long as there are features, in every iteration
VECTOR_GROUP = 16 << 20  # a reader of vectors holds a whole group of rows


def corpus(stg_order_reviews: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Reviews with usable text and the order figures they are read against."""
    # Exploded from an array of one, so that each text is folded once: a filter on a plain column would fold it again.
    comments = stg_order_reviews.filter(c("review_comment_message").isNotNull()).select(
        "order_id",
        "review_score",
        "review_creation_date",
        F.explode(F.array(text.normalise(c("review_comment_message")))).alias("clean_text"),
    )
    outcomes = fact_orders.select(
        "order_id", "customer_state", "is_late_delivery", "delivery_days", "order_total"
    )
    return comments.filter(F.length("clean_text") >= 3).join(outcomes, "order_id")


def dealt(reviews: DataFrame) -> DataFrame:
    """As many parts as shuffles have: Spark would choose them by the size of the compressed text, too few to count in."""
    return reviews.repartition(int(reviews.sparkSession.conf.get("spark.sql.shuffle.partitions")), "order_id")


def weak_labels(reviews: DataFrame) -> DataFrame:
    """Three stars are ambiguous and left out; four and more are positive."""
    return reviews.filter(c("review_score") != 3).withColumn(
        "label", (c("review_score") >= 4).cast("double")
    )


def with_holdout(labelled: DataFrame, key: str = "order_id", seed: int = SEED, share: float = TEST_SHARE) -> DataFrame:
    """Add ``held_out``: of each label exactly round(share * rows), those with the smallest hash of the (unique) key."""
    keys = materialise(labelled.select("label", key, F.md5(F.concat_ws(":", c(key), F.lit(seed))).alias("_hash")), "split_keys")
    wanted = {r["label"]: math.floor(share * r["count"] + 0.5) for r in keys.groupBy("label").count().collect()}
    chosen = first_in_group(keys, "label", ["_hash", key], wanted).select(key, F.lit(True).alias("held_out"))
    return labelled.join(materialise(chosen, "holdout"), key, "left").withColumn("held_out", F.coalesce("held_out", F.lit(False)))


def term_rows(reviews: DataFrame, blocks: tuple[str, ...] = tuple(ngrams.BLOCKS), key: str = "order_id") -> DataFrame:
    """Parts of the ``occurrences`` and ``documents`` of each ``block`` and ``term`` of the reviews, and with labels of
    the ``positive`` ones: terms are counted where the texts lie, and only sums over many reviews move."""
    return ngrams.counts(reviews, key, blocks)


def vocabulary(terms: DataFrame, reviews: int) -> DataFrame:
    """The terms of each block that stand in three reviews or more, the 40,000 commonest at most, with their
    smoothed inverse document frequency and place ``index`` among all features."""
    order = Window.partitionBy("block").orderBy(c("occurrences").desc(), "term")
    known = ngrams.summed(terms).filter(c("documents") >= MIN_DOCUMENTS)
    placed = known.withColumn("place", F.row_number().over(order))
    offset = F.element_at(F.create_map(*[F.lit(x) for i, b in enumerate(ngrams.BLOCKS) for x in (b, i * MAX_FEATURES)]), c("block"))
    idf = F.log(F.lit(1.0 + reviews) / (1.0 + c("documents"))) + 1.0
    return placed.filter(c("place") <= MAX_FEATURES).select(
        "block", "term", "occurrences", "documents", idf.alias("idf"), (offset + c("place") - 1).alias("index")
    )


def features(reviews: DataFrame, words: DataFrame, key: str = "order_id") -> DataFrame:
    """``reviews`` without text but with ``features``: (1 + ln n) * idf of each term, each block scaled to length one.

    ``words`` is a vocabulary, so it has a bounded number of rows; ``key`` is unique."""
    return ngrams.vectors(reviews, words, MAX_FEATURES, len(ngrams.BLOCKS) * MAX_FEATURES)


def fit_weights(training: DataFrame) -> tuple[DataFrame, float]:
    """``index`` and ``weight`` of each feature, and the intercept: logistic regression with balanced classes; the
    penalty matches an inverse strength of 4. ``training`` has ``label`` and ``features``."""
    spark = training.sparkSession
    path = scratch_path(spark, "training")
    vectors = training.select("label", "features").write.option("compression", SCRATCH_CODEC)
    vectors.option("parquet.block.size", VECTOR_GROUP).parquet(path)
    stored = T.StructType().add("label", T.DoubleType()).add("features", VectorUDT())
    written = spark.read.schema(stored).parquet(path)
    counts = {row["label"]: row["count"] for row in written.groupBy("label").count().collect()}
    rows = sum(counts.values())
    balanced = F.when(c("label") == 1.0, rows / (2.0 * counts.get(1.0, rows))).otherwise(
        rows / (2.0 * counts.get(0.0, rows))
    )
    with wide_rows(spark):
        fitted = LogisticRegression(
            weightCol="weight",
            regParam=1.0 / (INVERSE_PENALTY * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=MAX_ITERATIONS,
        ).fit(written.withColumn("weight", balanced).coalesce(TASKS_A_CORE * spark.sparkContext.defaultParallelism))
    remove(spark, path)
    weights = [(i, w) for i, w in enumerate(fitted.coefficients.toArray().tolist()) if w]
    return spark.createDataFrame(weights, "index int, weight double"), float(fitted.intercept)


def model_table(words: DataFrame, weights: DataFrame, intercept: float) -> DataFrame:
    """The model: ``block``, ``term``, ``index``, ``idf`` and ``weight``; the intercept is a block of its own."""
    spark = words.sparkSession
    terms = words.join(weights, "index").select("block", "term", "index", "idf", "weight")
    return terms.union(spark.createDataFrame([(INTERCEPT, "", -1, 0.0, intercept)], terms.schema))


def score(featured: DataFrame, model: DataFrame, key: str = "order_id") -> DataFrame:
    """``featured`` without features but with ``margin`` and ``sentiment_probability``: the weights, bounded by the
    vocabulary, go to every task, which sums where the vectors lie."""
    rows = model.select("block", "index", "weight").collect()
    weights = {r["index"]: r["weight"] for r in rows if r["block"] != INTERCEPT}
    start = next(r["weight"] for r in rows if r["block"] == INTERCEPT)
    sums = ngrams.products(featured, weights, len(ngrams.BLOCKS) * MAX_FEATURES, "_sum")
    scored = sums.withColumn("margin", c("_sum") + F.lit(start))
    return scored.withColumn("sentiment_probability", 1.0 / (1.0 + F.exp(-c("margin")))).drop("_sum")


# ----------------------------------------------------------- a baseline without training
def log_odds(terms: DataFrame, labelled: DataFrame) -> DataFrame:
    """A model table from counts alone: of each word of the vocabulary how much likelier a positive review holds it.

    ``terms`` are the rows of the training reviews with labels, ``labelled`` their labels. Weights are rounded, so that sums are exact."""
    sizes = labelled.agg(F.count_if(c("label") == 1.0).alias("p"), F.count_if(c("label") == 0.0).alias("n")).first()
    order = Window.partitionBy("block").orderBy(c("occurrences").desc(), "term")
    held = ngrams.summed(terms).filter(c("documents") >= MIN_DOCUMENTS).withColumn("place", F.row_number().over(order))
    share = lambda hits, total: (hits + 1) / F.lit(float(total + 2))
    odds = F.log(share(c("positive"), sizes["p"])) - F.log(share(c("documents") - c("positive"), sizes["n"]))
    rows = held.filter(c("place") <= MAX_FEATURES).select("block", "term", "documents", "positive", exact(odds).alias("weight"))
    prior = math.log((sizes["p"] + 1) / (sizes["n"] + 1))
    last = terms.sparkSession.createDataFrame([(INTERCEPT, "", sizes["p"] + sizes["n"], sizes["p"], prior)], "block string, term string, documents long, positive long, weight double")
    return rows.union(last.withColumn("weight", exact(c("weight"))))


def exact(value: Column) -> Column:
    return F.round(value, 6).cast("decimal(12,6)")


def score_presence(reviews: DataFrame, model: DataFrame) -> DataFrame:
    """``reviews`` without text but with ``sentiment_probability`` from the weights of the terms that each holds.

    Weights have six places and are summed as integers, so sums are exact."""
    units = {(r["block"], r["term"]): int(r["weight"].scaleb(6)) for r in model.select("block", "term", "weight").collect()}
    weights = {term: units[block, term] for block, term in units if block == "words"}
    start = F.lit(units[INTERCEPT, ""])
    margin = (c("_sum") + start).cast("double") / F.lit(1_000_000.0)
    scored = ngrams.summed_weights(reviews, weights, "_sum").withColumn("margin", F.greatest(F.lit(-30.0), F.least(F.lit(30.0), margin)))
    return scored.withColumn("sentiment_probability", 1.0 / (1.0 + F.exp(-c("margin")))).drop("_sum")


def baseline(stg_order_reviews: DataFrame, fact_orders: DataFrame) -> ModelRun:
    """The outputs of the log-odds baseline: word weights and the verdict on each review."""
    reviews = materialise(dealt(corpus(stg_order_reviews, fact_orders)), "corpus")
    labelled = with_holdout(weak_labels(reviews).select("order_id", "label"))
    # Each training row is a document, also where an order comes twice.
    training = materialise(labelled.filter(~c("held_out")).withColumn("_row", F.monotonically_increasing_id()), "training_keys")
    texts = reviews.select("order_id", "clean_text").join(training.select("order_id", "label", "_row"), "order_id")
    model = materialise(log_odds(term_rows(texts, ("words",), "_row"), training), "log_odds")
    return ModelRun({"log_odds": model, "review_sentiment": sentiments(score_presence(reviews, model))})


def quality(scored: DataFrame) -> dict[str, float]:
    """Accuracy, precision, recall, F1 and ROC AUC of the sign of ``margin`` against ``label``."""
    hit, truth = c("margin") > 0, c("label") == 1.0
    row = scored.agg(
        F.count("*").alias("n"),
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
    ).first()
    tp, fp, fn, n = row["tp"], row["fp"], row["fn"], row["n"]
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    auc = BinaryClassificationEvaluator(rawPredictionCol="margin", numBins=0).evaluate(scored)
    return {
        "accuracy": (n - fp - fn) / n if n else 0.0,
        "precision": precision,
        "recall": recall,
        "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0,
        "roc_auc": auc,
    }


def sentiments(scored: DataFrame) -> DataFrame:
    """Text verdict and star verdict of each review. Probabilities are rounded before the cut."""
    probability, stars = F.round("sentiment_probability", 4), c("review_score")
    return (
        scored.withColumn("sentiment_probability", probability)
        .withColumn(
            "predicted_sentiment",
            F.when(c("sentiment_probability") >= POSITIVE_FROM, F.lit("positive"))
            .when(c("sentiment_probability") <= NEGATIVE_TO, F.lit("negative"))
            .otherwise(F.lit("neutral")),
        )
        .withColumn(
            "rating_sentiment",
            F.when(stars >= 4, F.lit("positive")).when(stars <= 2, F.lit("negative")).otherwise(F.lit("neutral")),
        )
        .select(
            "order_id",
            "review_score",
            "review_creation_date",
            "customer_state",
            "is_late_delivery",
            "delivery_days",
            "order_total",
            "sentiment_probability",
            "predicted_sentiment",
            "rating_sentiment",
            (c("predicted_sentiment") == c("rating_sentiment")).alias("agrees_with_rating"),
        )
    )


def top_terms(coefficients: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` most negative and the ``n`` most positive of (term, coefficient)."""
    lowest = coefficients.orderBy("coefficient", "term").limit(n)
    highest = coefficients.orderBy(c("coefficient").desc(), "term").limit(n)
    return lowest.withColumn("direction", F.lit("negative")).unionByName(
        highest.withColumn("direction", F.lit("positive"))
    )


def word_coefficients(model: DataFrame) -> DataFrame:
    """(term, coefficient) of the word block, at most 40,000 rows."""
    return model.filter(c("block") == "words").select("term", F.round("weight", 4).alias("coefficient"))


def run(
    stg_order_reviews: DataFrame,
    fact_orders: DataFrame,
    seed: int = SEED,
    test_size: float = TEST_SHARE,
    min_rows: int = MIN_TRAINING_ROWS,
) -> ModelRun:
    spark = fact_orders.sparkSession
    reviews = materialise(dealt(corpus(stg_order_reviews, fact_orders)), "corpus")
    size = weak_labels(reviews).agg(F.count("*"), F.avg("label")).first()
    if size[0] < min_rows:
        raise RuntimeError(f"only {size[0]} labelled reviews, training needs at least {min_rows}")
    labelled = with_holdout(weak_labels(reviews).select("order_id", "label"), seed=seed, share=test_size)
    labelled = materialise(labelled, "labels")
    training = labelled.filter(~c("held_out"))
    training_rows = training.count()
    texts = reviews.select("order_id", "clean_text").join(training, "order_id")
    words = materialise(vocabulary(term_rows(texts.drop("label")), training_rows), "vocabulary")
    # Vectors hold several times their texts: each is made where it is used, and none is dealt out or kept.
    weights, intercept = fit_weights(features(texts, words))
    model = materialise(model_table(words, weights, intercept), "model")
    scored = materialise(score(features(reviews, words), model), "scored")
    figures = quality(scored.join(labelled.filter("held_out"), "order_id"))
    if figures["roc_auc"] >= SUSPICIOUS_AUC:
        log.warning("ROC AUC of %.4f is implausible for free text, check for leakage", figures["roc_auc"])
    output = sentiments(scored)
    metrics = spark.createDataFrame(
        [
            (
                "tfidf_logreg",
                training_rows,
                size[0] - training_rows,
                round(size[1], 4),
                *[round(figures[k], 4) for k in ("accuracy", "precision", "recall", "f1", "roc_auc")],
            )
        ],
        "model string, training_rows long, holdout_rows long, positive_rate double, accuracy double, "
        "precision double, recall double, f1 double, roc_auc double",
    )
    return ModelRun(
        {
            "review_sentiment": output,
            "sentiment_model_metrics": metrics,
            "sentiment_top_terms": top_terms(word_coefficients(model)),
            "sentiment_model_terms": model,
        },
        {"reviews_scored": output.count(), **{k: round(v, 4) for k, v in figures.items()}},
    )
