"""Quality scores by compression: held-out accuracy, the contract's columns and odd inputs."""

import zlib

import numpy as np
import pytest

from tradewind.llm import compression_quality as quality
from tradewind.llm.queries import op13_compression_quality


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in op13_compression_quality(spark, sf_dir).collect()}
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()}
    assert set(found) == docs
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) and r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for i, r in found.items())
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(found[i]["score"], y) for i, y in truth.items() if i in found and found[i]["held_out"]]
    score, y = np.array([s for s, _ in held]), np.array([y for _, y in held])
    assert ((score >= 0.5) == y).mean() > 0.97
    assert (score[y == 1] >= 0.5).mean() > 0.99  # good texts are left alone
    for low, high in ((0.0, 0.2), (0.8, 1.0)):  # shares follow scores
        inside = (score >= low) & (score <= high)
        assert abs(y[inside].mean() - score[inside].mean()) < 0.05


GOOD = "the river runs slowly past the old mill and the fields beyond it lie quiet in the evening light number {} of them all"
BAD = "$$$ WIN!! CLICK {} HERE!! *** FREE *** %%% BUY NOW!! %%% $$$"


def tables(spark, n=40):
    rows = [(i, (GOOD if i % 2 else BAD).format(i * 7919), "clash", 0) for i in range(n)]
    rows += [(None, None, None, 1), (900, None, "x", 1), (901, "", "x", 1), (902, GOOD.format(1) * 20_000, "x", 1), (903, BAD.format(1), "y", 1), (903, BAD.format(1), "y", 1)]
    labels = [(i, i % 2, "l") for i in range(n)] + [(None, 1, "l"), (900, None, "l"), (5, 0, "l")]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, half int"), spark.createDataFrame(labels, "doc_id long, quality int, label string")


def test_small_tables(spark):
    df, labels = tables(spark)
    found = quality.score_texts(df.repartition(3), labels).collect()
    assert len(found) == df.count()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[902]["predicted"] == 1 and by_id[903]["predicted"] == 0
    assert by_id[900]["score"] == by_id[901]["score"] == by_id[None]["score"]
    again = {r["doc_id"]: r["score"] for r in quality.score_texts(df.repartition(5), labels).collect()}
    assert again == {i: r["score"] for i, r in by_id.items()}


@pytest.mark.parametrize("labels", ["", "quality = 1"])
def test_without_both_labels(spark, labels):
    df, known = tables(spark, 10)
    known = known.where(labels) if labels else known.limit(0)
    scores = {r["score"] for r in quality.score_texts(df, known).collect()}
    assert len(scores) == 1 and (scores == {0.5} if not labels else scores.pop() > 0.5)


def test_empty_table(spark):
    df, labels = tables(spark, 4)
    assert quality.score_texts(df.limit(0), labels).count() == 0


def test_regression_finds_the_weights_of_its_own_data():
    rng = np.random.default_rng(1)
    x = np.stack([np.ones(20_000), rng.normal(size=20_000)], axis=1)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 1])))).astype(float)
    assert np.allclose(quality.logistic(x, y, np.ones(20_000)), [0.5, 2], atol=0.1)


def test_one_labelled_id_of_most_rows(spark, monkeypatch):
    """The sample stays bounded where an id repeats without end."""
    monkeypatch.setattr(quality, "TEXTS", 50)
    rows = [(1 if i % 2 else i, (GOOD if i % 2 else BAD).format(i * 7919)) for i in range(2000)]
    labels = [(1, 1)] + [(i, 0) for i in range(0, 2000, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality.learn(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    right = quality.score(df, model).withColumn("right", (quality.F.col("score") >= 0.5) == (quality.F.col("doc_id") == 1))
    assert right.where("right").count() > 1990
