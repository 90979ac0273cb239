"""The toxicity query: contract columns, held-out labels, edit distances, odd inputs."""

import zlib

from tradewind.llm import toxicity
from tradewind.llm.queries import op4_toxicity
from tradewind.llm.text import read


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op4_toxicity(spark, sf_dir).collect()
    docs = [r["doc_id"] for r in read(spark, sf_dir, "documents").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    truth = {r["doc_id"]: r["toxic"] for r in read(spark, sf_dir, "labels").collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40 and sum(p == t for p, t in held) >= 0.95 * len(held)
    assert all(p == t for p, t in held if t == 0)  # harmless texts are left alone


def test_ties_repeats_clashing_columns_and_missing_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels)
    toxic = labels.where("toxic = 1").select("doc_id").first()[0]
    text = docs.where(docs.doc_id == toxic).first()["text"]
    rows = [(1, text, "s", 1), (1, text, "s", 1), (None, text, None, None), (2, None, "t", 0), (3, "", "t", 0), (4, text + " quiet words" * 50_000, "y", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string, y int").repartition(3)
    scores = [(r["doc_id"], r["score"]) for r in toxicity.score(frame, model).collect()]
    whole = {s for i, s in scores if i in (1, None)}
    assert len(scores) == 6 and len(whole) == 1 and whole.pop() >= 0.5
    assert all(s < 0.5 for i, s in scores if i in (2, 3))
    kept = toxicity.keep(frame, model)
    assert kept.columns == frame.columns and {2, 3} <= {r["doc_id"] for r in kept.collect()}
    assert toxicity.keep(frame.limit(0), model).count() == 0
    assert toxicity.learn(docs, labels.limit(0)) is None and toxicity.score(frame, None).where("score > 0").count() == 0
