from __future__ import annotations

import corpus_pipeline
from tradewind.llm import packing, quality_rules, toxicity
from tradewind.llm.queries import tokenizer
from tradewind.session import materialise

from .test_ngram_join import brute
from .test_secret_scan import TRUE_SECRET


def test_stages_on_a_table(spark, sf_dir):
    sf_dir = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = materialise(stage(spark, held, sf_dir), "stage")
        assert made.columns == docs.columns
        after = {r["doc_id"]: r for r in made.collect()}
        assert set(after) <= set(before)
        gone = set(before) - set(after)
        if name == "quality rules":
            verdicts = {r["doc_id"]: r["kept"] for r in quality_rules.report(docs).collect()}
            assert set(after) == {k for k, kept in verdicts.items() if kept}
        elif name == "toxicity":
            assert all(labels[k]["toxic"] for k in gone if k in labels)
        elif name == "n-gram Jaccard join":
            classes = brute([(k, r["text"]) for k, r in before.items()])
            assert set(after) == {k for k, _, component in classes if k == component}
        else:
            assert set(after) == set(before)
            changed = {k for k in after if after[k]["text"] != before[k]["text"]}
            assert changed == {k for k, r in before.items() if TRUE_SECRET.search(r["text"])} != set()
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        if name != "secret scans":
            assert all(after[k] == before[k] for k in after)
        held, before = made, after
    placed = corpus_pipeline.STAGES[-1][1](spark, held, sf_dir)
    pieces = packing.pieces(held, tokenizer("word_bpe_49k.json"))
    assert placed.groupBy().sum("length").first()[0] == pieces.groupBy().sum("length").first()[0]
    assert {r["doc_id"] for r in placed.collect()} == set(before)


def test_odd_rows_through_every_stage(spark, sf_dir):
    body = " ".join(f"word{i}" for i in range(80))
    rows = [(1, body, None, None, None, "q"), (1, body, "en", "s", 5, "r"), (None, body + " more", "en", "s", 5, "t"), (None, None, None, None, None, None), (4, "", "en", "s", 0, "u"), (5, "x " * 20_000, "en", "s", 0, "v")]
    held = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held = materialise(stage(spark, held, sf_dir), "stage")
    assert [(r["doc_id"], r["kept"]) for r in held.collect()] in ([(1, "q")], [(1, "r")])
    assert corpus_pipeline.STAGES[-1][1](spark, held, sf_dir).count() >= 1
    empty = held.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_toxic_words_misspelt_and_quoted(spark):
    terms = "muppet scoundrel nincompoop".split()
    plain = "the report of that meeting was long and fair to all who came".split()
    rows, labels = [], []
    for i in range(400):
        words = [plain[(i * 7 + j * 3) % len(plain)] for j in range(30 + i % 9)]
        if i % 3 == 0:
            words[5 + i % 11] = words[20 + i % 7] = terms[i // 3 % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, marks)
    assert set(model.reader.automaton.terms) == set(terms)
    tests = [(1, "what a muppet and scoundrel you are"), (2, "what a mupet and scoundrell and nincompop and muppett you are"), (3, "the report was fair"), (4, 'they said "muppet" in the report'), (5, None), (6, ""), (7, "muppet you")]
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert scores[1] > 0.5 and scores[2] > 0.5 and scores[3] == scores[5] == scores[6] < 0.5 and scores[4] < scores[7]
    assert toxicity.learn(docs, marks.where("toxic = 0")) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_automaton_by_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
        return row[-1]

    import random

    rng = random.Random(2)
    terms = tuple({"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(12)})
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 13))) for _ in range(600)] + list(terms)
    kinds = toxicity.Automaton(terms).kinds(words)
    for word, kind in zip(words, kinds.tolist(), strict=True):
        best = [distance(word, t) for t in terms if distance(word, t) <= toxicity.allowed_edits(t)] if word else []
        assert kind == (0 if not best else 1 if min(best) == 0 else 2), word
