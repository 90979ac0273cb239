from __future__ import annotations

import math

import numpy as np

from tradewind.llm import embedding_dedup


def brute(rows) -> dict:
    """vec_id -> (n_links, component_id) of rows with distinct ids."""
    usable = [(k, np.array(v, float), label) for k, v, label in rows if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: 0 for k, _, _ in rows}
    root = {k: k for k, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, u, x) in enumerate(usable):
        for b, v, y in usable[:i]:
            if x == y and len(u) == len(v) and u @ v / math.sqrt((u @ u) * (v @ v)) >= 0.93:
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (links[k], find(k)) for k in links}


def found(spark, rows, kind="float"):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.classes(frame).collect()}


def test_table(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert found(spark, rows) == brute(rows)


def test_chains_and_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 20)
    rng = np.random.default_rng(4)
    rows = []
    for group in range(8):
        base = rng.standard_normal(16)
        for _ in range(60 if group == 0 else 8):
            base = base + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.3])
            rows.append((len(rows), base.astype(np.float32).tolist(), group % 3))
    got, wanted = found(spark, rows), brute(rows)
    missed = sum(a[0] for a in wanted.values()) - sum(a[0] for a in got.values())
    assert 0 <= missed <= 0.01 * sum(a[0] for a in wanted.values())
    assert all(got[k][0] <= wanted[k][0] for k in wanted)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None),
        (8, [1.0, 0.0], 1), (9, [1.0, 0.0], 1), (10, [2.0, 0.1], 1), (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1), (13, [-1.0, 0.0], 1),
    ]
    assert found(spark, rows) == brute(rows) == found(spark, rows, "double")
    twice = spark.createDataFrame([(5, [1.0, 2.0], 1, 0), (5, [1.0, 2.0], 1, 0), (None, [1.0, 2.0], 1, 0)], "vec_id long, embedding array<float>, label int, row int")
    assert sorted(r["n_links"] for r in embedding_dedup.classes(twice).collect()) == [2, 2, 2]
    assert embedding_dedup.classes(twice.limit(0)).count() == 0


def test_layout_keeps_recall():
    for rows in (0, 1, 1000, 10**6, 10**9):
        planes, tables = embedding_dedup.layout(rows)
        same = (1 - math.acos(0.93) / math.pi) ** planes
        assert 1 - (1 - same) ** tables >= embedding_dedup.RECALL
