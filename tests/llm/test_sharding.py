from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from tradewind.llm import sharding

NAMES = [f"shard-{i:03d}" for i in range(16)]


def test_turns_by_hand():
    names, size = ["a", "b", "c"], 11
    preferences = []
    for n in names:
        digest = hashlib.md5(n.encode()).hexdigest()
        offset, skip = int(digest[:8], 16) % size, int(digest[8:16], 16) % (size - 1) + 1
        preferences.append([(offset + j * skip) % size for j in range(size)])
    taken: dict[int, int] = {}
    while len(taken) < size:
        for shard, order in enumerate(preferences):
            if free := [s for s in order if s not in taken]:
                taken[free[0]] = shard
    assert sharding.table(names, size).tolist() == [taken[i] for i in range(size)]


def test_even_and_steady():
    owner = sharding.table(NAMES)
    loads = Counter(owner.tolist()).values()
    assert max(loads) - min(loads) <= 1 and len(loads) == 16
    assert sharding.moved(NAMES, [*NAMES, "shard-016"]) < 0.12
    assert sharding.moved(NAMES, NAMES) == 0
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.table(wrong)
    with pytest.raises(ValueError):
        sharding.table(["a"], 65_536)


def test_every_row_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    owner = np.array(NAMES)[sharding.table(NAMES)]
    rows = sharding.place(docs, NAMES).collect()
    assert len(rows) == docs.count()
    for r in rows:
        own = int(hashlib.md5(str(r["key"]).encode()).hexdigest()[:8], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (own, owner[own])


def test_odd_rows(spark):
    frame = spark.createDataFrame([(None, 1), (3, 1), (3, 2)], "doc_id long, slot int")
    rows = sharding.place(frame, NAMES).collect()
    assert len(rows) == 3 and len({r["shard"] for r in rows if r["key"] == 3}) == 1
    assert sharding.place(frame.limit(0), NAMES).count() == 0
