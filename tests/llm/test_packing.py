from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewind.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(sequences) -> int:
    return sum(0 if n & (n - 1) == 0 else packing.CAPACITY - n for n in sequences)


def checked(spark, rows) -> tuple[int, int]:
    """Every id of every row lies in one piece, every sequence is gapless; returns ids and padding."""
    library = Tokenizer.from_file(PATH)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    placed = packing.pack(frame, PATH, with_ids=True)
    pieces = placed.collect()
    wanted = defaultdict(list)
    for key, text in rows:
        wanted[key].append([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID])
    found, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"] and len(p["ids"]) == p["length"]
        found[p["doc_id"]].append((p["start"], list(p["ids"]), p["doc_tokens"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for key, texts in wanted.items():
        if len(texts) == 1:
            got = sorted(found[key])
            assert [i for _, ids, _ in got for i in ids] == texts[0] and {n for _, _, n in got} == {len(texts[0])}
            assert [s for s, _, _ in got] == np.cumsum([0, *[len(ids) for _, ids, _ in got]])[:-1].tolist()
        else:
            assert sum(len(ids) for _, ids, _ in found[key]) == sum(map(len, texts))
    fills = []
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist()
        fills.append(sum(n for _, n in own))
    assert max(fills, default=0) <= packing.CAPACITY
    for s in packing.sequences(placed).collect():
        assert len(s["ids"]) == (s["length"] if s["length"] & (s["length"] - 1) == 0 else packing.CAPACITY)
    return sum(fills), padding(fills)


def test_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    ids, padded = checked(spark, rows)
    assert padded < 0.05 * ids


def test_many_lengths(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a", "bc", "Die", "tion", "xyzzy"]) for _ in range(int(rng.expovariate(1 / 700))))) for i in range(1500)]
    ids, padded = checked(spark, rows)
    assert padded < 0.05 * ids


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x " * 30_000), (5, "same"), (5, "same"), (None, "no id"), (6, "<|endoftext|> é ﬁ É"), (7, "a" * 5000)]
    assert checked(spark, rows)[0] > 30_000
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_extra_columns(spark):
    assert packing.pack(spark.createDataFrame([(1, "a b", 1, 2)], "doc_id long, text string, k int, length int"), PATH).count() == 1


@pytest.mark.parametrize("capacity", [4096, 100])
def test_cut(capacity):
    for n in range(1, 3 * capacity):
        lengths = packing.cut(n, capacity)
        assert sum(lengths) == n and all(0 < x <= capacity for x in lengths)
        assert all(x in {capacity // k for k in range(1, capacity)} for x in lengths[:-1])
