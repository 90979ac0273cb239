"""The divergence audit against counts by hand, and its perfect hashes."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradewind.llm import divergence
from tradewind.llm.hashing import Shards, hash64, perfect

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    docs = [((lang or ""), (source or ""), Counter(TERM.findall((text or "").translate(LOWER)))) for text, lang, source in rows]
    held = defaultdict(Counter)
    for lang, _, terms in docs:
        held[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in c.items() if n >= least) for lang, c in held.items()}
    counts, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        counts[lang, source].update(terms)
        whole[lang].update(terms)

    def shares(lang, c):
        total = sum(c[t] for t in kept[lang]) + len(kept[lang])
        return {t: 1 + 1_000_000_000 * (c[t] + 1) // total for t in kept[lang]}

    p = {g: shares(g[0], c) for g, c in counts.items()}
    out = []
    for lang, source in counts:
        own = p[lang, source]
        pairs = [(s, sum((own[t] - q[t]) ** 2 // q[t] for t in own)) for (other, s), q in p.items() if other == lang and s != source]
        q = shares(lang, whole[lang])
        terms = [(t, (own[t] - q[t]) ** 2 // q[t]) for t in own if counts[lang, source][t] > 0 and own[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
            ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


ROWS = [
    ("Alpha beta, beta GAMMA-delta été", "x", "a"),
    ("alpha beta gamma été été_ÉTÉ", "x", "b"),
    ("alpha 1beta2 gamma   une deux", "x", "b"),
    ("beta beta beta alpha gamma delta delta delta", "x", "c"),
    ("beta beta beta alpha gamma delta delta delta", "x", "c"),
    (None, "x", "d"),
    ("", "x", None),
    ("solo terms only here", None, "a"),
    ("solo", None, "a"),
    ("123 !!", "y", "a"),
    ("nothing kept", "y", "b"),
]


def rows_of(frame):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in frame.collect())


@pytest.mark.parametrize("setting", [{}, {"PER_SHARD": 2, "WAVE": 1, "HELD": 8, "FAN": 2, "BLOCK": 2}])
def test_small_tables(spark, monkeypatch, setting):
    for name, value in setting.items():
        monkeypatch.setattr(divergence, name, value)
    df = spark.createDataFrame([(i, *r, "kept out") for i, r in enumerate(ROWS)], "doc_id long, text string, lang string, source string, term string").repartition(3)
    least = 1 if setting else 3
    assert rows_of(divergence.audit(df, least=least, top=3)) == brute(ROWS, least, 3)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert rows_of(divergence.audit(df)) == brute(rows)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_shares_are_exact_for_large_counts():
    counts, total = np.array([0, 1, 12_345_678_901_234, 10**15], np.int64), 9 * 10**15
    assert divergence.share(counts, total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts.tolist()]


def test_perfect_hashes():
    keys = pa.array([f"w{i}é" for i in range(5000)])
    hashes = hash64(keys)
    assert len(np.unique(hashes)) == 5000 and (hash64(keys.slice(7, 50)) == hashes[7:57]).all()
    shards = []
    for number in range(3):
        own = keys.filter(pa.array(hashes % np.uint64(3) == number))
        order, levels, words = perfect(hash64(own))
        assert sorted(order.tolist()) == list(range(len(own)))
        shards.append((number, levels, words.tobytes(), own.take(pa.array(order))))
    found = Shards(3, shards).find(hashes, keys)
    assert sorted(found.tolist()) == list(range(5000))
    strange = pa.array([f"v{i}" for i in range(5000)])
    assert (Shards(3, shards).find(hash64(strange), strange) == -1).all()
    part = Shards(3, shards[1:])
    assert ((part.find(hashes, keys) >= 0) == (hashes % np.uint64(3) > 0)).all()


def test_keys_with_equal_hashes_are_left_over():
    keys, hashes = pa.array(["a", "b", "c"]), np.array([5, 5, 9], np.uint64)
    order, levels, words = perfect(hashes)
    shards = Shards(1, [(0, levels, words.tobytes(), keys.take(pa.array(order)))])
    assert sorted(shards.find(hashes, keys).tolist()) == [0, 1, 2]
    assert shards.find(np.array([5], np.uint64), pa.array(["z"])).tolist() == [-1]
