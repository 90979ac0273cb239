from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from tradewind.llm import katz

END = object()


def brute(rows, vocabulary):
    """Scores by dictionaries, and the probability of any word after any context."""
    texts = [[*(t or "").encode().lower().split(), END] for _, t in rows]
    out = [zlib.crc32(b"" if k is None else str(k).encode()) % 7 == 2 for k, _ in rows]
    train = [t for t, o in zip(texts, out, strict=True) if not o]
    count = Counter(w for t in train for w in t)
    total, distinct = sum(count.values()), len(count)
    sizes = Counter(n for w, n in count.items() if w is not END)
    least, kept = max(sizes, default=0) + 1, 0
    for r in sorted(sizes, reverse=True):
        if kept + sizes[r] > vocabulary:
            break
        least, kept = r, kept + sizes[r]
    common = {w for w, n in count.items() if w is END or n >= least} | {END}
    cls = lambda w: w if w in common else "other"
    pairs = Counter((a, b) for t in train for a, b in zip(["start", *map(cls, t[:-1])], map(cls, t), strict=True))
    discount = katz.discounts(Counter(pairs.values()))
    classes = [*common, "other"]
    class_count = Counter(cls(w) for t in train for w in t)
    single = {c: (class_count[c] + 1) / (total + len(classes)) for c in classes}
    context = Counter()
    for (a, _), n in pairs.items():
        context[a] += n
    after = defaultdict(dict)
    for (a, b), n in pairs.items():
        after[a][b] = n
    rare_total = sum(n for w, n in count.items() if w not in common)
    rare_distinct = sum(w not in common for w in count)

    @cache
    def facts(h):
        own = {b: (discount[n] if n <= katz.DISCOUNTED else 1) * n / context[h] for b, n in after[h].items()}
        return own, 1 - sum(own.values()), 1 - sum(single[b] for b in own)

    def p(h, c):
        own, left, free = facts(h)
        if free <= 1e-9:
            return own[c] / sum(own.values())
        if left <= 1e-9:
            return own[c] * context[h] / (context[h] + 1) if c in own else single[c] / free / (context[h] + 1)
        return own[c] if c in own else left / free * single[c]

    def word(h, w):
        return p(h, cls(w)) * (1 if w in common else (count[w] + 1) / (rare_total + rare_distinct + 1))

    found = []
    for (key, _), t, o in zip(rows, texts, out, strict=True):
        score = sum(math.log10(word(h, w)) for h, w in zip(["start", *map(cls, t[:-1])], t, strict=True))
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t)
        found.append((key, o, len(t), sum(count[w] > 0 for w in t), total, base, score))
    sums = [sum(p(h, c) for c in classes) for h in [*list(after)[:50], "start"]] if len(classes) < 1000 else [1]
    return found, sums


def check(spark, rows, vocabulary):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = sorted((tuple(r[n] for n in names) for r in katz.score_texts(frame, vocabulary=vocabulary).collect()), key=str)
    wanted, sums = brute(rows, vocabulary)
    wanted = sorted(wanted, key=str)
    assert [g[:5] for g in got] == [w[:5] for w in wanted]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in wanted], rtol=1e-9)
    assert np.allclose(sums, 1)
    return got


@pytest.mark.parametrize("vocabulary", [0, 40, 100_000])
def test_against_dictionaries(spark, vocabulary):
    rng = random.Random(8)
    word = lambda: rng.choice("the of and Tion ing".split()) if rng.random() < 0.6 else "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n "), (None, "the the"), (5, "the of"), (203, "x " * 30_000)]
    check(spark, rows, vocabulary)


def test_better_than_base_where_held_out(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = check(spark, rows, katz.VOCABULARY)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_empty_and_untrained(spark):
    assert katz.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(spark, [(only, "never seen")], 10)


def test_rare_words_keep_their_pairs(spark):
    """More words than any fixed table: each keeps what followed it."""
    rows = [(i, " ".join(f"w{i}x{j} w{i}y{j}" for j in range(2_000))) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in katz.score_texts(frame).collect()}
    found, _ = brute(rows, math.inf)
    for key, _, n, known, total, base, score in found:
        r = got[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert np.allclose([r["base_score"], r["score"]], [base, score], rtol=1e-9)


def test_hash_is_that_of_spark(spark):
    a, b = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (2, 50))
    frame = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a long, b long")
    assert [r[0] for r in frame.selectExpr("xxhash64(a, b)").collect()] == katz.mixed(a, b).tolist()


@pytest.mark.parametrize("order", [3, 4])
def test_higher_orders(spark, order):
    """Against the recursive definition, which sums to 1 over all words after any context."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("a b c d e f g".split()) for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2), "a unseen b")]
    texts = [[*t.split(), END] for _, t in rows]
    train = [t for (k, _), t in zip(rows, texts, strict=True) if zlib.crc32(str(k).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    shares = sum(count.values()) + len(count) + 1
    padded = lambda t: ["start"] * (order - 1) + t
    grams = {k: Counter(tuple(padded(t)[i - k + 1 : i + 1]) for t in train for i in range(order - 1, len(padded(t)))) for k in range(2, order + 1)}
    factors = {k: katz.discounts(Counter(g.values())) for k, g in grams.items()}

    @cache
    def p(h, w):
        if not h:
            return (count[w] + 1) / shares
        own = {g[-1]: n for g, n in grams[len(h) + 1].items() if g[:-1] == h}
        held = sum(own.values())
        if not own:
            return p(h[1:], w)
        share = {c: (factors[len(h) + 1][n] if n <= katz.DISCOUNTED else 1) * n / held for c, n in own.items()}
        left, free = 1 - sum(share.values()), 1 - sum(p(h[1:], c) for c in own)
        if left <= 1e-9:
            share, left = {c: s * held / (held + 1) for c, s in share.items()}, 1 / (held + 1)
        return share[w] if w in own else left / free * p(h[1:], w)

    got = {r["doc_id"]: r["score"] for r in katz.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), order=order).collect()}
    for (key, _), t in zip(rows, texts, strict=True):
        wanted = sum(math.log10(p(tuple(padded(t)[i : i + order - 1]), w)) for i, w in enumerate(t))
        assert math.isclose(got[key], wanted, rel_tol=1e-9), key
    assert math.isclose(sum(p(("a", "b", "c")[: order - 1], w) for w in [*count, "nowhere"]), 1)


def test_words_at_hand_or_joined_give_the_same_scores(spark, monkeypatch):
    texts = [(i, " ".join(f"w{(i * k) % 13}" for k in range(1, 9))) for i in range(60)] + [(60, None), (60, "w1 new"), (None, "w1 w1")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = []
    for heavy in (0, 5, 65_536):
        monkeypatch.setattr(katz, "HEAVY", heavy)
        rows = katz.score_texts(docs).collect()
        found.append(sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 9), round(r["score"], 9)) for r in rows))
    assert found[0] == found[1] == found[2]
    assert len(found[0]) == len(texts)
