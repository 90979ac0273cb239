from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from tradewind.llm import ngram_join
from tradewind.llm.components import components


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) by comparing every two rows that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    ids = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)].append(key)
    return sorted(((rows[i][0], len(sets[i]), min(ids[find(i)], default=None)) for i in range(len(rows))), key=str)


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in ngram_join.classes(frame).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_against_brute_force_on_a_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(spark, rows) == brute(rows)


def test_against_brute_force_on_near_copies_of_every_degree(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 4)))
    rows = []
    for family in range(12):
        base = [word() for _ in range(rng.randint(1, 120))]
        for _ in range(15):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = word()
            rows.append((len(rows) * 7 % 1000, rng.choice(["  ", "\n", " "]).join(own).title()))
    common = " ".join(word() for _ in range(60))
    rows += [(2000 + i, common + " " + " ".join(word() for _ in range(rng.randint(5, 60)))) for i in range(40)]
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    five = "one two three four five"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "A b"), (9, "a B"), (7, five), (7, five), (None, five), (None, "lone text of its own words"), (5, "x " * 20_000)]
    assert found(spark, rows) == brute(rows)
    assert ngram_join.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "a b c d e f", 5, "x")], "doc_id long, text string, node int, token string")
    assert ngram_join.classes(frame).count() == 1


@pytest.mark.parametrize("per_task", [40, 10_000])
def test_components_in_any_number_of_tasks(spark, monkeypatch, per_task):
    from tradewind.llm import components as module

    monkeypatch.setattr(module, "PER_TASK", per_task)
    rng = random.Random(1)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert got == root


def test_rows_without_ids_or_with_one_id_do_not_multiply(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [[draw.choice(words) for _ in range(60)] for _ in range(40)]
    texts = [" ".join(b if draw.random() > 0.02 else "x" for b in base[i % 40]) for i in range(300)]
    for key in (None, 7):
        rows = [(key, t) for t in texts]
        assert found(spark, rows) == brute(rows)


def test_more_repeated_tokens_than_are_held(spark, monkeypatch):
    """A crowd of tokens beyond every bound changes what is compared, not what is found."""
    monkeypatch.setattr(ngram_join, "COMMON", 50)
    monkeypatch.setattr(ngram_join, "HELD", 80)
    draw = random.Random(4)
    lines = [" ".join(f"p{i}q{j}" for j in range(30)) for i in range(12)]
    rows = [(i, " ".join([draw.choice(lines), f"own{i % 90} text{i % 90} here{i % 90}", draw.choice(lines)])) for i in range(400)]
    assert found(spark, rows) == brute(rows)


def test_one_row_is_kept_of_a_shuffled_table(spark):
    rows = [(i, " ".join(f"word{j + 100 * (i % 5)}" for j in range(40)), i) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, node long").repartition(7).orderBy("text").repartition(5)
    kept = ngram_join.keep_one(frame)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4] and kept.columns == frame.columns


def test_sketches_never_rule_out_similar_sets():
    draw = np.random.default_rng(2)
    for n in [1, 2, 3, 7, 40, 300, 5_000] * 20:
        whole = draw.integers(0, 2**63, n + n // 3, dtype=np.uint64)
        a, b = whole[: n + int(draw.integers(0, n // 3 + 1))], whole[int(draw.integers(0, n // 3 + 1)) :]
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            assert ngram_join._near(*(ngram_join._opened(ngram_join._sketch(x)) for x in (a, b)))
    far = [ngram_join._opened(ngram_join._sketch(draw.integers(0, 2**63, n, dtype=np.uint64))) for n in (300, 320)]
    assert not ngram_join._near(*far)


def test_whole_sets_move_only_for_pairs_that_may_be_similar(spark, monkeypatch):
    """Texts that share a passage, but are not similar, are told apart by their sketches."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdef") for _ in range(6))
    passages = [" ".join(word() for _ in range(30)) for _ in range(4)]
    rows = [(i, " ".join([passages[i % 4], *(word() for _ in range(70))])) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(10)]
    sent, match = [], ngram_join._matched

    def counted(pairs, contents, hubs_held, opened, alike):
        if alike is ngram_join._similar:
            sent.append(pairs.count())
        return match(pairs, contents, hubs_held, opened, alike)

    monkeypatch.setattr(ngram_join, "_matched", counted)
    assert found(spark, rows) == brute(rows)
    assert sum(sent) == 10
