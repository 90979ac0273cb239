"""The cascade: order by rejections per second, verdicts whatever the order, odd inputs."""

import itertools

import numpy as np
import pyarrow as pa

from tradewind.llm import quality_rules as rules


def test_order_is_by_rejections_per_second():
    own = tuple(rules.Rule(n, lambda m: m.n_words < 1) for n in "abcd")
    known = {"a": (1.0, 0.5), "b": (0.1, 0.1), "c": (0.001, 0.0), "d": (0.01, 0.2)}
    assert [r.name for r in rules.ordered(own, known)] == ["d", "b", "a", "c"]
    assert [r.name for r in rules.ordered(own, {"b": (1.0, 0.1)})][0] == "b"


TEXTS = ["word " * 60, "", "### $$$ " * 40, "LOUD NOISE " * 40, "a b c d e f " * 30, " ".join(f"w{i}" for i in range(80)), "x" * 5000 + " y", "1 2 3 " * 40, "line one two\n" * 9 + " ".join(f"v{i}" for i in range(70))]


def test_verdicts_do_not_depend_on_the_order():
    measures = rules.Measures(pa.array(TEXTS))
    expected = [any(bool(r.rejects(rules.Measures(pa.array([t])))[0]) for r in rules.RULES) for t in TEXTS]
    for order in itertools.islice(itertools.permutations(rules.RULES), 0, 5040, 97):
        assert ((rules.cascade(measures, list(order)) >= 0) == expected).all()


def test_later_rules_see_only_survivors():
    seen = []
    spy = lambda name, found: rules.Rule(name, lambda m: (seen.append((name, len(m.texts))), np.array([found(t) for t in m.texts.to_pylist()], bool))[1])
    verdict = rules.cascade(rules.Measures(pa.array(["a", "b", "ab", ""])), [spy("a", lambda t: "a" in t), spy("b", lambda t: "b" in t), spy("none", lambda t: False)])
    assert verdict.tolist() == [0, 1, 0, -1] and seen == [("a", 4), ("b", 2), ("none", 1)]


def test_costs_come_from_all_parts_of_the_table(spark):
    """Texts that a rule rejects stand at the end of the table only; the sample meets them."""
    rows = [(i, ("good words here now " * 20) if i < 1900 else "### " * 60) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    known = rules.costs(frame, rows=800)
    assert abs(known["symbols"][1] - 2100 / 4000) < 0.1 and all(seconds > 0 for seconds, _ in known.values())


def test_nulls_ties_long_texts_and_clashing_columns(spark):
    rows = [(None, None, 1, True), (1, "", 2, None), (1, "", 2, None), (2, " ".join(f"w{i}" for i in range(200_000)), 3, False), (3, " ".join(f"w{i}" for i in range(60)), 4, False)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    kept = rules.keep(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    report = rules.report(frame).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept"]) for r in report) == [(0, 0, False), (1, 0, False), (1, 0, False), (2, 200_000, True), (3, 60, True)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rules.keep(empty).count() == 0 and rules.report(empty).count() == 0
