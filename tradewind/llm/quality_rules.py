"""Quality rules as a short-circuit cascade.

Each rule is a cheap test over word or line counts of a text. A bounded sample tells what a rule
costs and how many texts it rejects; rules then run in order of rejections per second, and a text
that one rule rejects is not shown to the next. The order changes the work, never the verdict.

Null text counts as empty: no words, no lines, rejected by ``too_few_words``. Ties and repeated
rows are judged row by row, each alike. An empty table gives an empty result. Columns other than
the text are passed through untouched, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import Words, by_slice, released, slices, strings

SYMBOLS = r"[#*$%&|<>]"


class Measures:
    """Counts over several texts, each worked out when a rule first asks for it."""

    def __init__(self, texts: pa.Array, words: Words | None = None):
        self.texts = texts
        if words is not None:
            self.words = words

    @cached_property
    def words(self) -> Words:
        return Words.of(self.texts)

    def some(self, kept: np.ndarray) -> Measures:
        return Measures(self.texts.filter(pa.array(kept)), self.words.some(kept) if "words" in self.__dict__ else None)

    def _per_word(self, values: pa.Array) -> np.ndarray:
        return self.words.total(values.cast(pa.int64()).to_numpy(zero_copy_only=False))

    @cached_property
    def n_words(self) -> np.ndarray:
        return self.words.counts

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self._per_word(pc.utf8_length(self.words.vocabulary))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_word(pc.count_substring_regex(self.words.vocabulary, SYMBOLS))

    @cached_property
    def n_shouted(self) -> np.ndarray:
        """Words of two or more capitals without a small letter."""
        vocabulary = self.words.vocabulary
        loud = pc.and_(pc.match_substring_regex(vocabulary, r"\p{Lu}[^\p{L}]*\p{Lu}"), pc.invert(pc.match_substring_regex(vocabulary, r"\p{Ll}")))
        return self._per_word(loud)

    @cached_property
    def n_lettered(self) -> np.ndarray:
        return self._per_word(pc.match_substring_regex(self.words.vocabulary, r"\p{L}"))

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those equal to an earlier one, of each text."""
        lists = pc.split_pattern(self.texts, "\n")
        owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        spoken = pc.match_substring_regex(coded.dictionary, r"[^ \t-\r]").to_numpy(zero_copy_only=False)
        held = spoken[codes] if len(codes) else np.zeros(0, bool)
        owner, codes = owner[held], codes[held]
        n = np.bincount(owner, minlength=len(self.texts))
        different = np.unique(owner * (len(spoken) + 1) + codes) // (len(spoken) + 1)
        return n, n - np.bincount(different, minlength=len(self.texts))

    @cached_property
    def n_lines(self) -> np.ndarray:
        return self._lines[0]

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words inside a three-word window that its text holds more than once."""
        codes, at = self.words.codes, self.words.starts(3)
        if not len(at):
            return np.zeros(len(self.texts), np.int64)
        size = len(self.words.vocabulary) + 1
        window = self.words.owner[at]
        for step in range(3):  # number the pairs (what came before, next word) afresh, so that keys stay small
            window = pd.factorize(window * size + codes[at + step])[0].astype(np.int64)
        again = at[np.bincount(window)[window] > 1]
        covered = np.zeros(len(codes), bool)
        for step in range(3):
            covered[again + step] = True
        return np.bincount(self.words.owner[covered], minlength=len(self.texts))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], np.ndarray]


# Shares are of the text's own words or lines; whole-number comparisons keep them exact.
BASE_RULES = (
    Rule("too_few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
EXTRA_RULES = (
    Rule("symbols", lambda m: 100 * m.n_symbols > 20 * m.n_words),
    Rule("shouting", lambda m: 100 * m.n_shouted > 30 * m.n_words),
    Rule("few_letters", lambda m: 100 * m.n_lettered < 60 * m.n_words),
    Rule("long_words", lambda m: m.word_chars > 25 * m.n_words),
    Rule("repeated_lines", lambda m: (m.n_dup_lines >= 3) & (100 * m.n_dup_lines > 30 * m.n_lines)),
)
RULES = BASE_RULES + EXTRA_RULES


def costs(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", rows: int = 1000) -> dict[str, tuple[float, float]]:
    """Seconds per text and share rejected of each rule alone, over about ``rows`` rows drawn from all of ``df``.

    Every task measures its own share of the sample; no text is moved."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            texts = strings(batch.column("t"))
            out: dict[str, list] = {"name": [], "seconds": [], "rejected": [], "seen": []}
            for rule in rules:
                began = time.perf_counter()
                rejected = int(rule.rejects(Measures(texts)).sum())
                for key, value in zip(out, (rule.name, time.perf_counter() - began, rejected, len(texts)), strict=True):
                    out[key].append(value)
            yield pa.RecordBatch.from_pydict(out)

    share = min(1.0, rows / max(df.count(), 1))
    sample = df.select(F.col(text).cast("string").alias("t")).sample(share, seed=7)
    told = sample.mapInArrow(released(measure), "name string, seconds double, rejected long, seen long")
    sums = told.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "seen")]).collect()
    return {r["name"]: (r["seconds"] / r["seen"], r["rejected"] / r["seen"]) for r in sums if r["seen"]}


def ordered(rules: tuple[Rule, ...], known: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; rules that nothing is known of last."""

    def worth(rule: Rule) -> float:
        seconds, share = known.get(rule.name, (1.0, 0.0))
        return share / max(seconds, 1e-9)

    return sorted(rules, key=worth, reverse=True)


def cascade(measures: Measures, rules: list[Rule]) -> np.ndarray:
    """Number of the rule that rejects each text, -1 for those kept; later rules see only survivors."""
    verdict = np.full(len(measures.texts), -1)
    alive = np.arange(len(verdict))
    for number, rule in enumerate(rules):
        if not len(alive):
            break
        rejected = np.asarray(rule.rejects(measures), bool)
        if rejected.any():
            verdict[alive[rejected]] = number
            alive = alive[~rejected]
            measures = measures.some(~rejected)
    return verdict


def plan(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> list[Rule]:
    return ordered(rules, costs(df, rules, text))


def keep(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows whose text no rule rejects, columns unchanged."""
    chosen = plan(df, rules, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(cascade(Measures(strings(batch.column(text))), chosen) < 0))

    return by_slice(df, text, work, df.schema)


def report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: the base counts, whether a base rule fails, the cascade's verdict
    and ``rejected_by`` (a base rule, else the first extra rule in the order chosen).

    Every text gets all base counts, so the base rules are read off them and the cascade orders
    and cuts short the extra rules."""
    chosen = plan(df, EXTRA_RULES, text)
    names = np.array([r.name for r in (*chosen, *BASE_RULES)] + [None], dtype=object)

    def work(batch: pa.RecordBatch) -> dict:
        measures = Measures(strings(batch.column("text")))
        out: dict = {"doc_id": batch.column("doc_id")}
        out |= {name: getattr(measures, name).astype(np.int64) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        base = cascade(measures, list(BASE_RULES))
        passed = base < 0
        extra = np.full(len(base), -1)
        extra[passed] = cascade(measures.some(passed), chosen)
        verdict = np.where(passed, extra, base + len(chosen))
        out |= {"base_failed": ~passed, "kept": verdict < 0, "rejected_by": pa.array(list(names[verdict]), pa.string())}
        return out

    schema = "doc_id {}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"
    frame = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_slice(frame, "text", work, schema.format(frame.schema["doc_id"].dataType.simpleString()))
