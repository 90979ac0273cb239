"""Toxicity from a learned lexicon, misspellings included, read in context.

``learn`` takes at most ``PER_CLASS`` labelled texts of each class, finds words that mark toxic
ones, and fits a logistic model on what a text's hits add up to. A hit is a word that a
Levenshtein automaton accepts when it runs along the lexicon trie: the set of (trie node, edits
spent) pairs after each letter is one automaton state, made when a word first reaches it. Hits
near quotation marks or reporting words weigh less than plain ones.

Null and empty texts hold no words and get the model's score for no hits. Without labelled rows of
both classes every text scores 0. Labels that repeat for a document count as toxic if one says so.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import Words, by_slice, remainder, strings

PER_CLASS = 3000
MAX_TERMS = 400
MAX_LETTERS = 24
QUOTED_WEIGHT = 0.25
# Labels often hold too few misspellings to weigh them; then one counts as this share of a term.
MISSPELLED_WEIGHT = 0.5
WINDOW = 4
EDGES = ".,;:!?\"'`()[]{}<>*_~|/\\#$%&+=-“”„«»‘’…¡¿"
QUOTES = "\"“”„«»‘’"
REPORTING = (
    "said", "says", "called", "quote", "quoted", "quoting", "wrote", "word", "words", "term", "insult", "slur",
    "sagte", "nannte", "schrieb", "wort", "zitat", "dijo", "llamó", "escribió", "palabra", "cita",
    "dit", "appelé", "écrit", "mot", "citation",
)


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 10 else 2


@dataclass
class Automaton:
    """The lexicon trie under a Levenshtein automaton, made deterministic as words come along."""

    terms: tuple[str, ...]
    edits: dict[str, int] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "edits": self.edits}

    @cached_property
    def trie(self) -> tuple[list[dict[str, int]], dict[int, str], list[int]]:
        children: list[dict[str, int]] = [{}]
        ends: dict[int, str] = {}
        room = [0]  # the most edits that any term below a node allows
        for term in self.terms:
            node, most = 0, self.edits.get(term, allowed_edits(term))
            room[0] = max(room[0], most)
            for letter in term:
                if letter not in children[node]:
                    children.append({})
                    room.append(0)
                    children[node][letter] = len(children) - 1
                node = children[node][letter]
                room[node] = max(room[node], most)
            ends[node] = term
        return children, ends, room

    def _closed(self, spent: dict[int, int]) -> frozenset[tuple[int, int]]:
        """With skipped lexicon letters; each node with the fewest edits."""
        children, _, room = self.trie
        todo = list(spent.items())
        while todo:
            node, e = todo.pop()
            if spent.get(node, 9) < e:
                continue
            for child in children[node].values():
                if e + 1 <= room[child] and e + 1 < spent.get(child, 9):
                    spent[child] = e + 1
                    todo.append((child, e + 1))
        return frozenset(spent.items())

    def _after(self, state: frozenset[tuple[int, int]], letter: str) -> frozenset[tuple[int, int]]:
        children, _, room = self.trie
        spent: dict[int, int] = {}
        for node, e in state:
            steps = [(node, e + 1)] if e + 1 <= room[node] else []
            steps += [(c, e + (own != letter)) for own, c in children[node].items() if e + (own != letter) <= room[c]]
            for at, cost in steps:
                if cost < spent.get(at, 9):
                    spent[at] = cost
        return self._closed(spent)

    def _accepts(self, state: frozenset[tuple[int, int]]) -> int:
        """0: no term; 1: a term itself; 2: a term with edits."""
        _, ends, _ = self.trie
        found = [e for node, e in state if node in ends and e <= self.edits.get(ends[node], allowed_edits(ends[node]))]
        return 0 if not found else 1 if min(found) == 0 else 2

    @cached_property
    def _made(self) -> dict:
        letters = sorted({x for t in self.terms for x in t})
        start = self._closed({0: 0})
        return {"letters": letters, "number": {frozenset(): 0, start: 1}, "states": [frozenset(), start],
                "next": np.full((2, len(letters) + 1), -1, np.int32), "accept": [0, self._accepts(start)]}

    def _step(self, state: int, letter: int) -> int:
        made = self._made
        target = self._after(made["states"][state], made["letters"][letter] if letter < len(made["letters"]) else "\0")
        number = made["number"].setdefault(target, len(made["states"]))
        if number == len(made["states"]):
            made["states"].append(target)
            made["accept"].append(self._accepts(target))
            if number >= len(made["next"]):
                made["next"] = np.vstack([made["next"], np.full_like(made["next"], -1)])
        return number

    def kinds(self, words: list[str]) -> np.ndarray:
        """For each word 0, 1 or 2 as in ``_accepts``; words longer than any match are 0."""
        kind = np.zeros(len(words), np.int8)
        if not self.terms or not words:
            return kind
        made = self._made
        table = np.full(0x110000, len(made["letters"]), np.int16)
        table[[ord(x) for x in made["letters"]]] = np.arange(len(made["letters"]))
        longest = max(len(t) + self.edits.get(t, allowed_edits(t)) for t in self.terms)
        fits = np.flatnonzero([0 < len(w) <= longest for w in words])
        letters = np.array([words[i] for i in fits], dtype=f"U{longest + 1}").view(np.uint32).reshape(len(fits), -1)
        state = np.ones(len(fits), np.int64)
        alive = np.arange(len(fits))
        for place in range(letters.shape[1]):
            ended = letters[alive, place] == 0
            done = alive[ended]
            kind[fits[done]] = np.array(made["accept"], np.int8)[state[done]]
            alive = alive[~ended]
            if not len(alive):
                break
            wanted = table[letters[alive, place]]
            new = made["next"][state[alive], wanted]
            for s, c in {*zip(state[alive][new < 0].tolist(), wanted[new < 0].tolist(), strict=True)}:
                number = self._step(s, c)  # may enlarge the table
                made["next"][s, c] = number
            state[alive] = made["next"][state[alive], wanted]
            alive = alive[state[alive] > 0]
        return kind


def plain(vocabulary: pa.Array) -> pa.Array:
    """Words without the punctuation around them."""
    return pc.utf8_trim(vocabulary, EDGES)


@dataclass
class Reader:
    """Turns texts into what the model reads. ``known``: harmless words that resemble a term."""

    automaton: Automaton
    known: frozenset[str] = frozenset()

    def hits(self, texts: pa.Array) -> tuple[Words, list[str], np.ndarray]:
        words = Words.of(texts, lower=True)
        bare = plain(words.vocabulary).to_pylist()
        kind = self.automaton.kinds(bare)
        if self.known:
            for i in np.flatnonzero(kind == 2):
                if bare[i] in self.known:
                    kind[i] = 0
        return words, bare, kind

    def features(self, texts: pa.Array) -> np.ndarray:
        """Per text: log of plain hits, of misspelled hits (quotations at less weight), and their share."""
        words, bare, kind = self.hits(texts)
        at = np.flatnonzero(kind[words.codes]) if len(words.codes) else np.empty(0, np.int64)
        weight = np.ones(len(at))
        if len(at):
            quoting = np.zeros(len(bare), bool)
            raw = words.vocabulary
            marked = pc.match_substring_regex(raw, f"^[{QUOTES}]|[{QUOTES}][.,;:!?]*$").to_numpy(zero_copy_only=False)
            quoting[:] = marked | np.isin(np.array(bare, dtype=object), REPORTING)
            for shift in range(-WINDOW, WINDOW + 1):
                near = at + shift
                inside = (near >= 0) & (near < len(words.codes))
                near = np.clip(near, 0, len(words.codes) - 1)
                same = inside & (words.owner[near] == words.owner[at])
                weight[same & quoting[words.codes[near]]] = QUOTED_WEIGHT
        exact = kind[words.codes[at]] == 1
        owner = words.owner[at]
        size = len(texts)
        plain_hits = np.bincount(owner[exact], weight[exact], size)
        misspelled = np.bincount(owner[~exact], weight[~exact], size)
        share = (plain_hits + misspelled) / np.maximum(words.counts, 1)
        return np.column_stack([np.log1p(plain_hits), np.log1p(misspelled), np.minimum(50 * share, 1)])


@dataclass
class Model:
    reader: Reader
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.reader.features(texts) @ self.weights + self.intercept)))


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """About ``PER_CLASS`` training texts of each class, chosen by a hash of their id."""
    marks = labels.select(F.col("doc_id").alias("k"), F.col("toxic").alias("y")).where("k is not null and y is not null")
    marks = marks.where(remainder("k", 5) != 0).groupBy("k").agg((F.max("y") > 0).alias("y"))
    counts = {r["y"]: r["count"] for r in marks.groupBy("y").count().collect()}
    place = F.pmod(F.xxhash64("k"), F.lit(1 << 32))
    share = F.when(F.col("y"), PER_CLASS / counts.get(True, 1)).otherwise(PER_CLASS / counts.get(False, 1))
    chosen = marks.where(place < share * float(1 << 32))
    texts = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return texts.join(F.broadcast(chosen), "k").select("t", "y")  # the chosen are about 2 * PER_CLASS rows


def _lexicon(sample: DataFrame) -> list[str]:
    """Words at least twenty times likelier in toxic texts, seen between ten different pairs of neighbours.

    Copies of a text repeat its words between the same neighbours, so they do not make a term."""

    def work(batch: pa.RecordBatch) -> dict:
        words = Words.of(strings(batch.column("t")), lower=True)
        bare = plain(words.vocabulary).dictionary_encode()
        same = bare.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes = same[words.codes] if len(words.codes) else words.codes
        before, after = np.roll(codes, 1), np.roll(codes, -1)
        first = np.flatnonzero(np.concatenate([[True], words.owner[1:] != words.owner[:-1]])) if len(codes) else codes
        before[first], after[first - 1] = -1, -1
        key = words.owner * (len(same) + 1) + codes
        at = np.unique(key, return_index=True)[1]
        names = bare.dictionary
        ends = lambda codes: names.take(pa.array(codes, mask=codes < 0))
        toxic = batch.column("y").to_numpy(zero_copy_only=False)[words.owner[at]]
        return {"w": names.take(pa.array(codes[at])), "y": toxic, "b": ends(before[at]), "a": ends(after[at])}

    seen = by_slice(sample, "t", work, "w string, y boolean, b string, a string").where("length(w) between 3 and 24")
    per_context = seen.groupBy("w", F.xxhash64("b", "a").alias("c")).agg(F.count_if("y").alias("bad"), F.count_if(~F.col("y")).alias("good"))
    per_word = per_context.groupBy("w").agg(
        F.count_if(F.col("bad") > 0).alias("contexts"), F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    sums = sample.agg(F.count_if("y").alias("bad"), F.count_if(~F.col("y")).alias("good")).first()
    ratio = ((F.col("bad") + 0.5) / (sums["bad"] + 1)) / ((F.col("good") + 0.5) / (sums["good"] + 1))
    terms = per_word.where((F.col("contexts") >= 10) & (ratio >= 20)).orderBy(F.desc("contexts"), "w").limit(MAX_TERMS)
    return [r["w"] for r in terms.collect()]


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """The lexicon and weights, or None without labelled texts of both classes."""
    sample = _labelled(docs, labels, key, text)
    terms = _lexicon(sample)
    reader = Reader(Automaton(tuple(terms)))
    # Words of harmless texts that resemble a term are no misspellings of it.
    looks = lambda b: {"w": [w for w, k in _resembling(reader, b) if k == 2]}
    harmless = by_slice(sample.where("not y"), "t", looks, "w string").distinct()  # of a bounded sample
    reader = Reader(reader.automaton, frozenset(r["w"] for r in harmless.collect()))

    def work(batch: pa.RecordBatch) -> dict:
        rows = reader.features(strings(batch.column("t")))
        return {"x": list(rows), "label": batch.column("y").cast(pa.int32()).cast(pa.float64())}

    points = by_slice(sample, "t", work, "x array<double>, label double").withColumn("features", array_to_vector("x"))
    if points.select("label").distinct().count() < 2:
        return None
    fitted = LogisticRegression(regParam=0.001, standardization=False).fit(points)
    weights = np.maximum(fitted.coefficients.toArray(), 0.0)
    weights[1] = max(weights[1], MISSPELLED_WEIGHT * weights[0])
    return Model(reader, weights, float(fitted.intercept))


def _resembling(reader: Reader, batch: pa.RecordBatch) -> list[tuple[str, int]]:
    _, bare, kind = reader.hits(strings(batch.column("t")))
    return [(bare[i], int(kind[i])) for i in np.flatnonzero(kind)]


def _scores(model: Model | None, column: pa.Array) -> np.ndarray:
    texts = strings(column)
    return np.zeros(len(texts)) if model is None else model.scores(texts)


def score(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of each row."""

    def work(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": _scores(model, batch.column("text"))}

    frame = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_slice(frame, "text", work, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, score double")


def keep(df: DataFrame, model: Model | None, text: str = "text", at: float = 0.5) -> DataFrame:
    """The rows that score below ``at``, columns unchanged."""
    return by_slice(df, text, lambda batch: batch.filter(pa.array(_scores(model, batch.column(text)) < at)), df.schema)
