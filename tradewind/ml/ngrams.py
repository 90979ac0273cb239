"""N-grams counted and weighed Arrow batch by Arrow batch: the terms that ``functions.text`` lists as columns.

A text's terms, a dozen times its size, never become rows. Tasks send on sums over many texts, of bounded size.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tradewind.functions import text
from tradewind.functions.rules import c

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of it

BLOCKS = {"words": text.word_ngrams, "chars": text.char_ngrams}
SIZES = range(3, 6)
HELD_TERMS = 200_000  # a task sends its sums on when it holds so many
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SLICE_LETTERS = 1_000_000
COUNTED = "block string, term string, occurrences long, documents long, positive long"

# A character n-gram is a number: its letters (blank 0, a 1, ...) in base 27, after all shorter ones.
_FIRST = {n: sum(27**m for m in range(SIZES.start, n)) for n in range(SIZES.start, SIZES.stop + 1)}
_TEXT_BITS = 1 << 24  # more than there are such numbers


def slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of about a million letters: arrays of n-grams hold many numbers a letter."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_LETTERS:
            yield slice(start, i)
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def word_terms(clean: str) -> list[str]:
    tokens = [w for w in clean.split(" ") if len(w) >= 2]
    return tokens + [f"{a} {b}" for a, b in pairwise(tokens)]


def gram_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of a text, the number of an n-gram in it and its occurrences there, in that order; texts hold a to z and blanks."""
    letters = np.frombuffer((" " + "  ".join(texts) + " ").encode(), np.uint8)
    blank = letters == 32
    if not (blank | ((letters >= 97) & (letters <= 122))).all():
        raise ValueError("clean texts hold only a to z and blanks")
    digits = np.where(blank, 0, letters.astype(np.int64) - 96)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts]).astype(np.int64) * _TEXT_BITS
    found = []
    for n in SIZES:
        starts = len(letters) - n + 1
        if starts < 1:
            continue
        inside = np.ones(starts, bool)
        for i in range(1, n - 1):
            inside &= ~blank[i : i + starts]
        at = np.flatnonzero(inside)
        number = np.full(len(at), _FIRST[n], np.int64)
        for i in range(n):
            number += digits[at + i] * 27 ** (n - 1 - i)
        found.append(owner[at] + number)
    each, n = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
    return each // _TEXT_BITS, each % _TEXT_BITS, n


def gram_terms(numbers: np.ndarray) -> list[str]:
    """The n-grams of sorted numbers."""
    terms = []
    for n in SIZES:
        low, high = np.searchsorted(numbers, [_FIRST[n], _FIRST[n + 1]])
        rest = numbers[low:high] - _FIRST[n]
        letters = np.stack([rest // 27 ** (n - 1 - i) % 27 for i in range(n)], 1)
        plain = np.where(letters == 0, 32, letters + 96).astype(np.uint8)
        terms += [x.decode() for x in np.ascontiguousarray(plain).view(f"S{n}").ravel()]
    return terms


def gram_number(term: str) -> int:
    number = 0
    for x in term:
        number = number * 27 + (0 if x == " " else ord(x) - 96)
    return number + _FIRST[len(term)]


class WordSums:
    """Occurrences, texts and texts with label 1 of each word and pair since the last sending."""

    def __init__(self):
        self.sums = [Counter(), Counter(), Counter()]

    def add(self, texts: list[str], positive: list[bool]) -> None:
        occurrences, documents, liked = self.sums
        for clean, good in zip(texts, positive, strict=True):
            terms = word_terms(clean)
            occurrences.update(terms)
            each = set(terms)
            documents.update(each)
            if good:
                liked.update(each)

    def __len__(self) -> int:
        return len(self.sums[1])

    def rows(self) -> pa.RecordBatch:
        terms = list(self.sums[1])
        rows = _counted("words", terms, *[[x[t] for t in terms] for x in self.sums])
        self.__init__()
        return rows


class GramSums:
    """The same of each character n-gram."""

    def __init__(self):
        self.numbers, self.sums = np.zeros(0, np.int64), np.zeros((3, 0), np.int64)

    def add(self, texts: list[str], positive: list[bool]) -> None:
        place, numbers, n = gram_numbers(texts)
        new = np.stack([n, np.ones(len(n), np.int64), np.array(positive, np.int64)[place]])
        self.numbers, at = np.unique(np.concatenate([self.numbers, numbers]), return_inverse=True)
        both = np.concatenate([self.sums, new], 1)
        self.sums = np.stack([np.bincount(at, row, len(self.numbers)).astype(np.int64) for row in both])

    def __len__(self) -> int:
        return len(self.numbers)

    def rows(self) -> pa.RecordBatch:
        rows = _counted("chars", gram_terms(self.numbers), *self.sums)
        self.__init__()
        return rows


def _counted(block: str, terms: list[str], *sums) -> pa.RecordBatch:
    columns = [pa.repeat(block, len(terms)), pa.array(terms, pa.string()), *[pa.array(x, pa.int64()) for x in sums]]
    return pa.record_batch(columns, names=["block", "term", "occurrences", "documents", "positive"])


def _counter(blocks: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [{"words": WordSums, "chars": GramSums}[b]() for b in blocks]
        for batch in batches:
            rows = [(t, p is True) for t, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if t]
            if not rows:
                continue
            texts, positive = map(list, zip(*rows, strict=True))
            for some in slices(texts):
                for sums in held:
                    sums.add(texts[some], positive[some])
                    if len(sums) > HELD_TERMS:
                        yield sums.rows()
        for sums in held:
            if len(sums):
                yield sums.rows()

    return count


def counts(texts: DataFrame, key: str, blocks: tuple[str, ...] = tuple(BLOCKS)) -> DataFrame:
    """Parts of ``occurrences``, ``documents`` (values of ``key``) and ``positive`` (those with ``label`` 1, if there are
    labels) of each block's terms, to be summed. ``texts`` has ``key`` and ``clean_text``.

    Rows that share a key are one document: they are rare, found by their key alone, and counted as rows.
    """
    texts.sparkSession.conf.set(BATCH_BYTES, "4m")
    positive = (c("label") == 1.0) if "label" in texts.columns else F.lit(False)
    texts = texts.select(c(key).alias("_key"), "clean_text", positive.alias("_positive"))
    shared = texts.groupBy("_key").agg(F.count("*").alias("_rows")).filter("_rows > 1").select(c("_key").alias("_shared"))
    if shared.isEmpty():
        return texts.select("clean_text", "_positive").mapInArrow(_counter(blocks), COUNTED)
    same = c("_key").eqNullSafe(c("_shared"))
    alone = texts.join(shared, same, "left_anti").select("clean_text", "_positive")
    # A broadcast or hash join by a null-safe key, so copies of one key meet as rows of terms, thinned before they move.
    grams = F.concat(*[F.transform(BLOCKS[b](c("clean_text")), _named(b)) for b in blocks])
    each = texts.join(shared, same, "left_semi").select("_key", "_positive", F.explode(grams).alias("t"))
    summed = each.groupBy("_key", "t").agg(F.count("*").alias("n"), F.max("_positive").alias("_positive"))
    rows = summed.select("t.block", "t.term", c("n").alias("occurrences"), F.lit(1).cast("long").alias("documents"), F.coalesce(c("_positive").cast("long"), F.lit(0)).alias("positive"))
    return alone.mapInArrow(_counter(blocks), COUNTED).union(rows)


def _named(block: str):
    return lambda term: F.struct(F.lit(block).alias("block"), term.alias("term"))


def summed(parts: DataFrame) -> DataFrame:
    """One row per block and term of ``counts``."""
    return parts.groupBy("block", "term").agg(*[F.sum(x).alias(x) for x in ("occurrences", "documents", "positive")])


class Vocabulary:
    """Places and inverse document frequencies of bounded many terms; places below ``first_char`` are of the word block."""

    def __init__(self, rows: list, first_char: int, size: int):
        self.words = {r["term"]: r["index"] for r in rows if r["block"] == "words"}
        grams = sorted((gram_number(r["term"]), r["index"]) for r in rows if r["block"] == "chars")
        self.numbers = np.array([g[0] for g in grams], np.int64)
        self.places = np.array([g[1] for g in grams], np.int64)
        self.idf = np.zeros(size)
        for r in rows:
            self.idf[r["index"]] = r["idf"]
        self.first_char, self.size = first_char, size

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths of the vectors of the texts, and all their places and values."""
        held = [Counter(self.words[t] for t in word_terms(x) if t in self.words) for x in texts]
        owner, number, n = gram_numbers(texts)
        if len(self.numbers):
            near = np.minimum(np.searchsorted(self.numbers, number), len(self.numbers) - 1)
            known = self.numbers[near] == number
            owner, place, n = owner[known], self.places[near[known]], n[known]
        else:
            owner, place, n = owner[:0], owner[:0], n[:0]
        owner = np.concatenate([np.repeat(np.arange(len(texts)), [len(h) for h in held]), owner])
        place = np.concatenate([np.array([p for h in held for p in h], np.int64), place])
        n = np.concatenate([np.array([k for h in held for k in h.values()], np.int64), n])
        order = np.argsort(owner * self.size + place)
        owner, place, n = owner[order], place[order], n[order]
        values = (np.log(n) + 1.0) * self.idf[place]
        part = 2 * owner + (place >= self.first_char)
        values /= np.sqrt(np.bincount(part, values * values, 2 * len(texts)))[part]
        return np.bincount(owner, minlength=len(texts)), place, values


def vectors(texts: DataFrame, words: DataFrame, first_char: int, size: int) -> DataFrame:
    """``texts`` without ``clean_text`` but with ``features``, laid out as the stored form of a sparse vector."""
    texts.sparkSession.conf.set(BATCH_BYTES, "4m")
    vocabulary = Vocabulary(words.select("block", "term", "index", "idf").collect(), first_char, size)
    kept = [f for f in texts.schema.fields if f.name != "clean_text"]
    vector = T.StructType().add("type", T.ByteType()).add("size", T.IntegerType())
    vector = vector.add("indices", T.ArrayType(T.IntegerType())).add("values", T.ArrayType(T.DoubleType()))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("clean_text").to_pylist()]
            for some in slices(texts):
                lengths, places, values = vocabulary.vectors(texts[some])
                rows, ends = len(lengths), np.cumsum(np.concatenate([[0], lengths]), dtype=np.int32)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (places.astype(np.int32), values)]
                head = [pa.repeat(pa.scalar(0, pa.int8()), rows), pa.repeat(pa.scalar(size, pa.int32()), rows)]
                struct = pa.StructArray.from_arrays([*head, *lists], ["type", "size", "indices", "values"])
                others = [batch.column(f.name).slice(some.start, rows) for f in kept]
                yield pa.record_batch([*others, struct], names=[*[f.name for f in kept], "features"])

    return texts.mapInArrow(weigh, T.StructType([*kept, T.StructField("features", vector)]))


def summed_weights(texts: DataFrame, weights: dict[str, int], name: str) -> DataFrame:
    """``texts`` without ``clean_text`` but with ``name``: the sum of the integer weights of the distinct words and pairs of each."""
    texts.sparkSession.conf.set(BATCH_BYTES, "4m")
    kept = [f for f in texts.schema.fields if f.name != "clean_text"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [sum(weights.get(t, 0) for t in set(word_terms(x.as_py() or ""))) for x in batch.column("clean_text")]
            yield pa.record_batch([*[batch.column(f.name) for f in kept], pa.array(sums, pa.int64())], names=[*[f.name for f in kept], name])

    return texts.mapInArrow(weigh, T.StructType([*kept, T.StructField(name, T.LongType())]))


def products(featured: DataFrame, weights: dict[int, float], size: int, name: str) -> DataFrame:
    """``featured`` without ``features`` but with ``name``: the product of each vector and the weights."""
    featured.sparkSession.conf.set(BATCH_BYTES, "4m")
    kept = [f for f in featured.schema.fields if f.name != "features"]
    dense = np.zeros(size)
    dense[list(weights)] = list(weights.values())

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [
                float(np.dot(dense[np.asarray(v["indices"].values)], np.asarray(v["values"].values))) if len(v["indices"]) else 0.0
                for v in batch.column("features")
            ]
            yield pa.record_batch([*[batch.column(f.name) for f in kept], pa.array(sums, pa.float64())], names=[*[f.name for f in kept], name])

    return featured.mapInArrow(multiply, T.StructType([*kept, T.StructField(name, T.DoubleType())]))
