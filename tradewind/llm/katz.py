"""A Katz backoff model of any order: Good-Turing discounts, exactly normalised backoff weights.

Tokens are lower-cased words and one end per text. Every training word is a class of its own; words
not seen in training share one more class. With r the count of class c after h, a context of up to
``order`` - 1 tokens, and h' the context without its first token,

    P(c | h) = discount(r) * r / count(h)     if r > 0
    P(c | h) = backoff(h) * P(c | h')         otherwise

where P(c) without a context is the add-one share of the class, discounts for r up to ``DISCOUNTED``
follow Good and Turing for each order, and backoff(h) gives what the discounts left to the classes
never seen after h. A context whose counts are all too high to be discounted sets one count aside;
one that was followed by every class is scaled to sum to 1. So probabilities after any context sum
to 1 over all words. A ``vocabulary`` may be given to keep only the commonest words as classes, in
whole count levels; all others then share the last class, each with its add-one share in it.

Words and n-grams are known by 64-bit hashes, an n-gram by the hash of its context and of its last
n - 1 tokens. Counts, contexts and weights are tables that are joined by hash, with crowded keys
split; no task holds a table of the vocabulary unless Spark measures it small enough to send. The
logarithm of P is a sum over the n-grams that end at a token: of a seen one its correction to the
probability by the shorter context, and of a context its backoff weight. So one table of values
by hash and one sum by text give the scores.

Null text counts as empty and is one end. Rows are scored one by one, whatever their ids; a null id
hashes as empty text. An empty table gives an empty result; without training rows every text gets
the model of no counts. Ids must be whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.hashing import hash64
from tradewind.llm.text import Words, light, released, slices, stored, strings
from tradewind.session import discard, split_crowded_keys

VOCABULARY = math.inf
ORDER = 2
DISCOUNTED = 5
HEAVY = 65_536  # words whose values go to every task
START, END, OTHER = (np.int64(0x5AFE0000_0000_0000 + i) for i in range(3))


def mixed(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64(context, suffix)``."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    h = np.full(len(suffix), 42, np.uint64)
    for values in (context, suffix):
        h = (h + p5 + np.uint64(8)) ^ (turned(values.view(np.uint64) * p2, 31) * p1)
        h = turned(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def starts(order: int) -> list[np.int64]:
    """Contexts of 1 to ``order`` - 1 starts."""
    found = [START]
    while len(found) < order - 1:
        last = np.array(found[-1:])
        found.append(mixed(last, last)[0])
    return found


@dataclass
class Texts:
    """Texts as hashes. ``own`` are their words, ``owner`` the text of each; ``tokens`` the classes of words
    and ends, ``at`` the text of each."""

    own: np.ndarray
    owner: np.ndarray
    tokens: np.ndarray
    at: np.ndarray
    first: np.ndarray  # place in ``tokens`` where each text begins

    @classmethod
    def of(cls, texts: pa.Array, common: np.ndarray | None) -> Texts:
        words = Words.of(texts, lower=True)
        own = hash64(words.vocabulary).view(np.int64)[words.codes]
        classes = own if common is None else np.where(np.isin(own, common), own, OTHER)
        tokens = np.insert(classes, np.cumsum(words.counts), END)  # an end after each text's words
        sizes = words.counts + 1
        return cls(own, words.owner, tokens, np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes)

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For 2 to ``order``: context, last tokens but one fewer, and hash of the n-gram ending at each token."""
        suffix = self.tokens
        for start in starts(order):
            context = np.empty_like(suffix)
            context[1:] = suffix[:-1]
            context[self.first] = start
            gram = mixed(context, suffix)
            yield context, suffix, gram
            suffix = gram


def counted(docs: DataFrame, order: int, common: np.ndarray | None) -> DataFrame:
    """``context``, ``suffix`` and count ``n`` of the training n-grams; words if ``order`` is 1, by ``suffix``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = Texts.of(strings(batch.filter(batch.column("train")).column("text")), common)
            if order == 1:
                suffix, n = np.unique(texts.own, return_counts=True)
                yield pa.RecordBatch.from_pydict({"suffix": suffix, "n": n})
            elif len(texts.tokens):
                *_, (context, suffix, gram) = texts.grams(order)
                _, place, n = np.unique(gram, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({"context": context[place], "suffix": suffix[place], "n": n})

    keys = ["suffix"] if order == 1 else ["context", "suffix"]
    rows = docs.mapInArrow(released(count), "".join(f"{k} long, " for k in keys) + "n long")
    return stored(rows.groupBy(*keys).agg(F.sum("n").alias("n")), f"grams-{order}")


def discounts(types: dict[int, int]) -> np.ndarray:
    """Good-Turing factors for counts 1 to ``DISCOUNTED`` (at 0: for higher ones, undiscounted), from numbers of pairs by count.

    Where these are too few to give a factor between 0 and 1, half a count is taken off instead."""
    n = [types.get(r, 0) for r in range(DISCOUNTED + 2)]
    out = np.ones(DISCOUNTED + 1)
    rest = (DISCOUNTED + 1) * n[-1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        factor = ((r + 1) * n[r + 1] / (n[r] * r) - rest) / (1 - rest) if n[r] and rest != 1 else 0.0
        out[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return out


@dataclass
class Model:
    """``values`` by hash: ``v``, for the score, and of words ``b``, for the base. What is the same for all texts or
    words is added besides."""

    values: DataFrame
    heavy: tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, ``v`` and ``b`` of the commonest words, by id
    common: np.ndarray | None
    total: int  # training tokens
    ends: int  # training texts
    per_word: tuple[float, float]  # score and base of each word besides its values
    per_text: tuple[float, float]


def commonest(words: DataFrame, vocabulary: float) -> DataFrame:
    """The commonest words, in whole count levels, at most ``vocabulary``."""
    sizes = {r["n"]: r["count"] for r in words.groupBy("n").count().collect()}
    least, kept = max(sizes, default=0) + 1, 0
    for r in sorted(sizes, reverse=True):
        if kept + sizes[r] > vocabulary:
            break
        least, kept = r, kept + sizes[r]
    return words.where(F.col("n") >= least)


def fit(docs: DataFrame, order: int = ORDER, vocabulary: float = VOCABULARY) -> Model:
    """The model from rows of ``docs`` with ``train``."""
    spark = docs.sparkSession
    words = counted(docs, 1, None)
    sums = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_words, different, texts = sums[0] or 0, sums[1], docs.where("train").count()
    total = n_words + texts
    classes, common, rare = words, None, (0, 0)
    if different > vocabulary:
        classes = commonest(words, vocabulary)
        common = classes.select("suffix").toArrow().column(0).to_numpy()
        kept = classes.agg(F.sum("n")).first()[0] or 0
        rare = n_words - kept, different - len(common)
    shares = total + different - rare[1] + 2
    single = spark.createDataFrame([(int(END), texts), (int(OTHER), rare[0])], "suffix long, n long").union(classes)
    lower = stored(single.select(F.col("suffix").alias("id"), ((F.col("n") + 1) / shares).alias("p")), "shares")
    own = words.select(F.col("suffix").alias("id"), F.log10(F.col("n") + 1).alias("v"), F.log10(F.col("n") + 1).alias("b"))
    if common is not None:
        inside = math.log10((rare[0] + 1) / (sum(rare) + 1))
        own = own.union(spark.createDataFrame([(int(OTHER), inside, None)], "id long, v double, b double"))

    opening, parts, used = 0.0, [], [words, lower]
    for k, start in enumerate(starts(order), 2):
        grams = counted(docs, k, common)
        n = F.col("n")
        types = {r["n"]: r["count"] for r in grams.where(n <= DISCOUNTED + 1).groupBy("n").count().collect()}
        factors = F.array(*[F.lit(float(x)) for x in discounts(types)])
        gained = F.element_at(factors, F.when(n <= DISCOUNTED, n).otherwise(0).cast("int") + 1) * n
        priced = stored(grams.join(light(lower), grams["suffix"] == lower["id"]).select("context", "suffix", "n", gained.alias("g"), "p"), "priced")
        discard(grams)
        mass = priced.groupBy("context").agg(F.sum("n").alias("all"), F.sum("g").alias("s"), F.sum("p").alias("u"))
        left, free, held = 1 - F.col("s") / F.col("all"), 1 - F.col("u"), F.col("all")
        full = free <= 1e-9  # every class has followed
        bare = left <= 1e-9  # nothing was discounted
        contexts = stored(mass.select(
            F.col("context").alias("id"),
            (F.when(full, held / F.col("s")).when(bare, held / (held + 1)).otherwise(1.0) / held).alias("scale"),
            F.when(full, 0.0).when(bare, -F.log10(held + 1) - F.log10(free)).otherwise(F.log10(left) - F.log10(free)).alias("backoff"),
        ), "contexts")
        opening += sum(r["backoff"] for r in contexts.where(F.col("id") == int(start)).collect())
        used += [priced, contexts]
        weights = contexts.select("id", F.col("backoff").alias("v"), F.lit(None).cast("double").alias("b"))
        parts.append(own.union(weights).groupBy("id").agg(F.sum("v").alias("v"), F.sum("b").alias("b")))
        p = F.col("g") * F.col("scale")
        named = priced.join(light(contexts), priced["context"] == contexts["id"]).select(F.xxhash64("context", "suffix").alias("id"), p.alias("p"), (F.log10(p) - F.col("backoff") - F.log10("p")).alias("more"))
        if k < order:
            named = stored(named, "named")
            used.append(named)
            lower = named.select("id", "p")
        own = named.select("id", F.col("more").alias("v"), F.lit(None).cast("double").alias("b"))
    values = own
    for part in parts:
        values = values.union(part)
    values = stored(values, "values")
    often = values.join(F.broadcast(commonest(words, HEAVY).select(F.col("suffix").alias("id"))), "id").toArrow().sort_by("id")
    heavy = tuple(often.column(x).to_numpy() for x in ("id", "v", "b"))
    discard(*used)
    smallest = -math.log10(shares)
    base = -math.log10(total + different + (texts > 0) + 1)
    end = math.log10(texts + 1)
    return Model(values, heavy, common, total, texts, (smallest, base), (end + smallest + opening, end + base))


def score(docs: DataFrame, model: Model, order: int = ORDER) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of each row."""
    common, (often, v, b) = model.common, model.heavy

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every hash in a text, once, and how often; below zero for words. Of the commonest words, whose values are at
        hand, only sums: a row a text, with ``known`` and an id that serves to deal it out."""
        for batch in slices(batches, "text"):
            texts = Texts.of(strings(batch.column("text")), common)
            sets = [(texts.own, texts.owner, -1), *((gram, texts.at, 1) for _, _, gram in texts.grams(order))]
            if common is not None:
                rare = np.flatnonzero(texts.tokens == OTHER)
                sets.append((texts.tokens[rare], texts.at[rare], 1))
            for ids, owner, sign in sets:
                by = np.lexsort((ids, owner))
                ids, owner = ids[by], owner[by]
                new = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])][: len(ids)])
                times = np.diff(np.r_[new, len(ids)]) * sign
                ids, owner = ids[new], owner[new]
                if sign < 0 and len(often):
                    at = np.minimum(np.searchsorted(often, ids), len(often) - 1)
                    here = often[at] == ids
                    at, whose, n = at[here], owner[here], -times[here]
                    total = lambda x: np.bincount(whose, x, len(texts.first))  # noqa: E731, B023
                    words = total(n).astype(np.int32)
                    rows = batch.column("row")
                    yield pa.RecordBatch.from_pydict({"row": rows, "doc_id": batch.column("doc_id"), "id": rows, "times": -words, "known": words, "v": total(n * v[at]), "b": total(n * b[at])})
                    ids, owner, times = ids[~here], owner[~here], times[~here]
                place, nothing = pa.array(owner), len(ids)
                yield pa.RecordBatch.from_pydict({"row": batch.column("row").take(place), "doc_id": batch.column("doc_id").take(place), "id": ids, "times": times.astype(np.int32), **{x: pa.nulls(nothing, kind) for x, kind in (("known", pa.int32()), ("v", pa.float64()), ("b", pa.float64()))}})

    asked = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(released(ask), "row long, doc_id long, id long, times int, known int, v double, b double")
    values = model.values.select("id", F.col("v").alias("_v"), F.col("b").alias("_b"))
    here = F.col("known").isNotNull()
    sums = asked.join(values, "id", "left").groupBy("row", "doc_id").agg(
        F.sum(F.when(F.col("times") < 0, -F.col("times")).otherwise(0)).alias("words"),
        F.sum(F.when(here, F.col("known")).when((F.col("times") < 0) & F.col("_b").isNotNull(), -F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.when(here, F.col("v")).otherwise(F.abs("times") * F.col("_v"))).alias("v"),
        F.sum(F.when(here, F.col("b")).otherwise(F.abs("times") * F.col("_b"))).alias("b"),
    )
    summed = lambda name, i: F.coalesce(F.col(name), F.lit(0.0)) + F.col("words") * model.per_word[i] + model.per_text[i]
    return sums.select(
        "doc_id", (F.col("words") + 1).alias("n_tokens"), (F.col("known") + int(model.ends > 0)).alias("n_known"),
        summed("b", 1).alias("base_score"), summed("v", 0).alias("score"),
    )


def score_texts(df: DataFrame, modulus: int = 7, remainder: int = 2, key: str = "doc_id", text: str = "text", vocabulary: float = VOCABULARY, order: int = ORDER) -> DataFrame:
    """Scores of all rows by a model of those whose crc32(id as text) modulo ``modulus`` is not ``remainder``."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    split_crowded_keys(df.sparkSession)
    out = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus == remainder
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), (~out).alias("train"))
    model = fit(docs, order, vocabulary)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus == remainder
    return score(docs, model, order).withColumns({"held_out": held, "train_tokens": F.lit(model.total).cast("long")})
