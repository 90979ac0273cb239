"""Quality of texts by how much better a dictionary of good text compresses them than one of bad text.

Two zstandard dictionaries are built from labelled texts, one from each label. A text is compressed
with both, in pieces of ``PIECE`` bytes so that the dictionary counts for all of it; the difference of
the sizes over their sum tells which label it is like. Logistic regression on that difference, the
text's length and their product makes it a probability. It is fitted on texts that the dictionaries
have not seen: two more pairs are built from one half of the labelled texts each (equal texts are in
the same half) and applied to the other half.

Fitted on a bounded sample of labelled rows, about ``TEXTS`` of each label, chosen by hash: ids first, so that
no other text is moved, then rows where ids repeat. Of their chunks of ``CHUNK`` bytes at most ``CHUNKS`` go
into a dictionary; the regression sees every sampled text.
Where a label has too little text for the library to build a dictionary, its text itself is one.

Null text counts as empty and is scored by length like any other. Rows are scored one by one, equal
texts alike, whatever their ids. A labelled id with both labels teaches nothing, nor does a null label.
With labels of one kind or none every text gets the smoothed share of good labels (one half without
any). An empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import by_slice, released, remainder, slices, stored, strings

SIZE, LEVEL = 112_640, 3
PIECE, CHUNK = 512, 2048
CHUNKS, TEXTS = 4000, 10_000
HALVES, WHOLE = 2, 2  # numbers of the models: one for each half, and that of all texts


def built(texts: list[bytes]) -> bytes:
    """A dictionary of the texts."""
    import zstandard

    try:
        return zstandard.train_dictionary(SIZE, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text
        return b"".join(texts)[-SIZE:]


class Sizes:
    """Compressed sizes with the dictionaries of bad and of good text."""

    def __init__(self, bad: bytes, good: bytes):
        import zstandard

        self.compressors = []
        for block in (bad, good):
            held = zstandard.ZstdCompressionDict(block) if block else None
            if held is not None:
                held.precompute_compress(level=LEVEL)
            plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, **plain))

    def difference(self, text: bytes) -> float:
        """(bad - good) / (bad + good)."""
        pieces = [text[i : i + PIECE] for i in range(0, max(len(text), 1), PIECE)]
        bad, good = (sum(len(c.compress(p)) for p in pieces) for c in self.compressors)
        return (bad - good) / (bad + good)


@dataclass(frozen=True)
class Model:
    dictionaries: dict[int, tuple[bytes, bytes]]
    weights: tuple[float, ...] | None
    share: float  # of good labels, for want of a model


def described(difference: np.ndarray, length: np.ndarray) -> np.ndarray:
    size = np.log1p(length) / 10
    return np.stack([np.ones_like(difference), difference * 10, size, difference * 10 * size], axis=1)


def probability(weights: tuple[float, ...], difference: np.ndarray, length: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(described(difference, length) @ np.array(weights), -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01, rounds: int = 60) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's steps, the intercept free of the penalty."""
    held = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ held, -30, 30)))
        slope = x.T @ (weight * (y - p)) - penalty * held
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        held = held + step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return tuple(held.tolist())


def sampled(rows: DataFrame, per_group: int, *groups: str) -> DataFrame:
    """About ``per_group`` rows of each group by ``rank``, a hash, or all if there are fewer."""
    sizes = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    kept = rows.join(F.broadcast(sizes), list(groups))  # a row for each label (and half)
    chance = F.pmod(F.xxhash64("rank"), F.lit(1 << 32)) < F.lit(float(1 << 32)) * per_group / F.col("n")
    return kept.where(chance)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        places, texts = [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            data = text.encode()
            own = [data[j : j + CHUNK] for j in range(0, len(data), CHUNK)]
            places += [i] * len(own)
            texts += own
        at = pa.array(places, pa.int64())
        order = np.concatenate([np.arange(n) for n in np.bincount(places, minlength=batch.num_rows)] or [np.empty(0, int)]) if places else np.empty(0, np.int64)
        yield pa.RecordBatch.from_pydict({"label": batch.column("label").take(at), "half": batch.column("half").take(at), "rank": pa.array(batch.column("rank").take(at).to_numpy() + order.astype(np.int64) * 7919), "chunk": pa.array(texts, pa.binary())})


def _trained(group: pa.Table) -> pa.Table:
    ordered = group.sort_by([("rank", "ascending"), ("chunk", "ascending")]).slice(0, CHUNKS)
    block = built(ordered.column("chunk").to_pylist())
    return pa.table({"model": group.column("model")[:1], "label": group.column("label")[:1], "block": pa.array([block], pa.binary())})


def learn(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model from the rows of ``df`` that ``labels`` (the same key, 0 or 1 in ``label``) covers."""
    known = labels.groupBy(F.col(key).alias("doc_id")).agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other AND label IN (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    docs = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    labelled = stored(docs.select("doc_id").distinct().join(known, "doc_id"), "known")
    ids = sampled(labelled.withColumn("rank", F.xxhash64("doc_id")), TEXTS, "label").select("doc_id", "label")
    ids = F.broadcast(stored(ids, "ids"))  # about 2 * TEXTS ids
    counts = {r["label"]: r["count"] for r in docs.select("doc_id").join(ids, "doc_id").groupBy("label").count().collect()}
    half = F.pmod(F.xxhash64("text"), F.lit(HALVES)).cast("int")
    rows = docs.join(ids, "doc_id").select("label", half.alias("half"), F.xxhash64("doc_id", "text").alias("rank"), "text")
    chance = F.when(F.col("label") == 1, TEXTS / counts.get(1, 1)).otherwise(TEXTS / counts.get(0, 1))
    rows = stored(rows.where(F.pmod(F.xxhash64("rank"), F.lit(1 << 32)) < chance * float(1 << 32)), "labelled")
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    if len(counts) < 2:
        return Model({}, None, share)
    chunks = rows.mapInArrow(released(_chunks), "label int, half int, rank long, chunk binary")
    chunks = stored(sampled(chunks, CHUNKS // HALVES, "label", "half"), "sample")
    each = chunks.select(F.explode(F.array(F.col("half"), F.lit(WHOLE))).alias("model"), "label", "rank", "chunk")
    blocks = {(r["model"], r["label"]): bytes(r["block"]) for r in each.groupBy("model", "label").applyInArrow(_trained, "model int, label int, block binary").collect()}
    models = range(HALVES + 1)
    dictionaries = {m: (blocks.get((m, 0), b""), blocks.get((m, 1), b"")) for m in models}

    def measure(batch: pa.RecordBatch) -> dict:
        sizes = {h: Sizes(*dictionaries[1 - h]) for h in range(HALVES)}
        data = [t.encode() for t in batch.column("text").to_pylist()]
        found = [sizes[h].difference(t) for h, t in zip(batch.column("half").to_pylist(), data, strict=True)]
        return {"label": batch.column("label"), "difference": found, "length": pa.array([len(t) for t in data], pa.int64())}

    told = by_slice(rows, "text", measure, "label int, difference double, length long").toArrow()
    y, difference, length = (told.column(c).to_numpy() for c in ("label", "difference", "length"))
    order = np.lexsort((length, difference, y))  # so that sums do not change with the tasks
    y, difference, length = y[order], difference[order], length[order]
    seen = np.bincount(y, minlength=2)
    weight = np.array([counts[v] / max(int(seen[v]), 1) for v in (0, 1)])[y]
    return Model({WHOLE: dictionaries[WHOLE]}, logistic(described(difference, length), y.astype(float), weight), share)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``difference`` and ``score`` (the probability of a good text) of each row."""
    weights, share = model.weights, model.share
    bad, good = model.dictionaries.get(WHOLE, (b"", b""))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(bad, good)
        for batch in slices(batches, "text"):
            data = [t.encode() for t in strings(batch.column("text")).to_pylist()]
            if weights is None:
                difference, found = np.zeros(len(data)), np.full(len(data), share)
            else:
                difference = np.array([sizes.difference(t) for t in data])
                found = probability(weights, difference, np.array([len(t) for t in data]))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "difference": difference, "score": found})

    docs = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return docs.mapInArrow(released(work), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, difference double, score double")


def score_texts(df: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Scores of all rows by a model of labelled rows whose crc32(id as text) modulo ``modulus`` is not ``held``."""
    model = learn(df.where(remainder(key, modulus) != held), labels, key, text, label)
    return score(df, model, key, text).select(
        "doc_id", (remainder("doc_id", modulus) == held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "difference"
    )
