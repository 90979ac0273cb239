"""Token sequences of fixed capacity, filled by harmonic packing.

Every document's ids are cut into pieces: as long as 1/16 of the capacity C or more is left, the
longest piece of length C // k that fits (k = 1, 2, ...); the rest is the last piece. A piece of
length n belongs to class k = C // n, whose sequences take k pieces each, so a worker places its
pieces by counting them, without looking at any other piece. The pieces of a class that do not
make up a sequence, fewer than k of them and so at most ``C * C`` in all whatever the input's size
(about 25,000 with C = 4096), are joined best fit first. A sequence is padded to C unless its length is a power of two.

Null text counts as empty and has the end id only. Rows with equal ids or texts are packed row by
row. An empty table gives an empty result; columns other than id and text are not carried along.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.text import released, slices, stored, strings
from tradewind.llm.tokens import Encoder

CAPACITY = 4096
END_ID = 2


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of ``n`` ids."""
    whole, rest = divmod(n, capacity)
    lengths = [capacity] * whole
    while rest >= capacity // 16:
        k = -(-capacity // rest)
        while capacity // k > rest or (k > 1 and capacity // (k - 1) <= rest):
            k += 1 if capacity // k > rest else -1
        lengths.append(capacity // k)
        rest -= capacity // k
    return [*lengths, rest] if rest else lengths


def pieces(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece; ``task`` and ``nth`` number the pieces of a class (``k``) within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        task = TaskContext.get().partitionId()
        made: Counter[int] = Counter()
        for batch in slices(batches, "text"):
            ids, counts = encoder.words(strings(batch.column("text")))
            ends = np.cumsum(counts)
            out: dict[str, list] = {name: [] for name in ("row", "start", "length", "ids_crc32", "doc_tokens", "k", "nth")}
            values = []
            for row, (end, count) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
                own = np.append(ids[end - count : end], np.uint32(END_ID)).astype("<u4")
                start = 0
                for length in cut(count + 1):
                    piece, k = own[start : start + length], CAPACITY // length
                    for name, value in zip(out, (row, start, length, zlib.crc32(piece.tobytes()), count + 1, k, made[k]), strict=True):
                        out[name].append(value)
                    if with_ids:
                        values.append(piece.astype(np.int32))
                    made[k] += 1
                    start += length
            columns = {"doc_id": batch.column("doc_id").take(pa.array(out.pop("row"), pa.int64()))}
            columns |= {name: pa.array(v, pa.int64()) for name, v in out.items()}
            columns["task"] = pa.array(np.full(len(out["k"]), task, np.int64))
            if with_ids:
                columns["ids"] = pa.array(values, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    frame = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, k long, nth long, task long"
    return frame.mapInArrow(released(run), schema + ", ids array<int>" * with_ids)


def _best_fit(rows: pd.DataFrame) -> pd.DataFrame:
    """Sequences of the pieces left over by all classes, longest piece first into the fullest sequence it fits."""
    rows = rows.sort_values(["length", "k", "place"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    room: list[tuple[int, int]] = []  # (room left, sequence), ascending
    sequences, offsets = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    made = 0
    for i, length in enumerate(rows["length"].tolist()):
        at = bisect.bisect_left(room, (length, -1))
        left, sequence = room.pop(at) if at < len(room) else (CAPACITY, made)
        made = max(made, sequence + 1)
        sequences[i], offsets[i] = sequence, CAPACITY - left
        if left > length:
            bisect.insort(room, (left - length, sequence))
    return rows.assign(sequence_id=rows["sequence_id"] + sequences, offset=offsets)


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    held = stored(pieces(df, tokenizer, key, text, with_ids), "pieces")
    per_task = held.groupBy("k", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("k").orderBy("task")) - F.col("n")
    per_task = per_task.select("k", "task", before.alias("before"))
    per_class = held.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("full", F.expr("n div k"))
    # One row for each k up to the capacity at most.
    starts = {r["k"]: (r["full"], r["n"]) for r in per_class.collect()}
    rows, first = [], 0
    for k in sorted(starts):
        rows.append((k, first, starts[k][0]))
        first += starts[k][0]
    classes = df.sparkSession.createDataFrame(rows, "k long, first long, full long")
    placed = held.join(per_task, ["k", "task"]).join(F.broadcast(classes), "k").withColumn("place", F.col("before") + F.col("nth"))
    placed = placed.withColumn("bin", F.expr("place div k")).drop("before", "nth", "task")
    full = placed.where(F.col("bin") < F.col("full")).withColumn("sequence_id", F.col("first") + F.col("bin"))
    in_order = Window.partitionBy("sequence_id").orderBy("place")
    full = full.withColumn("offset", F.sum("length").over(in_order) - F.col("length"))
    names = [*[c for c in held.columns if c not in ("k", "nth", "task")], "sequence_id", "offset"]
    rest = placed.where(F.col("bin") >= F.col("full")).withColumns({"sequence_id": F.lit(first).cast("long"), "offset": F.lit(0).cast("long")})
    rest = rest.groupBy().applyInPandas(_best_fit, rest.schema)
    return full.select(names).unionByName(rest.select(names))


def sequences(placed: DataFrame, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, its ``ids`` and how many of them are no padding; ``placed`` must carry ids."""
    own = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    own = own.select("sequence_id", F.flatten("p.ids").alias("ids")).withColumn("length", F.size("ids"))
    even = F.col("length").bitwiseAND(F.col("length") - 1) == 0
    padding = F.when(even, 0).otherwise(CAPACITY - F.col("length"))
    return own.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids"), "length")
