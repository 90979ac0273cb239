"""Near copies among embeddings: sign hashing in several tables, exact cosines, connected components.

A table's hash is the signs of dot products with random hyperplanes. Vectors are compared only if
their labels and lengths are equal and they share a bucket of some table; a pair that shares
several counts in the first of them, so no list of pairs is needed to count each once. A task gives
back how many links each vector has in a bucket and one link to the smallest row that it reaches
there, which is all that components need. A bucket of more than ``BLOCK`` vectors is split into
blocks, and every two of them are compared in a task of their own, so nothing in it is skipped.

The number of planes follows the number of rows, the number of tables the planes: two vectors at
the threshold share a bucket with probability ``RECALL`` at least, closer ones more surely.

Vectors that are null, zero, or hold a null or a number that is not finite, and those without a
label, link with nothing. Rows with equal ids are vectors of their own. A component's id is the
smallest id among its rows. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import components, forest
from tradewind.llm.text import light, stored

THRESHOLD = 0.93
RECALL = 0.9995
PER_BUCKET = 32
BLOCK = 2048


def layout(rows: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Planes in a table, and tables."""
    planes = min(max(4, math.ceil(math.log2(max(rows, 1) / PER_BUCKET))), 48)
    same = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(1 - recall) / math.log(1 - same))


def _hashed(batches: Iterator[pa.RecordBatch], planes: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Rows with a usable vector: ``row``, ``label``, ``size``, the vector's bytes and its bucket in each table."""
    normals: dict[int, np.ndarray] = {}
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        first = np.cumsum(sizes) - sizes
        for size in np.unique(sizes[sizes > 0]).tolist():
            at = np.flatnonzero(sizes == size)
            vectors = values[first[at, None] + np.arange(size)]
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            usable = np.isfinite(norms) & (norms > 0)
            at, vectors = at[usable], vectors[usable]
            if size not in normals:
                normals[size] = np.random.default_rng(size).standard_normal((size, planes * tables))
            signs = (vectors @ normals[size] >= 0).reshape(len(at), tables, planes)
            buckets = signs @ (1 << np.arange(planes, dtype=np.int64))
            yield pa.RecordBatch.from_pydict({
                "row": batch.column("row").take(pa.array(at)), "label": batch.column("label").take(pa.array(at)), "size": np.full(len(at), size, np.int64),
                "vector": pa.array([v.tobytes() for v in vectors.astype(np.float32)], pa.binary()) if lists.type.value_type == pa.float32() else pa.array([v.tobytes() for v in vectors], pa.binary()),
                "buckets": pa.array(list(buckets), pa.list_(pa.int64())),
            })


def _compared(batches: Iterator[pa.RecordBatch], kind: type, threshold: float) -> Iterator[pa.RecordBatch]:
    """For rows sorted by ``key``: links of each row within its key, and the smallest row that it reaches there."""

    def links(rows: np.ndarray, sides: np.ndarray, cross: bool, vectors: np.ndarray, table: int, buckets: np.ndarray) -> dict | None:
        a = np.flatnonzero(sides == sides.min()) if cross else np.arange(len(rows))
        b = np.flatnonzero(sides == sides.max()) if cross else a
        near = vectors[a] @ vectors[b].T >= threshold
        if not cross:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        i, j = a[i], b[j]
        if table:
            new = ~(buckets[i, :table] == buckets[j, :table]).any(axis=1)
            i, j = i[new], j[new]
        if not len(i):
            return None
        counts = np.bincount(i, minlength=len(rows)) + np.bincount(j, minlength=len(rows))
        node, root = forest(rows[i], rows[j])
        own = dict(zip(rows.tolist(), counts.tolist(), strict=True))
        return {"row": node, "root": root, "n": np.array([own[x] for x in node.tolist()], np.int64)}

    def groups(table: pa.Table) -> Iterator[dict]:
        keys = np.column_stack([table.column(c).to_numpy() for c in ("key", "i", "j", "table", "bucket", "label", "size")])
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
        rows, sides = table.column("row").to_numpy(), table.column("side").to_numpy()
        columns = table.select(["vector", "buckets"]).combine_chunks()
        raw, hashes = columns.column("vector"), columns.column("buckets")
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            if b - a < 2:
                continue
            vectors = np.frombuffer(b"".join(raw.slice(a, b - a).to_pylist()), kind).reshape(b - a, -1).astype(np.float64)
            vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
            buckets = np.array(hashes.slice(a, b - a).to_pylist(), np.int64)
            found = links(rows[a:b], sides[a:b], keys[a, 1] != keys[a, 2], vectors, int(keys[a, 3]), buckets)
            if found:
                yield found

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = pa.Table.from_batches([batch])
        held = own if held is None else pa.concat_tables([held, own])
        keys = held.column("key").to_numpy()
        if keys[0] == keys[-1]:
            continue
        whole = int(np.searchsorted(keys, keys[-1], side="left"))  # the last key may go on
        yield from (pa.RecordBatch.from_pydict(x) for x in groups(held.slice(0, whole)))
        held = held.slice(whole)
    if held is not None:
        yield from (pa.RecordBatch.from_pydict(x) for x in groups(held))


def links(df: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """From ``row``, ``label``, ``vector``: per row and place of meeting ``n`` links not met before, and ``root``."""
    planes, tables = layout(df.count(), threshold, recall)
    double = "double" in df.schema["vector"].dataType.simpleString()
    labelled = df.where("label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    schema = "row long, label long, size long, vector binary, buckets array<long>"
    hashed = labelled.withColumn("label", F.xxhash64("label")).mapInArrow(lambda b: _hashed(b, planes, tables), schema)
    hashed = stored(hashed, "hashed")
    place = ["label", "size", "table", "bucket"]
    dealt = hashed.select("*", F.posexplode("buckets").alias("table", "bucket")).withColumn("table", F.col("table").cast("long"))
    crowded = dealt.groupBy(place).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    crowded = light(stored(crowded.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).drop("n"), "crowded"))
    dealt = dealt.join(crowded, place, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("row"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).withColumn("key", F.xxhash64(*place, "i", "j"))
    names = ["key", "i", "j", *place, "side", "row", "vector", "buckets"]
    inner = ["key", "i", "j", "table", "bucket", "label", "size"]
    ready = dealt.select(names).repartition("key").sortWithinPartitions(*inner)
    kind = np.float64 if double else np.float32
    return ready.mapInArrow(lambda b: _compared(b, kind, threshold), "row long, root long, n long")


def classes(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of ``df``: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    named = df.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = stored(named.withColumn("row", F.monotonically_increasing_id()), "vectors")
    met = stored(links(rows.select("row", "label", "vector")), "met")
    counted = met.groupBy("row").agg(F.sum("n").alias("n_links"))
    roots = components(met.where("row <> root").select("row", "root").distinct(), "row", "root")
    ids = rows.select("row", "vec_id").join(roots, F.col("row") == F.col("node"), "left").select("row", "vec_id", F.coalesce("root", "row").alias("root"))
    smallest = ids.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    found = ids.join(smallest, "root").join(counted, "row", "left")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
