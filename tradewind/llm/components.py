"""Connected components of a table of links, without ever holding all links in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import released, stored


PER_TASK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links and the smallest node that it reaches."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        np.minimum.at(root, high, low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
    return nodes, nodes[root]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one task as links from each node to the smallest that it reaches there."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(x) for x, _ in held) > 4 * PER_TASK:
            held = [forest(*(np.concatenate(side) for side in zip(*held, strict=True)))]
    if held:
        node, root = forest(*(np.concatenate(side) for side in zip(*held, strict=True)))
        yield pa.RecordBatch.from_pydict({"node": node, "root": root})


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of a link (integers).

    Each round joins up the links of every task on their own. What is left are links between roots
    of different tasks, a shrinking table; when one task's share is left, the round is the last."""
    spark = links.sparkSession
    left = stored(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")), "links")
    levels: list[DataFrame] = []
    while True:
        tasks = max(1, -(-left.count() // PER_TASK))
        dealt = left.repartition(tasks, "a") if tasks > 1 else left.coalesce(1)
        joined = stored(dealt.mapInArrow(released(_contract), "node long, root long"), "roots")
        if tasks == 1:
            levels.append(joined)
            break
        lowest = joined.groupBy("node").agg(F.min("root").alias("low"))
        levels.append(stored(lowest.select("node", F.col("low").alias("root")), "roots"))
        between = joined.join(lowest, "node").where("root <> low").select(F.col("root").alias("a"), F.col("low").alias("b"))
        left = stored(between.distinct(), "links")
    found = levels[0]
    for level in levels[1:]:  # whatever is linked further on is a root of the level before
        higher = level.select(F.col("node").alias("root"), F.col("root").alias("top"))
        found = found.join(higher, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return found
