"""Placement of rows on shards through a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own, ``offset, offset +
skip, offset + 2 * skip, ...`` modulo the size, both taken from a hash of its name. The shards take
turns, each claiming the first slot it prefers that is still free, until none is. So their numbers
of slots differ by one at most, and adding or removing a shard moves few slots of the others. A row
goes to slot ``hash(key) mod size``: one lookup in a broadcast table of fixed size.

A null key hashes as empty text. Equal keys share a shard, repeated rows included. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A prime far larger than the number of shards keeps loads even; every executor holds this many numbers.
SLOTS = 65_537


def _number(text: str, of: int) -> int:
    return int(hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()[of : of + 8], 16)


def table(shards: list[str], size: int = SLOTS) -> np.ndarray:
    """The shard (its place in ``shards``) of each slot. ``size`` must be prime, names distinct."""
    if not shards or len(set(shards)) != len(shards) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("distinct shard names and a prime number of slots are needed")
    at = [_number(name, 0) % size for name in shards]
    skip = [_number(name, 8) % (size - 1) + 1 for name in shards]
    owner = np.full(size, -1, np.int32)
    left = size
    while left:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % size
            owner[at[shard]] = shard
            left -= 1
            if not left:
                break
    return owner


def slot(key: Column, size: int = SLOTS) -> Column:
    """The first 32 bits of the key's MD5, modulo the table's size: the same in any engine."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % size


def place(df: DataFrame, shards: list[str], key: str = "doc_id", size: int = SLOTS) -> DataFrame:
    """The key of every row with its ``slot`` and ``shard``."""
    owner = table(shards, size)
    rows = [(i, shards[s]) for i, s in enumerate(owner.tolist())]
    lookup = F.broadcast(df.sparkSession.createDataFrame(rows, "slot long, shard string"))
    return df.select(F.col(key).alias("key"), slot(F.col(key), size).alias("slot")).join(lookup, "slot").select("key", "slot", "shard")


def moved(before: list[str], after: list[str], size: int = SLOTS) -> float:
    """Share of slots that change hands between two sets of shards."""
    a, b = table(before, size), table(after, size)
    return float(np.mean(np.array(before)[a] != np.array(after)[b]))
