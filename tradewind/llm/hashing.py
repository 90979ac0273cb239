"""64-bit hashes and minimal perfect hashes over Arrow strings, without an object per string."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
# Bits a key and level, and levels at most; keys whose 64-bit hashes are equal are left over after all levels.
BITS, LEVELS = 2, 40


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def parts(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from zero) and bytes of a string array without nulls."""
    _, places, data = strings.buffers()
    if not len(strings):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    offsets = np.frombuffer(places, np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.empty(0, np.uint8)
    return offsets - offsets[0], held


def translated(strings: pa.Array, table: bytes) -> pa.Array:
    """Every byte replaced by that of ``table``, which must leave bytes from 0x80 on as they are."""
    offsets, data = parts(strings)
    return pa.StringArray.from_buffers(len(strings), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes().translate(table)))


def hash64(strings: pa.Array) -> np.ndarray:
    """A hash of each string: the sum of its scrambled (place, byte) pairs, scrambled with its length."""
    offsets, data = parts(strings)
    totals = np.zeros(len(strings), np.uint64)
    for start in range(0, len(data), BLOCK):
        stop = min(start + BLOCK, len(data))
        first = int(np.searchsorted(offsets, start, side="right")) - 1
        last = int(np.searchsorted(offsets, stop, side="left"))
        edges = np.clip(offsets[first : last + 1], start, stop)
        place = np.arange(start, stop) - np.repeat(offsets[first:last], np.diff(edges))
        sums = np.zeros(stop - start + 1, np.uint64)
        np.cumsum(mixed(((place.astype(np.uint64) << np.uint64(8)) | data[start:stop]) + STEP), out=sums[1:])
        totals[first:last] += sums[edges[1:] - start] - sums[edges[:-1] - start]
    return mixed(totals + np.diff(offsets).astype(np.uint64) * STEP)


def _places(hashes: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    own = np.uint64((level + 1) * int(STEP) % 2**64)
    return (mixed(hashes + own) % np.asarray(size, np.uint64)).astype(np.int64)


def perfect(hashes: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """A minimal perfect hash of distinct keys by their hashes.

    Each level is a row of bits; a key alone at its place there sets the bit and is done, all others
    try the next level. Returns the order of keys by slot (the rank of the bit; keys left over come
    last), the bits of each level and the bits in 64-bit words."""
    left, order, sizes, words = np.arange(len(hashes)), [], [], []
    while len(left) and len(sizes) < LEVELS:
        size = -(-BITS * len(left) // 64) * 64
        place = _places(hashes[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        done = alone[place]
        order.append(left[done][np.argsort(place[done])])
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        left = left[~done]
    return np.concatenate([*order, left]), sizes, np.concatenate([*words, np.empty(0, np.uint64)])


class Shards:
    """Perfect hashes of shards, a key's shard being its hash modulo ``n``; some shards may be absent.

    ``find`` gives the slot of each key, shard after shard, and -1 for strings that are no key: the
    stored key at the slot is compared with the string itself."""

    def __init__(self, n: int, shards: list[tuple[int, list[int], bytes, pa.Array]]):
        self.n = n
        held = sorted(shards, key=lambda s: s[0])
        self.numbers = np.array([s[0] for s in held], np.int64)
        self.keys = pa.concat_arrays([s[3] for s in held]) if held else pa.array([], pa.string())
        self.first = np.cumsum([0, *(len(s[3]) for s in held)])  # slot where each shard begins
        self.at = np.full(n, -1, np.int64)
        self.at[self.numbers] = np.arange(len(held))
        levels = max([len(s[1]) for s in held], default=0)
        self.sizes = np.zeros((len(held), levels), np.int64)
        self.begin = np.zeros((len(held), levels), np.int64)
        at, seen, rest = 0, [], []
        for i, (_, sizes, block, keys) in enumerate(held):
            bits = int(np.bitwise_count(np.frombuffer(block, np.uint64)).sum())
            seen.append(bits)
            rest.append(np.arange(self.first[i] + bits, self.first[i] + len(keys)))
            for level, size in enumerate(sizes):
                self.sizes[i, level], self.begin[i, level] = size, at
                at += size
        self.words = np.frombuffer(b"".join(s[2] for s in held), np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(counts) - counts
        self.before = np.cumsum([0, *seen])[:-1]
        self.rest = np.concatenate([*rest, np.empty(0, np.int64)]).astype(np.int64)

    def find(self, hashes: np.ndarray, strings: pa.Array) -> np.ndarray:
        slot = np.full(len(hashes), -1, np.int64)
        shard = self.at[(hashes % np.uint64(self.n)).astype(np.int64)]
        todo = np.flatnonzero(shard >= 0)
        for level in range(self.sizes.shape[1]):
            own = shard[todo]
            size = self.sizes[own, level]
            place = self.begin[own, level] + _places(hashes[todo], level, np.maximum(size, 1))
            word = np.minimum(place >> 6, len(self.words) - 1)
            bit = (place & 63).astype(np.uint64)
            hit = (size > 0) & ((self.words[word] >> bit) & np.uint64(1)).astype(bool)
            word, bit, own = word[hit], bit[hit], own[hit]
            rank = self.ranks[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[todo[hit]] = self.first[own] + rank - self.before[own]
            todo = todo[~hit]
        found = np.flatnonzero(slot >= 0)
        same = pc.equal(self.keys.take(pa.array(slot[found])), strings.take(pa.array(found))).to_numpy(zero_copy_only=False)
        slot[found[~same]] = -1
        if len(self.rest):
            place = pc.index_in(strings, value_set=self.keys.take(pa.array(self.rest))).fill_null(-1).to_numpy()
            slot = np.where(place >= 0, self.rest[place], slot)
        return slot
