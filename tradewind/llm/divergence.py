"""How far the sources of a language drift apart, term by term, by recounting with perfect hashes.

Terms are runs of letters (ASCII ones lowered, and all characters beyond ASCII). A language keeps the
terms that ``least`` of its documents hold. Every (language, source) group, and each language, gives
each kept term the share p = 1 + floor(``SCALE`` * (count + 1) / (N + V)) with N its counts in all and V
the kept terms; f = floor((p - q)^2 / q) sets one share against another.

1. One pass counts the documents of each term exactly; rare terms go.
2. Kept terms are dealt by hash into shards of about ``PER_SHARD``; each shard gets a minimal perfect
   hash and its terms in slot order.
3. Shards are sent to all workers, at most ``WAVE`` bytes at a time; each wave is one more pass over
   the texts, which adds to a dense row of slots for each group. A string that is no kept term is
   told by the term stored at its slot. Rows are handed on when ``HELD`` bytes of them are held.
4. Rows of a group and shard are added up, ``FAN`` at a time until one is left; then sources are
   compared shard by shard, ``BLOCK`` x ``BLOCK`` of them in a task.

No task holds more than a wave, a shard's rows of two blocks of sources, or one text. Counts are exact up
to N + V of 9e15. Null text, language or source count as ''. Rows with the same id, a null id or
equal text are documents of their own. A language without kept terms gets pairs of value 0, a group
without terms its smallest shares. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.hashing import Shards, hash64, perfect, translated
from tradewind.llm.text import Words, light, slices, stored, strings

SCALE = 1_000_000_000
PER_SHARD = 16_384
WAVE, HELD = 48_000_000, 64_000_000
FAN, BLOCK = 2048, 128
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))
COUNTS = "lang string, shard int, source string, slots binary, counts binary"


def terms(texts: pa.Array) -> Words:
    return Words.of(translated(texts, LETTERS))


def share(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) digit group by digit group, so that nothing overflows."""
    left, found = counts + 1, np.zeros_like(counts)
    for _ in range(3):
        left = left * 1000
        found = found * 1000 + left // total
        left = left % total
    return found + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """``lang`` and ``term`` of the terms that ``least`` documents of the language hold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = terms(strings(batch.column("text")))
            langs = batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            size = len(words.vocabulary) + 1
            once = np.unique(words.owner * size + words.codes)
            key, n = np.unique(lang[once // size] * size + once % size, return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": langs.dictionary.take(pa.array(key // size)), "term": words.vocabulary.take(pa.array(key % size)), "n": n})

    held = docs.select("lang", "text").mapInArrow(count, "lang string, term string, n long")
    counted = held.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    return stored(counted.where(F.col("n") >= least).select("lang", "term"), "kept")


def hashed_shards(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """Per shard its ``keys`` by slot, the bits of its levels, ``bytes`` held and the wave it is sent in."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = hash64(strings(batch.column("term")))
            shards = batch.column("shards").to_numpy(zero_copy_only=False).astype(np.uint64)
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "term": batch.column("term"), "shards": batch.column("shards"), "shard": (h % shards).astype(np.int32)})

    def build(group: pa.Table) -> pa.Table:
        keys = strings(group.column("term"))
        order, levels, words = perfect(hash64(keys))
        keys = keys.take(pa.array(order))
        held = words.nbytes + 8 * len(keys) + pc.sum(pc.binary_length(keys)).as_py()
        return pa.table({"lang": group.column("lang")[:1], "shards": group.column("shards")[:1], "shard": group.column("shard")[:1], "levels": pa.array([levels], pa.list_(pa.int64())), "bits": pa.array([words.tobytes()], pa.binary()), "keys": pa.array([keys.to_pylist()], pa.list_(pa.string())), "bytes": pa.array([held], pa.int64())})

    dealt = kept.join(light(sizes), "lang").select("lang", "term", F.ceil(F.col("v") / PER_SHARD).alias("shards"))
    dealt = dealt.mapInArrow(deal, "lang string, term string, shards long, shard int")
    built = dealt.groupBy("lang", "shard").applyInArrow(build, "lang string, shards long, shard int, levels array<long>, bits binary, keys array<string>, bytes long")
    return stored(built, "shards")


def waves(shards: DataFrame) -> Iterator[pa.Table]:
    """The shards, at most ``WAVE`` bytes at once, or one shard."""
    # One row a shard, about a row for every PER_SHARD kept terms.
    listed = shards.select("lang", "shard", "bytes").orderBy("lang", "shard").toArrow()
    numbers = (np.cumsum(listed.column("bytes").to_numpy()) - listed.column("bytes").to_numpy()) // WAVE
    for number in np.unique(numbers).tolist():
        low, high = (listed.slice(int(i), 1).to_pylist()[0] for i in np.flatnonzero(numbers == number)[[0, -1]])
        place = F.struct("lang", "shard")
        ends = [F.struct(F.lit(x["lang"]).alias("lang"), F.lit(x["shard"]).cast("int").alias("shard")) for x in (low, high)]
        yield shards.where((place >= ends[0]) & (place <= ends[1])).drop("bytes").toArrow()


def recounted(docs: DataFrame, wave: pa.Table) -> DataFrame:
    """Counts of the wave's terms, rows of ``COUNTS``: of each group and shard the slots met and how often."""
    sent = docs.sparkSession.sparkContext.broadcast(wave.to_batches())

    def opened() -> dict[str, Shards]:
        by_lang: dict[str, tuple[int, list]] = {}
        for batch in sent.value:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                keys = row.column("keys").flatten()
                lang, n = row.column("lang")[0].as_py(), row.column("shards")[0].as_py()
                by_lang.setdefault(lang, (n, []))[1].append((row.column("shard")[0].as_py(), row.column("levels")[0].as_py(), row.column("bits")[0].as_py(), keys))
        return {lang: Shards(*held) for lang, held in by_lang.items()}

    def flushed(dense: dict[tuple[str, str], np.ndarray], shards: dict[str, Shards]) -> Iterator[pa.RecordBatch]:
        for (lang, source), row in dense.items():
            own = shards[lang]
            slots = np.flatnonzero(row)
            cuts = np.searchsorted(slots, own.first)
            full = np.flatnonzero(np.diff(cuts)).tolist()
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(full), pa.string()),
                "shard": own.numbers[full].astype(np.int32),
                "source": pa.array([source] * len(full), pa.string()),
                "slots": pa.array([(slots[cuts[i] : cuts[i + 1]] - own.first[i]).astype(np.int32).tobytes() for i in full], pa.binary()),
                "counts": pa.array([row[slots[cuts[i] : cuts[i + 1]]].astype(np.int64).tobytes() for i in full], pa.binary()),
            })

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = opened()
        dense: dict[tuple[str, str], np.ndarray] = {}
        held = 0
        for batch in slices(batches, "text"):
            words = terms(strings(batch.column("text")))
            if not len(words.codes):
                continue
            hashes = hash64(words.vocabulary)
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            names = list(dict.fromkeys(zip(langs, sources, strict=True)))
            number = {name: i for i, name in enumerate(names)}
            group = np.array([number[g] for g in zip(langs, sources, strict=True)])[words.owner]
            by_group = np.argsort(group, kind="stable")
            cuts = np.searchsorted(group[by_group], np.arange(len(names) + 1))
            slots: dict[str, np.ndarray] = {}
            for i, (lang, source) in enumerate(names):
                if lang not in shards:
                    continue
                if lang not in slots:
                    slots[lang] = shards[lang].find(hashes, words.vocabulary)
                size = len(shards[lang].keys)
                if (lang, source) not in dense:
                    if held + 4 * size > HELD:
                        yield from flushed(dense, shards)
                        dense, held = {}, 0
                    dense[lang, source] = np.zeros(size, np.int32)  # a task's tokens fit
                    held += 4 * size
                found = slots[lang][words.codes[by_group[cuts[i] : cuts[i + 1]]]]
                np.add.at(dense[lang, source], found[found >= 0], 1)
        yield from flushed(dense, shards)

    return stored(docs.mapInArrow(count, COUNTS), "recounted")


def _vector(slots: bytes, counts: bytes, into: np.ndarray) -> np.ndarray:
    into[np.frombuffer(slots, np.int32)] += np.frombuffer(counts, np.int64)
    return into


def _added(keys: int):
    """Adds up neighbouring rows whose first ``keys`` columns are equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total, batch = None, np.zeros(0, np.int64), None

        def row() -> pa.RecordBatch:
            slots = np.flatnonzero(total)
            columns = [pa.array([k], f.type) for k, f in zip(key, schema, strict=False)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([slots.astype(np.int32).tobytes()]), pa.array([total[slots].tobytes()])], names=names)

        for batch in batches:
            names = [*batch.schema.names[:keys], "slots", "counts"]
            schema = list(batch.schema)
            for *own, slots, counts in zip(*(c.to_pylist() for c in (*batch.columns[:keys], batch.column("slots"), batch.column("counts"))), strict=True):
                if own != key:
                    if key is not None:
                        yield row()
                    key, total = own, np.zeros(0, np.int64)
                need = int(np.frombuffer(slots, np.int32)[-1]) + 1
                if need > len(total):
                    total = np.concatenate([total, np.zeros(need - len(total), np.int64)])
                _vector(slots, counts, total)
        if key is not None:
            yield row()

    return run


def added(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, ``FAN`` rows at a time until one is left."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    while True:
        most = rows.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        fans = -(-most // FAN)
        part = F.pmod(F.xxhash64("slots", "counts"), F.lit(max(fans, 1))).alias("part")
        dealt = rows.select(*keys, part, "slots", "counts").repartition(*keys, "part").sortWithinPartitions(*keys, "part")
        schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", part long, slots binary, counts binary"
        rows = stored(dealt.mapInArrow(_added(len(keys) + 1), schema).drop("part"), "added")
        if fans <= 1:
            return rows


def pair_sums(counts: DataFrame, groups: DataFrame, shards: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` over all kept terms, from the shards that hold any.

    Every group has a row in every shard of its language; blocks of sources meet in pairs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def pairs() -> pa.RecordBatch:
            lang, _, x, y = key
            p = np.stack([share(_vector(r["slots"] or b"", r["counts"] or b"", np.zeros(r["terms"], np.int64)), r["total"]) for r in held])
            first = [i for i, r in enumerate(held) if r["block"] == x]
            second = [i for i, r in enumerate(held) if r["block"] == y]
            out: dict[str, list] = {"source": [], "item": [], "value": []}
            for a, b in {(x, y), (y, x)}:
                own, others = (first, second) if (a, b) == (x, y) else (second, first)
                for i in own:
                    sums = gap(p[i], p[others]).sum(axis=1)
                    for j, value in zip(others, sums.tolist(), strict=True):
                        if i != j:
                            out["source"].append(held[i]["source"])
                            out["item"].append(held[j]["source"])
                            out["value"].append(value)
            n = len(out["value"])
            return pa.RecordBatch.from_pydict({"lang": pa.array([lang] * n, pa.string()), "source": pa.array(out["source"], pa.string()), "item": pa.array(out["item"], pa.string()), "value": pa.array(out["value"], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                own = (row["lang"], row["shard"], row["x"], row["y"])
                if own != key:
                    if held:
                        yield pairs()
                    key, held = own, []
                held.append(row)
        if held:
            yield pairs()

    place = Window.partitionBy("lang").orderBy("source")
    blocks = groups.withColumn("block", F.floor((F.row_number().over(place) - 1) / BLOCK))
    blocks = stored(blocks.join(light(stored(blocks.groupBy("lang").agg(F.max("block").alias("last")), "blocks")), "lang"), "blocks")
    every = blocks.join(light(stored(shards.select("lang", "shard", F.size("keys").alias("terms")), "sizes")), "lang")
    rows = every.join(counts, ["lang", "shard", "source"], "left")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("other")
    met = rows.select("*", other).withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    met = met.select("lang", "shard", "x", "y", "block", "source", "terms", (F.col("n") + F.col("v")).alias("total"), "slots", "counts")
    dealt = met.repartition("lang", "shard", "x", "y").sortWithinPartitions("lang", "shard", "x", "y", "source")
    found = dealt.mapInArrow(compare, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def leading_terms(counts: DataFrame, groups: DataFrame, shards: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    """``lang``, ``source``, ``item`` and ``value`` of the terms that a group has more of than its language: of each shard the first ``top``."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, keys, shares = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                r = row.drop_columns(["keys"]).to_pylist()[0]
                own = (r["lang"], r["shard"])
                if r["source"] is None:  # the shard itself, before its groups
                    key, keys = own, row.column("keys").flatten()
                    shares = share(_vector(r["slots"], r["counts"], np.zeros(len(keys), np.int64)), r["total"])
                    continue
                assert own == key
                slots = np.frombuffer(r["slots"], np.int32)
                p, q = share(np.frombuffer(r["counts"], np.int64), r["total"]), shares[slots]
                more = p > q
                value = gap(p[more], q[more])
                table = pa.table({"value": value, "item": keys.take(pa.array(slots[more]))})
                first = pc.select_k_unstable(table, k=top, sort_keys=[("value", "descending"), ("item", "ascending")]) if len(value) else pa.array([], pa.uint64())
                table = table.take(first)
                yield pa.RecordBatch.from_arrays([pa.array([r["lang"]] * len(first), pa.string()), pa.array([r["source"]] * len(first), pa.string()), table.column("item").combine_chunks(), table.column("value").combine_chunks()], names=["lang", "source", "item", "value"])

    whole = added(counts, ["lang", "shard"])
    totals = light(stored(sizes.join(groups.groupBy("lang").agg(F.sum("n").alias("n")), "lang").select("lang", (F.col("n") + F.col("v")).alias("total")), "totals"))
    heads = shards.select("lang", "shard", "keys").join(whole, ["lang", "shard"]).join(totals, "lang").select("lang", "shard", F.lit(None).cast("string").alias("source"), "total", "slots", "counts", "keys")
    own = counts.join(light(groups), ["lang", "source"]).select("lang", "shard", "source", (F.col("n") + F.col("v")).alias("total"), "slots", "counts", F.lit(None).cast("array<string>").alias("keys"))
    dealt = heads.union(own).repartition("lang", "shard").sortWithinPartitions("lang", "shard", F.col("source").asc_nulls_first())
    return dealt.mapInArrow(choose, "lang string, source string, item string, value long")


def audit(df: DataFrame, least: int = 3, top: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: of each group every other source of its language
    (part ``pair``) and its ``top`` leading terms (part ``term``)."""
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    kept = kept_terms(docs, least)
    sizes = stored(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "sizes")
    shards = hashed_shards(kept, sizes)
    counts = None
    for wave in waves(shards):
        part = recounted(docs, wave)
        counts = part if counts is None else counts.union(part)
    if counts is None:
        counts = df.sparkSession.createDataFrame([], COUNTS)
    counts = added(counts, ["lang", "shard", "source"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(np.frombuffer(c, np.int64).sum()) for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "source": batch.column("source"), "n": pa.array(n, pa.int64())})

    n = counts.select("lang", "source", "counts").mapInArrow(summed, "lang string, source string, n long").groupBy("lang", "source").agg(F.sum("n").alias("n"))
    occurring = docs.select("lang", "source").distinct()
    groups = occurring.join(n, ["lang", "source"], "left").join(light(sizes), "lang", "left")
    groups = stored(groups.select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v")), "groups")

    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.join(pair_sums(counts, groups, shards), ["lang", "source", "item"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    first = ranked(leading_terms(counts, groups, shards, sizes, top), "term").where(F.col("rank") <= top)
    return ranked(pairs, "pair").union(first)
