"""Which documents share most of their word n-grams, by prefixes under several token orders.

A document is the set of its distinct five-word shingles (64-bit hashes; with one to four words the
whole text is one shingle). Two sets with Jaccard similarity of at least 3/4 must share one of the
first ``n - ceil(3n/4) + 1`` tokens of both under any fixed order of all tokens. So

1. one pass gives each document its set's size and fingerprint; equal sets are one node from then
   on. It also counts tokens, and the commonest ones go last in the first order;
2. prefix tokens under the first order are dealt out by token; tokens of one node drop out;
3. each node is compared with two leaders of each token it shares, which joins up large groups of
   near copies at a cost that follows their size;
4. every pair that shares a token and is not yet in one component is compared as well, so no link
   between components is lost.

A pair is compared by sketches first: how many tokens fall into each of about as many buckets as a
set has tokens, which bounds what two sets can share. Only the pairs left move whole sets; they are
asked for a common prefix token under two further orders (hashes of the tokens with different salts),
and those that share one under each are verified on their whole sets.

Null text and text without words give an empty set, linked with nothing. Rows with the same id, a
null id or equal text are rows of their own; a component's id is the smallest id of its rows, null
if none has one. Sets are told apart by 64-bit fingerprints. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.components import components
from tradewind.llm.hashing import hash64, mixed
from tradewind.llm.text import Words, light, released, slices, stored, strings

WIDTH = 5
# Tokens that go last in the first order: at most so many, held by each task. They decide what is
# compared, not what is found.
COMMON = 400_000
# Repeated tokens that a counting task holds.
HELD = 400_000
# Sets that a comparing task holds, and pairs for it, about.
HUBS, PAIRS = 2048, 100_000
SKETCHES = 16 * HUBS  # instead of sets
NUMBER = "__row_of_ngram_join"
SALTS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)


def prefix(n: np.ndarray) -> np.ndarray:
    return n - (3 * n + 3) // 4 + 1


class Sets:
    """Distinct shingles of several texts: ``tokens`` ascending within each ``owner``."""

    def __init__(self, texts: pa.Array):
        words = Words.of(texts, lower=True)
        own = hash64(words.vocabulary)[words.codes]
        short = np.flatnonzero((words.counts > 0) & (words.counts < WIDTH))
        first = np.cumsum(words.counts) - words.counts
        at = words.starts(WIDTH)
        tokens, owner = np.zeros(len(at), np.uint64), words.owner[at]
        for step in range(WIDTH):
            tokens = mixed(tokens * np.uint64(31) + own[at + step])
        lone = np.zeros(len(short), np.uint64)
        for step in range(WIDTH - 1):
            more = step < words.counts[short]
            lone[more] = mixed(lone[more] * np.uint64(31) + own[first[short[more]] + step])
        tokens, owner = np.concatenate([tokens, lone]), np.concatenate([owner, short])
        order = np.lexsort((tokens, owner))
        tokens, owner = tokens[order], owner[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = tokens[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(texts)).astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.prints = np.zeros(len(texts), np.uint64)
        np.add.at(self.prints, self.owner, mixed(self.tokens ^ np.uint64(SALTS[0])))
        self.prints = mixed(self.prints + self.sizes.astype(np.uint64)).view(np.int64)

    def of(self, text: int) -> np.ndarray:
        return self.tokens[self.first[text] : self.first[text] + self.sizes[text]]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and fingerprint of each row; at the end of the task, tokens that it has seen often (``n`` negative).

    Counts of rare tokens are thinned out whenever many are held, so memory stays bounded."""
    held, often = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in slices(batches, "text"):
        sets = Sets(strings(batch.column("text")))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "row": batch.column("row"), "h": batch.column("h"), "n": sets.sizes, "node": sets.prints})
        tokens, counts = np.unique(sets.tokens, return_counts=True)
        several = counts > 1
        held, place = np.unique(np.concatenate([held, tokens[several].view(np.int64)]), return_inverse=True)
        often = np.bincount(place, np.concatenate([often, counts[several]]), len(held)).astype(np.int64)
        del sets, tokens, counts, place
        if len(held) > HELD:
            kept = often > np.partition(often, -HELD // 2)[-HELD // 2]
            held, often = held[kept], often[kept]
    if len(held):
        none = pa.nulls(len(held), batch.schema.field("doc_id").type)
        yield pa.RecordBatch.from_pydict({"doc_id": none, "row": pa.nulls(len(held), pa.int64()), "h": pa.nulls(len(held), pa.int64()), "n": -often, "node": held})


def _prefixes(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """``token``, ``node`` and ``place`` (set size * 2^32 + place in the first order) of prefix tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            sets = Sets(strings(batch.column("text")))
            fresh = np.zeros(len(sets.sizes), bool)
            for i in np.flatnonzero(sets.sizes):
                p = int(sets.prints[i])
                fresh[i] = p not in seen
                seen.add(p)
            if len(common):
                place = np.minimum(np.searchsorted(common, sets.tokens), len(common) - 1)
                order = np.argsort(sets.owner * 2 + (common[place] == sets.tokens), kind="stable")
            else:
                order = np.arange(len(sets.tokens))
            tokens, owner = sets.tokens[order], sets.owner[order]
            place = np.arange(len(tokens)) - sets.first[owner]
            used = fresh[owner] & (place < prefix(sets.sizes)[owner])
            owner = owner[used]
            yield pa.RecordBatch.from_pydict({"token": tokens[used].view(np.int64), "node": sets.prints[owner], "place": (sets.sizes[owner] << 32) + place[used]})

    return docs.select("text").mapInArrow(released(run), "token long, node long, place long")


def _both(place: str) -> tuple[Column, Column]:
    return F.shiftright(place, 32), F.col(place).bitwiseAND(F.lit(2**32 - 1))


def _possible(a: str, b: str) -> Column:
    """Sizes allow 3/4, and what follows the shared token is enough for the overlap that 3/4 needs.

    The second holds at least at the first token that a similar pair shares."""
    (n, i), (m, j) = _both(a), _both(b)
    rest = 1 + F.least(n - i - 1, m - j - 1)
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * rest >= 3 * (n + m))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node``, its ``sketch`` and the bytes of its ``tokens`` for nodes wanted (``node``, ``id`` and text hash ``h`` of one row that has
    it). Rows are found by both, so that rows with one id, or without one, do not multiply."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            sets = Sets(strings(batch.column("text")))
            found = []
            for i in np.flatnonzero(sets.prints == batch.column("node").to_numpy()):
                if (node := int(sets.prints[i])) not in seen:
                    seen.add(node)
                    found.append(i)
            own = [sets.of(i) for i in found]
            yield pa.RecordBatch.from_pydict({"node": sets.prints[found], **{k: pa.array([f(x) for x in own], pa.binary()) for k, f in (("sketch", _sketch), ("tokens", np.ndarray.tobytes))}})

    wanted = light(stored(wanted, "wanted"))
    held = wanted.withColumnRenamed("h", "hash")
    found = docs.select("doc_id", "text", "h").join(held, (F.col("h") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("text", "node")
    return stored(found.mapInArrow(released(run), "node long, sketch binary, tokens binary"), "sets")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _sketch(tokens: np.ndarray) -> bytes:
    """Size of a set, and how many of its tokens have each value of their lowest bits, at most 255; a byte for one or two tokens."""
    buckets = 1 << max(4, len(tokens).bit_length() - 1)
    counts = np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.int64(len(tokens)).tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def _opened(block: bytes) -> tuple[int, np.ndarray]:
    return int(np.frombuffer(block, np.int64, 1)[0]), np.frombuffer(block, np.uint8, offset=8).astype(np.int32)


def _near(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> bool:
    """The sets may be similar. Their counts differ by no more, in all, than there are tokens that only one of them has."""
    (n, x), (m, y) = a, b
    buckets = min(len(x), len(y))
    apart = int(np.abs(x.reshape(-1, buckets).sum(0) - y.reshape(-1, buckets).sum(0)).sum())
    both = (n + m - apart) // 2
    return 100 * both >= 75 * (n + m - both)


def _orders(block: bytes) -> list[np.ndarray]:
    """A set's tokens, and those in its prefixes under the further orders."""
    own = np.frombuffer(block, np.uint64)
    size = int(prefix(np.int64(len(own))))
    return [own, *(np.partition(mixed(own ^ np.uint64(salt)), size - 1)[:size] for salt in SALTS)]


def _similar(a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    """Prefixes under every further order share a token, and the sets are similar."""
    if not all(_common(x, y) for x, y in zip(a[1:], b[1:], strict=True)):
        return False
    both = _common(a[0], b[0])
    return 100 * both >= 75 * (len(a[0]) + len(b[0]) - both)


def _compared(opened: Callable, alike: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs that are ``alike`` among rows sorted by place: what its hubs have first, which is held, then for each
    other node a row of its partners among them and a row of what it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, hubs, partners = None, {}, []
        for batch in batches:
            found: dict[str, list] = {"a": [], "b": []}
            for block, part, kind, node, listed, content in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "kind", "node", "partners", "content")), strict=True):
                if (block, part) != place:
                    place, hubs = (block, part), {}
                if kind == 0:
                    hubs[node] = opened(content)
                elif listed is not None:
                    partners = listed
                else:
                    own = opened(content)
                    near = [hub for hub in partners if alike(hubs[hub], own)]
                    found["a"] += [min(hub, node) for hub in near]
                    found["b"] += [max(hub, node) for hub in near]
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in found.items()})

    return run


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar: those whose sketches allow it, verified on whole sets."""
    near = _matched(pairs, sets.select("node", F.col("sketch").alias("content")), SKETCHES, _opened, _near)
    return _matched(near, sets.select("node", F.col("tokens").alias("content")), HUBS, _orders, _similar)


def _matched(pairs: DataFrame, contents: DataFrame, hubs_held: int, opened: Callable, alike: Callable) -> DataFrame:
    """The pairs that are ``alike``, by the ``content`` of each node.

    Of each pair the node with more pairs is the hub. Hubs are dealt into blocks of about ``hubs_held``,
    which tasks hold; every other node goes once to each block that has partners of it. A block with
    many pairs is held by several tasks, which share the other nodes out."""
    degrees = _nodes(pairs, distinct=False).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    degrees = light(stored(degrees, "degrees"))
    for side in ("a", "b"):
        pairs = pairs.join(degrees.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
    first = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    pairs = pairs.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("node"))
    pairs = stored(pairs, "pairs")
    size = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("hub").alias("hubs")).first()
    blocks = max(1, -(-size["hubs"] // hubs_held))
    parts = max(1, -(-size["pairs"] // (blocks * PAIRS)))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("hub"), F.lit(blocks)))
    hubs = light(stored(pairs.select("block", F.col("hub").alias("node")).distinct(), "hubs"))
    others = light(stored(pairs.select("block", "node").distinct(), "others"))
    none, whole = F.lit(None).cast("array<long>").alias("partners"), F.lit(None).cast("binary").alias("content")
    part = F.pmod(F.xxhash64("node"), F.lit(parts)).cast("long").alias("part")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part")
    held = contents.join(hubs, "node").select("block", every, F.lit(0).alias("kind"), "node", none, "content")
    sent = contents.join(others, "node").select("block", part, F.lit(1).alias("kind"), "node", none, "content")
    lists = pairs.groupBy("block", "node").agg(F.collect_list("hub").alias("partners")).select("block", part, F.lit(1).alias("kind"), "node", "partners", whole)
    placed = held.union(sent).union(lists).repartition("block", "part").sortWithinPartitions("block", "part", "kind", "node", F.col("partners").isNull())
    return stored(placed.mapInArrow(released(_compared(opened, alike)), "a long, b long"), "links")


def _nodes(pairs: DataFrame, distinct: bool = True) -> DataFrame:
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    return nodes.distinct() if distinct else nodes


def _rooted(lists: DataFrame, links: DataFrame) -> DataFrame:
    """With ``root``, the component that the links found so far put each node into."""
    roots = light(stored(components(links), "roots"))
    return lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _stars(lists: DataFrame) -> DataFrame:
    """Pairs of a token's nodes with two leaders of it.

    One is the node most of whose prefix others share: an original among copies, which have words of
    their own. The other is chosen by hash, one for odd tokens and one for even."""
    alike = Window.partitionBy("token")
    orders = (F.struct(-F.col("common"), F.xxhash64("node")), F.struct(F.lit(0.0), F.xxhash64("node", F.col("token").bitwiseAND(F.lit(1)))))
    leads = [F.min(F.struct(o.alias("o"), "node", "place")).over(alike) for o in orders]
    led = lists.withColumns({"original": leads[0], "other": leads[1]}).select("node", "place", F.explode(F.array("original", "other")).alias("lead"))
    led = led.select("node", "place", F.col("lead.node").alias("other"), F.col("lead.place").alias("other_place"))
    pairs = led.where((F.col("node") != F.col("other")) & _possible("place", "other_place"))
    return stored(pairs.select(*_pair("node", "other")).distinct(), "pairs")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", also: str | None = None) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_shingles``, ``node`` (equal for equal sets), ``root`` (equal for
    equal components), ``component_id``, and ``row``, the integer column ``also``."""
    row = (F.col(also) if also else F.lit(None)).cast("long")
    docs = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), row.alias("row")).withColumn("h", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    facts = stored(docs.mapInArrow(released(_facts), f"doc_id {kind}, row long, h long, n long, node long"), "facts")
    rows = facts.where("n >= 0")
    often = stored(facts.where("n < 0").groupBy("node").agg((-F.sum("n")).alias("n")), "often")
    # How many tokens there are of each eighth of a power of two: few rows.
    level = F.floor(F.log2("n") * 8)
    per_level = often.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("tokens")).collect()
    least, share, kept = 0, 0.0, 0
    for least, tokens in sorted(((r["level"], r["tokens"]) for r in per_level), reverse=True):  # noqa: B007
        share = min(1.0, (COMMON - kept) / tokens)
        kept += tokens
        if share < 1:  # of the last level that fits, a share by hash
            break
    some = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20))
    chosen = often.where((level > least) | ((level == least) & some)).select("node")
    common = np.sort(chosen.toArrow().column("node").to_numpy().view(np.uint64))

    alike = Window.partitionBy("token")
    held = _prefixes(docs, common).withColumns({"low": F.min("node").over(alike), "high": F.max("node").over(alike)})
    lists = stored(held.where("low < high").select("token", "node", "place"), "lists")
    size = F.shiftright("place", 32)
    weights = lists.groupBy("node").agg((F.count(F.lit(1)) / F.max(size - F.floor((3 * size + 3) / 4) + 1)).alias("common"))
    lists = lists.join(light(stored(weights, "weights")), "node")

    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "h")).alias("one"))
    ids = nodes.select("node", F.col("one.doc_id").alias("id"), F.col("one.h").alias("h"))
    tried = _stars(lists)
    sets = _sets(docs, _nodes(tried).join(ids, "node"))
    links = _linked(tried, sets)

    # Tokens whose nodes are all in one component by now have no pair left.
    x = _rooted(lists, links).select("token", "node", "place", "root")
    apart = x.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    x = stored(x.join(apart.select("token"), "token"), "apart")
    y = x.select("token", *[F.col(c).alias(f"other_{c}") for c in ("node", "place", "root")])
    rest = x.join(y, "token").where((F.col("root") < F.col("other_root")) & _possible("place", "other_place"))
    rest = stored(rest.select(*_pair("node", "other_node")).distinct().join(light(tried), ["a", "b"], "left_anti"), "pairs")
    more = _nodes(rest).join(sets.select("node"), "node", "left_anti")
    roots = components(links.union(_linked(rest, sets.union(_sets(docs, more.join(ids, "node"))))))

    smallest = nodes.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
    of_root = smallest.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = smallest.join(of_root, "root").select("node", "root", "component_id")
    return rows.join(of_node.withColumn("filled", F.lit(True)), "node", "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"), "node", F.coalesce("root", "node").alias("root"), F.when(F.col("filled"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component one row of ``df``, that with the smallest id (null last, then the first row); columns unchanged.

    Rows without words are all kept."""
    numbered = stored(df.withColumn(NUMBER, F.monotonically_increasing_id()), "numbered")  # numbered once, whatever made ``df``
    rows = classes(numbered, key, text, also=NUMBER)
    worded = F.col("n_shingles") > 0
    group = (worded.alias("worded"), F.when(worded, F.col("root")).otherwise(F.col("row")).alias("group"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    kept = stored(rows.groupBy(*group).agg(first).select(F.col("first.row").alias(NUMBER)), "kept")
    return numbered.join(light(kept), NUMBER, "left_semi").drop(NUMBER)
