"""Conversations brought back into turns at the least cost, with the edits that do it.

Rows of a conversation stand by turn (nulls first; equal turns by role, then text). Each row's first
fault counts: ``blank`` (nothing but white space), ``duplicate`` (role and text of an earlier row),
``truncated`` (the last character ends no sentence). Edits are Keep (0), Rerole to user or assistant
(1), Delete (2; the only edit for blank and duplicate rows) and Insert of an empty row of either role
(5); a truncated row that is not deleted adds 5. The cheapest edits whose role initials read
``(s?(ua)+)?`` win, the ASCII-least string of edit initials among equals. An edit and the state before
it give the state after it, so these initials say all.

1. Rows are ranged by conversation and turn, so a long conversation is shared out over tasks. Each
   task cuts its part of a conversation into chunks of at most ``ROWS`` rows and ``BYTES`` bytes.
2. For each chunk and each state before it a table gives the least cost and audit that lead to each
   state after it. Audits are nodes that share their prefixes, with ancestors at powers of two and
   rolling hashes; of two equally cheap ones the smaller is told by searching for their longest common
   prefix, which is compared itself where hashes say equal.
3. The tables of a conversation are joined in order, and each chunk learns the states it lies between.
4. Repaired texts of a chunk are joined where they lie; one stream per conversation hashes them.

A task holds one chunk's rows, or the tables and the audit of one conversation. Duplicates are told by
SHA-256 of role and text, first ones found by a grouped minimum. Null role or text counts as one
space; null turns come first and leave no gaps; a null id is a conversation of its own. Repeated rows
are duplicates of each other. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import light, stored

ROWS, BYTES = 4096, 4_000_000
WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = frozenset({"su", "ua", "au"})
# States: nothing yet, after s, after u, after a. The first and the last may end a conversation.
STATES, ENDS = 4, (0, 3)
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))  # what a rerole or an insert can give
MODULUS, BASE = (1 << 61) - 1, 911_382_323_784_521
FAULTS = ("blank", "duplicate", "truncated")


class Audits:
    """Strings as nodes: a node is its parent's string and a piece. Node 0 is the empty string."""

    def __init__(self):
        self.up: list[list[int]] = [[]]
        self.piece, self.end, self.hash = [""], [0], [0]

    def _hashed(self, value: int, text: str) -> int:
        for c in text:
            value = (value * BASE + ord(c)) % MODULUS
        return value

    def add(self, parent: int, piece: str) -> int:
        if not piece:
            return parent
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.up.append(up)
        self.piece.append(piece)
        self.end.append(self.end[parent] + len(piece))
        self.hash.append(self._hashed(self.hash[parent], piece))
        return len(self.piece) - 1

    def _over(self, node: int, place: int) -> int:
        """The ancestor (or node) whose piece holds the character at ``place``."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            if k < len(self.up[node]) and self.end[self.up[node][k]] > place:
                node = self.up[node][k]
        return node

    def at(self, node: int, place: int) -> str:
        node = self._over(node, place)
        return self.piece[node][place - self.end[node]]

    def prefix(self, node: int, length: int) -> int:
        """Hash of the first ``length`` characters."""
        if length == 0:
            return 0
        node = self._over(node, length - 1)
        if self.end[node] == length:
            return self.hash[node]
        parent = self.up[node][0]
        return self._hashed(self.hash[parent], self.piece[node][: length - self.end[parent]])

    def text(self, node: int) -> str:
        parts = []
        while node:
            parts.append(self.piece[node])
            node = self.up[node][0]
        return "".join(reversed(parts))

    def _same(self, a: int, b: int, length: int) -> bool:
        """Whether two prefixes with equal hashes are equal: compared down to the node they share."""
        if length == 0:
            return True
        x, y = self._over(a, length - 1), self._over(b, length - 1)
        tail_x, tail_y = [], []
        while x != y:  # the deeper one steps up
            if self.end[x] >= self.end[y]:
                tail_x.append(self.piece[x])
                x = self.up[x][0]
            else:
                tail_y.append(self.piece[y])
                y = self.up[y][0]
        rest = length - self.end[x]
        return "".join(reversed(tail_x))[:rest] == "".join(reversed(tail_y))[:rest] if rest > 0 else True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        if a == b:
            return False
        low, high = 0, min(self.end[a], self.end[b])
        while low < high:
            middle = (low + high + 1) // 2
            if self.prefix(a, middle) == self.prefix(b, middle):
                low = middle
            else:
                high = middle - 1
        if not self._same(a, b, low):  # hashes collided
            return self.text(a) < self.text(b)
        if low == min(self.end[a], self.end[b]):
            return self.end[a] < self.end[b]
        return self.at(a, low) < self.at(b, low)


Best = list[tuple[int, int] | None]  # by state: cost and audit


def offer(best: Best, state: int, cost: int, audits: Audits, parent: int, piece: str) -> None:
    held = best[state]
    if held is not None and held[0] < cost:
        return
    node = audits.add(parent, piece)
    if held is None or cost < held[0] or audits.less(node, held[1]):
        best[state] = (cost, node)


def inserted(best: Best, audits: Audits) -> Best:
    """With inserts before the next row: none, one or two can be worth it."""
    best = list(best)
    for state in (0, 1, 3, 2):
        if best[state] is not None:
            cost, node = best[state]
            offer(best, TURN[state][0], cost + INSERT, audits, node, "I")
    return best


def edited(best: Best, initial: str, fault: str | None, audits: Audits) -> Best:
    """After one more row."""
    after: Best = [None] * STATES
    extra = TRUNCATED if fault == "truncated" else 0
    for state, held in enumerate(inserted(best, audits)):
        if held is None:
            continue
        cost, node = held
        offer(after, state, cost + DELETE, audits, node, "D")
        if fault not in ("blank", "duplicate"):
            if initial in STEP[state]:
                offer(after, STEP[state][initial], cost + KEEP + extra, audits, node, "K")
            offer(after, TURN[state][0], cost + REROLE + extra, audits, node, "R")
    return after


def table(rows: list[tuple[str, str | None]], before: tuple[int, ...]) -> list[tuple[int, int, int, str]]:
    """State before, state after, cost and audit of the best edits of ``rows`` (initial, fault)."""
    found = []
    for start in before:
        audits = Audits()
        best: Best = [None] * STATES
        best[start] = (0, 0)
        for initial, fault in rows:
            best = edited(best, initial, fault, audits)
        found += [(start, state, held[0], audits.text(held[1])) for state, held in enumerate(best) if held is not None]
    return found


def joined(tables: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]], str]:
    """Cost, and for each table the state before it and its audit; the inserts after the last row."""
    audits = Audits()
    best: Best = [None] * STATES
    best[0] = (0, 0)
    came: list[list[tuple[int, str] | None]] = []
    for own in tables:
        after: Best = [None] * STATES
        origin: list[tuple[int, str] | None] = [None] * STATES
        for start, state, cost, audit in own:
            if best[start] is None:
                continue
            held = after[state]
            offer(after, state, best[start][0] + cost, audits, best[start][1], audit)
            if after[state] != held:
                origin[state] = (start, audit)
        best = after
        came.append(origin)
    # Any state may be brought to an end by inserts.
    last: Best = [None] * STATES
    ways: dict[int, tuple[int, str]] = {}
    for state, held in enumerate(best):
        if held is None:
            continue
        end, tail = state, ""
        while end not in ENDS:
            end, tail = TURN[end][0], tail + "I"
        before = last[0]
        offer(last, 0, held[0] + INSERT * len(tail), audits, held[1], tail)
        if last[0] != before:
            ways[0] = (state, tail)
    state, tail = ways[0]
    steps = []
    for origin in reversed(came):
        start, audit = origin[state]
        steps.append((start, audit))
        state = start
    return last[0][0], steps[::-1], tail


def repaired(state: int, audit: str, rows: list[tuple[str, str]]) -> tuple[list[str], int]:
    """The lines ``role:text`` that the edits leave, and the state after them."""
    lines, at = [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        if edit == "K":
            role, text = rows[at]
            state = STEP[state][role[:1]]
        else:
            state, role = TURN[state]
            text = rows[at][1] if edit == "R" else ""
        at += edit != "I"
        lines.append(f"{role}:{text}")
    return lines, state


class Rows:
    """Rows gathered into record batches of about ``many`` rows or ``BYTES`` bytes."""

    def __init__(self, schema: pa.Schema, many: int = 2000):
        self.schema, self.many = schema, many
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: dict, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= self.many or self.size >= BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def schema_of(keys: pa.DataType, kinds: dict[str, str]) -> pa.Schema:
    """Arrow's names for the kinds of column used here."""
    named = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "conv": keys}
    lists = {f"array<{k}>": pa.list_(kind) for k, kind in named.items()}
    return pa.schema([(name, (named | lists)[kind]) for name, kind in kinds.items()])


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role`` and ``text`` after damage by crc32(id:turn) modulo 20: 0 drops a row, 1 empties it, 2 takes
    its sentence ends, 3 repeats it, 4 gives it to the user."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), filled(role).alias("role"), filled(text).alias("text"), (F.crc32(F.concat(filled(conv), F.lit(":"), filled(turn))) % 20).alias("h"))
    h = F.col("h")
    return rows.where(h != 0).select(
        "conv",
        "turn",
        F.when(h == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _alike(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


CHUNK = {
    "conv": "conv", "part": "int", "chunk": "long", "roles": "array<string>", "texts": "array<string>", "first": "string", "last": "string", "illegal": "long",
    "low": "long", "high": "long", "turns": "long", "before": "array<int>", "after": "array<int>", "costs": "array<long>", "audits": "array<string>", **{f: "long" for f in FAULTS},
}
NUMBERS = (*FAULTS, "illegal", "gaps", "cost")
CHOSEN = {"conv": "conv", "part": "int", "chunk": "long", "state": "int", "audit": "string", "tail": "string", **{n: "long" for n in NUMBERS}}
DONE = {"conv": "conv", **{n: "long" for n in NUMBERS}, "audit": "string", "repaired_sha256": "string"}


def ddl(kinds: dict[str, str], conv: str) -> str:
    return ", ".join(f"{name} {conv if kind == 'conv' else kind}" for name, kind in kinds.items())


def _chunks(keys: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted rows as chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        out = Rows(schema_of(keys, CHUNK))
        held: list[dict] = []
        size = number = 0
        before = None  # the row before
        fresh = False  # whether the held chunk surely opens its conversation

        def chunk() -> dict:
            turns = [r["turn"] for r in held if r["turn"] is not None]
            initials = [r["role"][:1] for r in held]
            entries = table([(r["role"][:1], r["fault"]) for r in held], (0,) if fresh else tuple(range(STATES)))
            found = dict(zip(("before", "after", "costs", "audits"), map(list, zip(*entries, strict=True)), strict=True))
            return found | {f: sum(r["fault"] == f for r in held) for f in FAULTS} | {
                "conv": held[0]["conv"], "part": part, "chunk": number, "roles": [r["role"] for r in held], "texts": [r["text"] for r in held], "first": initials[0], "last": initials[-1],
                "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)), "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
            }

        for batch in batches:
            for row in batch.to_pylist():
                same = before is not None and before["conv"] == row["conv"]
                if held and (not same or len(held) >= ROWS or size + len(row["text"]) > BYTES):
                    yield from out.add(chunk(), size)
                    number, held, size = number + 1, [], 0
                if not held:
                    fresh = before is not None and not same
                # Of equal rows at the first turn that holds them, the first is no duplicate.
                twin = same and all(before[c] == row[c] for c in ("turn", "role", "text"))
                if row["fault"] != "blank" and (row["later"] or twin):
                    row["fault"] = "duplicate"
                held.append(row)
                size += len(row["text"])
                before = row
        if held:
            yield from out.add(chunk())
        yield from out.rest()

    return run


def _summaries(keys: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks in order, without texts: of each the state before it and its audit; the first of a conversation has its figures."""

    def conversation(held: list[dict]) -> Iterator[dict]:
        cost, steps, tail = joined([list(zip(r["before"], r["after"], r["costs"], r["audits"], strict=True)) for r in held])
        lows = [r["low"] for r in held if r["low"] is not None]
        turns = sum(r["turns"] for r in held)
        illegal = sum(r["illegal"] for r in held)
        for a, b in zip(held, held[1:], strict=False):
            illegal += a["last"] + b["first"] not in LEGAL
            turns -= a["high"] is not None and a["high"] == b["low"]
        gaps = max(r["high"] for r in held if r["high"] is not None) - min(lows) + 1 - turns if lows else 0
        figures = {f: sum(r[f] for r in held) for f in FAULTS} | {"illegal": illegal, "gaps": gaps, "cost": cost}
        for r, (state, audit) in zip(held, steps, strict=True):
            last = r is held[-1]
            yield {"conv": r["conv"], "part": r["part"], "chunk": r["chunk"], "state": state, "audit": audit, "tail": tail if last else ""} | figures
            figures = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = Rows(schema_of(keys, CHOSEN)), []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv"] != row["conv"]:
                    for r in conversation(held):
                        yield from out.add(r)
                    held = []
                held.append(row)
        if held:
            for r in conversation(held):
                yield from out.add(r)
        yield from out.rest()

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired text of each chunk, with a line break before each line, and the state after it."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            lines, state = repaired(row["state"], row["audit"], list(zip(row["roles"], row["texts"], strict=True)))
            lines += repaired(state, row["tail"], [])[0]
            out.append("".join(f"\n{line}" for line in lines))
        names = [c for c in batch.schema.names if c not in ("roles", "texts", "state")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.string())], names=[*names, "repaired"])


def _hashes(keys: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted chunks as conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema_of(keys, DONE))
        first, digest, audit, begun = None, hashlib.sha256(), [], False
        row = lambda: {n: first[n] for n in ("conv", *NUMBERS)} | {"audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
        for batch in batches:
            for r in batch.to_pylist():
                if first is None or first["conv"] != r["conv"]:
                    if first is not None:
                        yield from out.add(row())
                    first, digest, audit, begun = r, hashlib.sha256(), [], False
                audit += [r["audit"], r["tail"]]
                digest.update(r["repaired"][0 if begun else 1 :].encode())
                begun = begun or bool(r["repaired"])
        if first is not None:
            yield from out.add(row())
        yield from out.rest()

    return run


def repair(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """One row per conversation of ``everyone`` (``conv``) from ``rows`` (``conv``, ``turn``, ``role``, ``text``)."""
    kind = rows.schema["conv"].dataType.simpleString()
    stripped = F.rtrim("text", F.lit(WHITE))
    fault = F.when(stripped == "", "blank").when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), "truncated")
    digest = F.sha2(F.concat("role", F.lit("\0"), "text").cast("binary"), 256)
    named = stored(rows.withColumns({"fault": fault, "digest": digest}), "damaged")
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # nulls first
    same = named.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = light(stored(same.select(F.col("conv").alias("c"), F.col("digest").alias("d"), "first"), "repeats"))
    told = named.join(same, _alike("conv", "c") & (F.col("digest") == F.col("d")), "left")
    told = told.select("conv", "turn", "role", "text", "fault", F.coalesce(place > F.col("first"), F.lit(False)).alias("later"))
    order = ("conv", F.col("turn").asc_nulls_first(), "role", "text")
    ranged = told.repartitionByRange(*order).sortWithinPartitions(*order)
    arrow = _arrow_type(rows, "conv")
    chunks = stored(ranged.mapInArrow(_chunks(arrow), ddl(CHUNK, kind)), "chunks")

    facts = chunks.drop("roles", "texts").repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    chosen = stored(facts.mapInArrow(_summaries(arrow), ddl(CHOSEN, kind)), "chosen")

    held = chunks.select("part", "chunk", "roles", "texts").join(chosen, ["part", "chunk"])
    numbers = ", ".join(f"{n} long" for n in NUMBERS)
    texts = held.mapInArrow(_texts, f"part int, chunk long, conv {kind}, audit string, tail string, {numbers}, repaired string")
    streams = texts.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    done = streams.mapInArrow(_hashes(arrow), ddl(DONE, kind))
    zero, nothing = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    return everyone.select(F.col("conv").alias("c")).distinct().join(done, _alike("c", "conv"), "left").select(
        F.col("c").alias("conv_id"), *[F.coalesce(x, zero).alias(x) for x in ("gaps", *FAULTS, "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def audit(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damages the rows of ``df`` and repairs each conversation; one row per id of ``df``."""
    return repair(damaged(df, conv, turn, role, text), df.select(F.col(conv).alias("conv")))
