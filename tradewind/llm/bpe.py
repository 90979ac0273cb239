"""Byte-level BPE over whole texts; long ones by tree concatenation.

A text of ``LONG`` or more characters is halved until its parts have at most ``HALF``; the parts are rows of
their own that are encoded side by side on all executors, and neighbours are joined pair by pair up the
tree. A join re-encodes a window around the seam, from a place before it to a place after it where the
pre-tokenizer always splits, and widens it until what it re-encodes are the ids of both sides at its
ends. A run of ``LEAF`` or more characters that nothing splits is halved in the same way by itself; its
windows are tokens, widened until the window's first and last token (or the run's ends) are those of the
two sides: as a token sequence is the encoding of its text exactly if every two neighbours are, the
joined ids are those of the whole run. Shorter texts are encoded where they lie, each distinct chunk once.

Null text counts as empty and has no ids. Rows with equal ids or texts are encoded row by row; long rows
are numbered and written once, whatever made the table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import by_slice, slices, stored, strings
from tradewind.llm.tokens import Encoder

LEAF = 4096
LONG, HALF = 16_384, 8192
WINDOW = 64  # characters on each side of a seam, at first
SLICE = 2_000_000
# Between other characters a lone space always begins a chunk of its own word.
BREAK = re.compile(r"(?<=\S)(?= \S)")


def halves(run: str, leaf: int = LEAF) -> list[str]:
    if len(run) <= leaf:
        return [run]
    middle = len(run) // 2
    return halves(run[:middle], leaf) + halves(run[middle:], leaf)


def concatenate(left: list[int], right: list[int], encode: Callable[[str], list[int]], spell: Callable[[list[int]], str]) -> list[int]:
    """Ids of two encoded texts joined, for a text that no rule splits in between."""
    if not left or not right:
        return left or right
    width = 4
    while True:
        a, b = left[-width:], right[:width]
        window = encode(spell(a + b))
        whole_left, whole_right = width >= len(left), width >= len(right)
        if len(window) > 1 or (whole_left and whole_right):
            if (whole_left or window[0] == a[0]) and (whole_right or window[-1] == b[-1]):
                return left[: len(left) - len(a)] + window + right[len(b) :]
        width *= 2


def tree(leaves: list[list[int]], encode: Callable[[str], list[int]], spell: Callable[[list[int]], str]) -> list[int]:
    """The leaves' ids joined level by level."""
    while len(leaves) > 1:
        paired = [concatenate(leaves[i], leaves[i + 1], encode, spell) for i in range(0, len(leaves) - 1, 2)]
        leaves = paired + leaves[len(paired) * 2 :]
    return leaves[0] if leaves else []


def seamless(left: tuple[str, list[int]], right: tuple[str, list[int]], encode: Callable[[str], list[int]]) -> tuple[str, list[int]]:
    """Two encoded texts joined."""
    (a, own), (b, other) = left, right
    width = WINDOW
    while True:
        starts = [m.start() for m in BREAK.finditer(a, max(0, len(a) - width))] if width < len(a) else [0]
        ends = [m.start() for m in BREAK.finditer(b, 0, width)] if width < len(b) else [len(b)]
        if starts and ends:
            tail, head = encode(a[starts[0] :]), encode(b[: ends[-1]])
            if own[len(own) - len(tail) :] == tail and other[: len(head)] == head:  # the sides agree at both ends
                return a + b, own[: len(own) - len(tail)] + encode(a[starts[0] :] + b[: ends[-1]]) + other[len(head) :]
        width *= 2


def _spelling(encoder: Encoder) -> tuple[Callable[[str], list[int]], Callable[[list[int]], str]]:
    """Encoding of a run as the model's own letters, and the letters of ids."""
    model, names = encoder.tokenizer.model, encoder.tokenizer.id_to_token
    return lambda run: [t.id for t in model.tokenize(run)], lambda ids: "".join(names(i) for i in ids)


def _halved(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``row`` and ``ids`` of long texts without long runs: halves as rows of their own, joined text by text."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            own, leaf, parts = [], [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = halves(text, HALF)
                own += [row] * len(found)
                leaf += range(len(found))
                parts += found
            yield pa.RecordBatch.from_pydict({"row": pa.array(own, pa.int64()), "leaf": pa.array(leaf, pa.int64()), "text": pa.array(parts, pa.string())})

    def encode(batch: pa.RecordBatch) -> dict:
        ids, counts = Encoder(tokenizer).spaced(strings(batch.column("text")))
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return {"row": batch.column("row"), "leaf": batch.column("leaf"), "ids": pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))}

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        encoder = Encoder(tokenizer)
        whole = lambda text: encoder.tokenizer.encode(text, add_special_tokens=False).ids
        # Ids spell their text byte by byte, so it need not travel with them.
        level = [(_spelt(ids, np.array([0, len(ids)]), encoder)[0].as_py(), ids.tolist()) for ids in rows.sort_values("leaf")["ids"]]
        while len(level) > 1:
            paired = [seamless(level[i], level[i + 1], whole) for i in range(0, len(level) - 1, 2)]
            level = paired + level[len(paired) * 2 :]
        return pd.DataFrame({"row": rows["row"].iloc[:1], "ids": [level[0][1]]})

    dealt = rows.select("row", "text").mapInArrow(deal, "row long, leaf long, text string").repartition("row", "leaf")
    encoded = by_slice(dealt, "text", encode, "row long, leaf long, ids array<int>")
    return encoded.groupBy("row").applyInPandas(join, "row long, ids array<int>")


def _run(text: str) -> str:
    """A condition: a run that nothing splits."""
    return f"length({text}) >= {LEAF} AND {text} RLIKE '\\\\S{{{LEAF}}}|\\\\s{{{LEAF}}}'"


def _parts(df: DataFrame, tokenizer: str) -> DataFrame:
    """``row``, ``part``, ``leaf`` and the model's own letters of the runs in it (``special``: an added token)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        added = [t.content for t in encoder.tokenizer.get_added_tokens_decoder().values()]
        seams = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        for batch in slices(batches, "text", SLICE):
            out: dict[str, list] = {"row": [], "part": [], "leaf": [], "runs": [], "special": []}
            for row, text in zip(batch.column("row").to_pylist(), strings(batch.column("text")).to_pylist(), strict=True):
                part = 0

                def put(leaf: int, runs: list[str], special: bool = False) -> None:
                    for name, value in zip(out, (row, part, leaf, runs, special), strict=True):  # noqa: B023
                        out[name].append(value)

                for segment in seams.split(text) if seams else [text]:
                    if segment in added:
                        put(0, [segment], special=True)
                        part += 1
                        continue
                    short: list[str] = []
                    for letters, _ in encoder.tokenizer.pre_tokenizer.pre_tokenize_str(segment):
                        if len(letters) < LEAF:
                            short.append(letters)
                            if sum(map(len, short[-1:])) and len(short) >= 1024:
                                put(0, short)
                                part, short = part + 1, []
                            continue
                        if short:
                            put(0, short)
                            part, short = part + 1, []
                        for leaf, half in enumerate(halves(letters)):
                            put(leaf, [half])
                        part += 1
                    if short:
                        put(0, short)
                        part += 1
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(out["row"], pa.int64()), "part": pa.array(out["part"], pa.int64()), "leaf": pa.array(out["leaf"], pa.int64()),
                "runs": pa.array(out["runs"], pa.list_(pa.string())), "special": pa.array(out["special"], pa.bool_()),
            })

    return df.select("row", "text").mapInArrow(run, "row long, part long, leaf long, runs array<string>, special boolean")


def _dealt(df: DataFrame, tokenizer: str) -> DataFrame:
    """``row`` and ``ids`` of texts with long runs."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        encode_run, _ = _spelling(encoder)
        for batch in batches:
            found = []
            for runs, special in zip(batch.column("runs").to_pylist(), batch.column("special").to_pylist(), strict=True):
                found.append([encoder.tokenizer.token_to_id(runs[0])] if special else [i for run in runs for i in encode_run(run)])
            columns = [batch.column(c) for c in ("row", "part", "leaf")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int32()))], names=["row", "part", "leaf", "ids"])

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        encode_run, spell = _spelling(Encoder(tokenizer))
        ids = tree([list(map(int, x)) for x in rows.sort_values("leaf")["ids"]], encode_run, spell)
        return pd.DataFrame({"row": rows["row"].iloc[:1], "part": rows["part"].iloc[:1], "ids": [ids]})

    parts = _parts(df, tokenizer).repartition("row", "part", "leaf").mapInArrow(encode, "row long, part long, leaf long, ids array<int>")
    whole = parts.groupBy("row", "part").applyInPandas(join, "row long, part long, ids array<int>")
    return whole.groupBy("row").agg(F.flatten(F.sort_array(F.collect_list(F.struct("part", "ids")))["ids"]).alias("ids"))


def encode(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """``doc_id`` and ``ids`` of each row; with ``decoded`` also the text that the ids spell."""
    frame = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded

    def work(batch: pa.RecordBatch) -> dict:
        encoder = Encoder(tokenizer)
        ids, counts = encoder.spaced(strings(batch.column("text")))
        return _columns(batch.column("doc_id"), ids, counts, encoder, decoded)

    long = f"length(text) >= {LONG} OR ({_run('text')})"
    here = by_slice(frame.where(f"NOT ({long})"), "text", work, schema)
    rows = stored(frame.where(long).withColumns({"row": F.monotonically_increasing_id(), "runs": F.expr(_run("text"))}), "long")
    ids = _dealt(rows.where("runs"), tokenizer).union(_halved(rows.where("NOT runs"), tokenizer))
    far = rows.select("row", "doc_id").join(ids, "row", "left").select("doc_id", "ids")
    if decoded:
        far = decode(far, tokenizer)
    return here.union(far.select(*here.columns))


def _columns(doc_id: pa.Array, ids: np.ndarray, counts: np.ndarray, encoder: Encoder, decoded: bool) -> dict:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    out = {"doc_id": doc_id, "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))}
    if decoded:
        out["decoded"] = _spelt(ids, ends, encoder)
    return out


def _spelt(ids: np.ndarray, ends: np.ndarray, encoder: Encoder) -> pa.Array:
    """Texts that runs of ids spell: tokens' bytes one after another, invalid ones replaced."""
    if "bytes" not in encoder.state:
        encoder.state["bytes"] = token_bytes(encoder.tokenizer)
    table = encoder.state["bytes"]
    own = ids.tolist()
    return pa.array([b"".join([table[i] for i in own[a:b]]).decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string())


def token_bytes(tokenizer) -> list[bytes]:  # noqa: ANN001
    """Bytes of every id. Byte-level vocabularies write printable Latin-1 bytes as themselves and the others,
    in order, as the characters from U+0100 on; added tokens stand for their own text."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    names = [tokenizer.id_to_token(i) or "" for i in range(size)]
    return [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]


def decode(df: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id``, ``ids`` and the text that the ids spell; no ids spell an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(counts)])
            values = lists.flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": lists, "decoded": _spelt(values, ends, encoder)})

    kind = df.schema["doc_id"].dataType.simpleString()
    frame = df.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return frame.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
