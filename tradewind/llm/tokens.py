"""The tokenizers library over many texts: each distinct piece of text is encoded once.

A tokenizer never joins characters across the places where texts are cut here, so the ids of the
parts, one after another, are those of the text. ``words`` holds for tokenizers that drop white
space; ``spaced`` for byte-level ones, whose tokens begin at a lone space between other characters.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT = 400_000
AT_ONCE = 20_000
LONGEST = 64
CUT = re.compile(r"(?<=\S)(?= \S)")
# A space at an end of the text or beside other white space.
ODD = r"^ | $|[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] | [\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of several runs, one run after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


class Encoder:
    """Ids of distinct strings are kept while a Python worker lives: at most ``KEPT`` strings of at most
    ``LONGEST`` bytes."""

    def __init__(self, path: str):
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = vars(tokenizers).setdefault("_kept_by_path", {})  # outlives the task, unlike this module
        if path not in held:
            tokenizer = tokenizers.Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            held[path] = {"tokenizer": tokenizer, "strings": pa.array([], pa.string()), "ids": np.empty(0, np.uint32), "counts": np.empty(0, np.int64)}
        self.state = held[path]
        self.tokenizer = self.state["tokenizer"]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids one text after another, and how many each has."""
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for start in range(0, len(texts), AT_ONCE):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[start : start + AT_ONCE], add_special_tokens=False)]
            counts.append(np.array([len(x) for x in found], np.int64))
            ids.append(np.fromiter((i for x in found for i in x), np.uint32, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def distinct(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids known now, and start and number of those of each string (distinct strings)."""
        state = self.state
        place = pc.index_in(strings, value_set=state["strings"])
        new = strings.filter(pc.is_null(place))
        ids, counts = self.encode(new.to_pylist())
        before = len(state["strings"])
        places = place.to_numpy(zero_copy_only=False)
        known = np.where(np.isnan(places), -1, places).astype(np.int64) if places.dtype.kind == "f" else places.astype(np.int64)
        known[known < 0] = before + np.arange(len(new))
        all_ids, all_counts = np.concatenate([state["ids"], ids]), np.concatenate([state["counts"], counts])
        if before < KEPT and len(new):
            short = pc.less_equal(pc.binary_length(new), LONGEST).to_numpy(zero_copy_only=False)
            state["strings"] = pa.concat_arrays([state["strings"], new.filter(pa.array(short))])
            starts = np.cumsum(counts) - counts
            state["ids"] = np.concatenate([state["ids"], ids[spans(starts[short], counts[short])]])
            state["counts"] = np.concatenate([state["counts"], counts[short]])
        starts = np.cumsum(all_counts) - all_counts
        return all_ids, starts[known], all_counts[known]

    def _gather(self, strings: pa.Array, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        coded = strings.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        ids, starts, counts = self.distinct(coded.dictionary)
        own = counts[codes]
        return ids[spans(starts[codes], own)], np.bincount(owner, own, n).astype(np.int64)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        lists = pc.ascii_split_whitespace(texts)
        return self._gather(lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), len(texts))

    def spaced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, ODD)
        plain = texts.filter(pc.invert(odd))
        lists = pc.split_pattern(plain, " ")
        parts = lists.flatten()
        owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.ones(len(owner), bool)
        first[1:] = owner[1:] != owner[:-1]
        # Every part but a text's first has its space before it.
        whole = pa.concat_arrays([pc.binary_join_element_wise(" ", coded.dictionary, ""), parts.filter(pa.array(first))])
        codes[first] = len(coded.dictionary) + np.arange(int(first.sum()))
        chunks = [CUT.split(t) for t in texts.filter(odd).to_pylist()]
        flat = pa.array([c for own in chunks for c in own], pa.string())
        codes = np.concatenate([codes, len(whole) + np.arange(len(flat))])
        places = np.concatenate([np.flatnonzero(~odd.to_numpy(zero_copy_only=False))[owner] if len(owner) else owner,
                                 np.repeat(np.flatnonzero(odd.to_numpy(zero_copy_only=False)), [len(c) for c in chunks])]).astype(np.int64)
        order = np.argsort(places, kind="stable")
        merged = pa.concat_arrays([whole, flat]).dictionary_encode()
        ids, starts, counts = self.distinct(merged.dictionary)
        codes = merged.indices.to_numpy(zero_copy_only=False)[codes[order]]
        own = counts[codes]
        return ids[spans(starts[codes], own)], np.bincount(places[order], own, len(texts)).astype(np.int64)
