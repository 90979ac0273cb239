"""Text folding and n-gram columns, all as built-in expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, functions as F


def _folds() -> tuple[dict[str, str], dict[str, str], str]:
    """What compatibility decomposition without combining marks makes of each character, lower-cased and
    with blanks for all but a to z: single characters, longer strings, and characters that vanish."""
    single, longer, gone = {}, {}, []
    for code in (*range(0x20), *range(0x7F, 0xD800), *range(0xE000, sys.maxunicode + 1)):
        parts = [x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x)]
        folded = "".join(x if "a" <= x <= "z" else " " for x in "".join(parts).lower())
        if not parts:
            gone.append(chr(code))
        elif len(folded) == 1 and (folded != " " or parts[0].isspace()):
            single[chr(code)] = folded
        elif folded.strip():
            longer[chr(code)] = folded
    return single, longer, "".join(gone)


_SINGLE, _LONGER, _GONE = _folds()


def _class_of(characters: dict[str, str]) -> str:
    """A regular expression class of the characters, by ranges: single ones are tried one after another."""
    codes = set(map(ord, characters))
    starts = sorted(x for x in codes if x - 1 not in codes)
    ends = sorted(x for x in codes if x + 1 not in codes)
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in zip(starts, ends, strict=True)) + "]"


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is worked out once however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


_ANY_LONGER = _class_of(_LONGER)


def _spelt_out(text: Column) -> Column:
    """Characters that decompose into several letters, such as ligatures and Roman numerals, written out.

    None of them is in ASCII, so a text of as many bytes as characters is left alone unread; others are cut at
    these characters alone."""
    table = F.map_from_arrays(F.lit(list(_LONGER)), F.lit(list(_LONGER.values())))
    parts = F.split(text, f"(?={_ANY_LONGER})")
    first, rest = (lambda x: F.substring(x, 1, 1)), (lambda x: x.substr(F.lit(2), F.length(x)))
    written = F.array_join(F.transform(parts, lambda x: F.concat(F.coalesce(F.element_at(table, first(x)), first(x)), rest(x))), "")
    return F.when((F.octet_length(text) > F.length(text)) & text.rlike(_ANY_LONGER), written).otherwise(text)


def normalise(text: Column) -> Column:
    """Decompose, drop combining marks, fold case, then keep only letters and single spaces.

    Links go first, so that their letters do not survive as words.
    """
    source, target = "".join(_SINGLE), "".join(_SINGLE.values())
    folded = F.lower(_with(F.translate(text.cast("string"), source + _GONE, target), _spelt_out))
    no_links = F.regexp_replace(folded, r"(?U)http\S+|www\.\S+", " ")
    letters = F.regexp_replace(no_links, r"[^a-z]+", " ")
    return F.trim(letters)


def words(clean_text: Column) -> Column:
    return F.split(clean_text, " ")


def word_ngrams(clean_text: Column) -> Column:
    """Single words of two or more letters, followed by their adjacent pairs."""
    tokens = F.filter(words(clean_text), lambda w: F.length(w) >= 2)
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(tokens, pairs)


def char_ngrams(clean_text: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside each space-padded word."""

    def grams(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))

        def of_size(n: int) -> Column:
            starts = F.length(padded) - (n - 1)
            return F.when(
                starts >= 1,
                F.transform(F.sequence(F.lit(1), starts), lambda i: F.substring(padded, i, F.lit(n))),
            ).otherwise(F.array().cast("array<string>"))

        return F.concat(*[of_size(n) for n in range(low, high + 1)])

    return F.flatten(F.transform(F.filter(words(clean_text), lambda w: w != ""), grams))
