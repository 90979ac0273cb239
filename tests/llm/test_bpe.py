from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewind.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts() -> list[str | None]:
    rng = random.Random(3)
    few = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    return [
        None, "", " ", "  two  spaces ", "a\n\n b \n c", "tab\t x", "<|endoftext|> a<|endoftext|>", "don't 've 12345 ab12",
        "日本語 テキスト 　wide", "é é ́a", "\x1c \x1d x", "a\x85 b", "a" * 20_000, " " * 9_000 + "x", "\n" * 5_000 + "end",
        few("ab", 30_000), few("the ing", 20_000), few("thering", 30_001) + "<|endoftext|>" + few("0123456789", 9_000),
        "=" * 12_345 + few("=-_", 8_000), "x " + few("日本語é", 9_000) + " y", few("abcdefgh", 5_000) + " plain words after it. " * 40,
    ]


def test_as_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(texts())]
    found = {r["doc_id"]: (list(r["ids"]), r["decoded"]) for r in bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), PATH, decoded=True).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i] == (ids, library.decode(ids, skip_special_tokens=False)), i


def test_decode_of_any_ids(spark, library):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(50257) for _ in range(n)]) for i, n in enumerate((0, 1, 5, 300))] + [(9, None)]
    found = {r["doc_id"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    assert found == {i: library.decode(ids or [], skip_special_tokens=False) for i, ids in rows}


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 50])
def test_tree_of_any_leaf(library, leaf):
    rng = random.Random(leaf)
    encode = lambda run: [t.id for t in library.model.tokenize(run)]
    spell = lambda ids: "".join(map(library.id_to_token, ids))
    for letters in ("a", "ab", "thering", "0123", "=-", "theandofingation"):
        run = "".join(rng.choice(letters) for _ in range(400))
        assert bpe.tree([encode(x) for x in bpe.halves(run, leaf)], encode, spell) == encode(run)


def test_empty_and_repeated(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, decoded=True).count() == 0
    rows = [(1, "same text", "x", 1)] * 2 + [(None, "b" * 9_000, "y", 2)] * 2
    assert bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string, row int"), PATH).count() == 4


def test_seams_anywhere(library):
    """Halves of any text cut anywhere join to the ids of the whole, words, spaces and added tokens included."""
    rng = random.Random(8)
    whole = lambda text: library.encode(text, add_special_tokens=False).ids
    bits = ["the", " of", "  ", "\n", " 12", "don't", "é", "日本", "<|endoftext|>", " <|endoftext|>", "...", " a", "\t", "ing", "\u3000", "$%", "x" * 30]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 160)))
        cut = rng.randint(0, len(text))
        sides = [(t, whole(t)) for t in (text[:cut], text[cut:])]
        assert bpe.seamless(*sides, whole) == (text, whole(text))


def test_long_ordinary_texts_are_halved(spark, library, monkeypatch):
    """A row of the test table is long enough to be dealt out, and so is every text once the bound is low."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert table.where(f"length(text) >= {bpe.LONG}").count() > 0
    for long, half, rows in ((bpe.LONG, bpe.HALF, table.where(f"length(text) >= {bpe.LONG}")), (60, 25, table.where("doc_id < 60"))):
        monkeypatch.setattr(bpe, "LONG", long)
        monkeypatch.setattr(bpe, "HALF", half)
        shuffled = rows.repartition(5).orderBy("text").repartition(3)
        found = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(shuffled, PATH).collect()}
        assert found == {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids for r in rows.collect()}
