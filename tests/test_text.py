"""Folding against the same steps over Python's own character tables."""

from __future__ import annotations

import re
import sys
import unicodedata

from tradewind.functions import text


def plain(value: str) -> str:
    kept = "".join(x for x in unicodedata.normalize("NFKD", value) if not unicodedata.combining(x)).lower()
    linkless = re.sub(r"http\S+|www\.\S+", " ", kept)
    return " ".join(re.sub(r"[^a-z\s]", " ", linkless).split())


def test_every_character(spark):
    """Each character between two letters, and runs of those that decompose into several."""
    codes = [*range(1, 0xD800), *range(0xE000, sys.maxunicode + 1)]
    values = ["".join(f"x{chr(c)}y " for c in codes[i : i + 512]) for i in range(0, len(codes), 512)]
    values += ["é Ⅱ ﬁ", "ﬁﬂ℡㎏", "ÇÃO ﬀoo", "see HTTP://a.b/c then www.x.y end", "", " \t\n", "123 !!"]
    rows = spark.createDataFrame([(v,) for v in values], "t string").select("t", text.normalise(text.F.col("t")).alias("n")).collect()
    for row in rows:
        assert row["n"] == plain(row["t"])
    assert {r["t"]: r["n"] for r in rows}["é Ⅱ ﬁ"] == "e ii fi"


def test_letters_written_out_cost_no_scan_of_ascii(spark):
    """Texts are cut at characters of several letters, at the first and last place, too; each is translated once."""
    values = ["Ⅳ end ﬁ", "ﬃ", "a🄐b", "ＡＢ ㎏x", "plain", "日本 ™", "", None]
    rows = spark.createDataFrame([(v,) for v in values], "t string").select("t", text.normalise(text.F.col("t")).alias("n"))
    assert {r["t"]: r["n"] for r in rows.collect()} == {v: None if v is None else plain(v) for v in values}
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
