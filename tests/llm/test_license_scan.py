from __future__ import annotations

import re
import time

import pytest

from oracle.check import compare, connect
from tradewind.llm import license_scan
from tradewind.llm.queries import QUERIES
from tradewind.llm.sql import STATEMENTS


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_equals_sql(spark, sf_dir, name):
    assert compare(connect(sf_dir), QUERIES[name](spark, sf_dir), STATEMENTS[name]) is None


def scanned(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.scan(frame).collect()}


def test_base_by_brute_force(spark):
    texts = [
        None, "", "MIT License", "mit-license MIT\nLICENSE", "mit mit license license", "The General Public License, general public", "x" * 50_000 + " Apache License",
        "submit license", "mit licenseé", "MİT LICENSE", "general public mit license general public license " * 300, "apache", "GNU General\x00Public_License",
    ]
    found = scanned(spark, texts)
    for i, text in enumerate(texts):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        hits = [(at, label) for label, phrase in license_scan.BASE for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split()]
        row = found[i]
        assert (row["n_words"], row["n_base"]) == (len(words), len(hits)), text
        assert (row["first_word"], row["last_word"]) == (min((h[0] for h in hits), default=None), max((h[0] for h in hits), default=None))
        assert row["base_labels"] == ",".join(sorted({h[1] for h in hits}))
        assert 0 <= row["score"] <= 1 and (row["score"] == 1 or not hits)


def test_notices_with_edits(spark):
    notice = dict(license_scan.NOTICES)["bsd"].split()
    edited = notice[:4] + ["really"] + notice[4:9] + notice[10:]
    texts = [" ".join(["some", "text", *notice, "more"]), " ".join(edited), " ".join(notice[:5]), " ".join(x for w in notice for x in (w, "gap", "gap", "gap"))]
    found = scanned(spark, texts)
    assert found[0]["labels"] == "bsd" and found[0]["score"] == 1.0 and [tuple(s) for s in found[0]["spans"]] == [(2, 16, "bsd")]
    assert found[1]["labels"] == "bsd" and 0.8 <= found[1]["score"] < 1
    assert [found[i]["labels"] for i in (2, 3)] == ["", ""]
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rows_stay_apart(spark):
    rows = [(1, "mit license", "a", 1), (1, "mit license", "b", 2), (None, "apache license", "c", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label string, row int")
    assert sorted((r["n_base"], r["labels"]) for r in license_scan.scan(frame).collect()) == [(1, "apache"), (1, "mit"), (1, "mit")]


def test_versions_and_short_notices(spark):
    """One word changed, other versions, and only the best of overlapping templates."""
    cases = {
        "Licensed under CC BY-NC 4.0": "cc-by-nc", "x Licensed under CC BY-NC 3.0 y": "cc-by-nc", "Licensed under CC BY 3.0": "cc-by", "licensed under CC BY-SA 3.0.": "cc-by-sa",
        "Licensed under CC BY 4.0": "cc-by", "Licensed under CC BY-ND 4.0": "", "licenced under CC BY 4.0": "cc-by", "Licensed under the CC BY-NC 2.5": "cc-by-nc",
        "GNU Affero General Public Licence": "agpl", "released under the BSD license": "", "released under MIT terms": "", "released by others under the license": "",
        "Licensed under a Creative Commons Attribution NonCommercial 3.0 International License": "cc-by-nc", "all rights are reserved": "", "All Rights Reserved.": "proprietary",
        "Licensed under CC BY 4.0, parts licensed under CC BY-NC 4.0": "cc-by,cc-by-nc", "of the license of the license " * 40 + "Licensed under CC BY 1.0": "cc-by",
        "licensed under the Apache License, Version 1.1": "apache", "distributed under the MIT license": "mit",
    }
    found = scanned(spark, list(cases))
    assert {text: found[i]["labels"] for i, text in enumerate(cases)} == cases


def test_a_very_long_text_costs_no_more_than_its_words(spark):
    """200,000 words in one row: every place is found, in time that follows the length."""
    texts = ["mit license and more words here " * 5_000, ("filler mit license " * 66_000) + "licensed under cc by nc 4 0"]
    began = time.perf_counter()
    found = scanned(spark, texts)
    assert time.perf_counter() - began < 60
    assert (found[0]["n_words"], found[0]["n_base"], found[0]["last_word"]) == (30_000, 5_000, 29_994)
    assert found[1]["n_base"] == 66_000 and found[1]["labels"] == "cc-by-nc,mit"
