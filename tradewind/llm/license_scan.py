"""License notices by diagonal voting, in DataFrame operations alone.

A text's words (runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lowered)
give rolling two-word hashes, all of which are joined with the template positions that hold the
same hash. A match at word i of the text and j of a template votes for diagonal i - j. A template
that a text holds word for word fills one diagonal; an added or missing word moves the rest to a
neighbouring one, so each diagonal is tried alone and together with those at most ``NEAR`` from it.
Such a span is verified word by word: its edit distance from the template may be one in five words,
one in templates of four to nine, none in shorter ones. Numbers are equal to each other, so versions
vary. Words that tell licenses apart (``TELLING``) must be the template's own, in its order. Of
overlapping spans that hold, the one with most words of its template is kept.

The base phrases are templates as well, but count only where one diagonal is full. Null text counts
as empty; rows are judged one by one, whatever their ids; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
# Notices as they stand in files: label, words.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("proprietary", "all rights reserved"),
)
NEAR = (0, 1, 2, 5)
TELLING = "mit apache gnu lesser library affero mozilla cc by sa nc nd creative commons attribution noncommercial noderivatives noderivs sharealike".split()
NUMBER = "^[0-9]+$"


def budget(n: int) -> int:
    """Words of a template of ``n`` that may be changed, added or missing."""
    return max(1, n // 5) if n > 3 else 0


def code(words: list[str]) -> str:
    """A character a word: its first place in the template, or ``#`` for numbers."""
    return "".join("#" if w.isdecimal() else chr(65 + words.index(w)) for w in words)


def windows(words: str) -> Column:
    """Hashes of all two-word windows, every number alike; null for two numbers."""
    w = F.transform(words, lambda x: F.when(x.rlike(NUMBER), "#").otherwise(x))
    pair = lambda a, b: F.when((a != "#") | (b != "#"), F.xxhash64(a, b))
    pairs = F.zip_with(w, F.slice(w, 2, F.greatest(F.size(words) - 1, F.lit(0))), pair)
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def templates(spark: SparkSession) -> DataFrame:
    """``h``, ``template`` number, place ``j`` and ``known``, its words and bounds, of every two-word window; number -1 meets every text once."""
    rows = []
    for i, (label, phrase) in enumerate((*BASE, *NOTICES)):
        words, base = phrase.split(), i < len(BASE)
        edits = 0 if base else budget(len(words))
        plain = sum(not (a.isdecimal() and b.isdecimal()) for a, b in zip(words, words[1:], strict=False))
        least = len(words) - 1 if base else max(1, plain - 2 * edits)
        rows.append((i, label, base, words, code(words), [w for w in words if w in TELLING], edits, least))
    schema = "template int, label string, base boolean, words array<string>, code string, telling array<string>, edits int, least int"
    frame = spark.createDataFrame(rows, schema)
    known = frame.select(*frame.columns, F.posexplode(windows("words")).alias("j", "h")).where("h IS NOT NULL")
    each = spark.createDataFrame([(-1, None, False, [], "", [], 0, 0, 0, 0)], f"{schema}, j int, h long")
    return known.union(each)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` (the largest share of a template's words held) and the verified ``spans``."""
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), CAPITALS, SMALL)
    words = df.select(F.col(key).alias("doc_id"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("w")).withColumn("row", F.monotonically_increasing_id())
    w = F.col("w")
    # Hashes stand in a column of their own before they are dealt out: so the explode is compiled, and a row of it
    # points at the words instead of copying them. The outer form asks no size first, which would hash all words twice.
    hashed = words.select("row", "doc_id", "w", F.size(w).cast("long").alias("n_words"), F.concat(F.array(F.lit(0).cast("long")), windows("w")).alias("hashes"))
    grams = hashed.select("row", "doc_id", "w", "n_words", F.posexplode_outer("hashes").alias("p", "g"))
    facts = templates(df.sparkSession)
    known = F.broadcast(facts.select("template", F.size("words").alias("n"), "j", "h"))  # a few hundred rows
    votes = grams.join(known, (F.col("g") == F.col("h")) & ((F.col("p") == 0) == (F.col("template") == -1)))
    # Each vote brings the words around its diagonal, all that any span through it can hold.
    diagonal, wide = F.col("p") - 1 - F.col("j"), max(NEAR)
    begin = F.greatest(diagonal - wide, F.lit(0))
    around = F.when(F.col("template") >= 0, F.slice(w, begin + 1, F.col("n") + 2 * wide))
    votes = votes.select("row", "doc_id", "n_words", "template", "p", diagonal.alias("diagonal"), begin.alias("begin"), around.alias("around")).repartition("row")

    keys = ("row", "doc_id", "n_words", "template")
    diagonals = votes.groupBy(*keys, "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("p").alias("low"), F.max("p").alias("high"), F.first("begin").alias("begin"), F.first("around").alias("around"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    tried = F.array(*[F.struct(F.sum("votes").over(f).alias("votes"), (F.min("low").over(f) - 1).alias("start"), F.max("high").over(f).alias("stop")) for f in (along.rangeBetween(-n, n) for n in NEAR)])
    facts = F.broadcast(facts.drop("j", "h").dropDuplicates(["template"]))
    spans = diagonals.withColumn("tried", F.array_distinct(tried)).join(facts, "template")
    # A base phrase counts where one diagonal is full.
    spans = spans.withColumn("tried", F.when(F.col("base"), F.slice("tried", 1, 1)).otherwise(F.col("tried")))
    spans = spans.withColumn("tried", F.filter("tried", lambda t: t["votes"] >= F.col("least")))
    # Two numbers give no vote: a template that ends in them may go one word further.
    further = F.transform("tried", lambda t: F.struct(t["votes"].alias("votes"), t["start"].alias("start"), (t["stop"] + 1).alias("stop")))
    spans = spans.withColumn("tried", F.when(F.col("code").endswith("##"), F.concat("tried", further)).otherwise(F.col("tried")))
    spans = spans.select("*", F.explode_outer("tried").alias("t")).where(F.col("t").isNotNull() | (F.col("template") < 0))
    inside = F.slice("around", F.col("t.start") - F.col("begin") + 1, F.col("t.stop") - F.col("t.start") + 1)
    place = lambda x: F.array_position("words", x).cast("int")
    coded = F.array_join(F.transform("inside", lambda x: F.when(x.rlike(NUMBER), "#").when(place(x) > 0, F.char(place(x) + 64)).otherwise("~")), "")
    own = F.filter("inside", lambda x: x.isin(TELLING)) == F.col("telling")
    spans = spans.withColumn("inside", inside).withColumn("off", F.when(own, F.levenshtein(coded, F.col("code"))))
    n = F.size("words")
    spans = spans.withColumn("held", F.when((F.col("template") >= 0) & (F.col("off") <= F.col("edits")), (n - F.col("off")) / n))

    found, base = F.col("held") > 0, F.col("base") & (F.col("held") > 0)
    start, stop = F.col("t.start").cast("long"), (F.col("t.stop") + 1).cast("long")
    span = F.struct((F.col("off") - n).alias("rank"), F.col("off"), start.alias("start"), stop.alias("end"), F.col("label"))
    every = F.sort_array(F.collect_set(F.when(found & ~F.col("base"), span)))
    rows = spans.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, start)).alias("first_word"),
        F.max(F.when(base, start)).alias("last_word"),
        F.sort_array(F.collect_set(F.when(base, F.col("label")))).alias("bases"),
        F.collect_list(F.when(base, F.struct(start.alias("start"), stop.alias("end"), F.col("label")))).alias("base_spans"),
        every.alias("every"),
        F.coalesce(F.max("held"), F.lit(0.0)).alias("score"),
    )
    apart = lambda s, kept: ~F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
    best = F.reduce("every", F.slice("every", 1, 0), lambda kept, s: F.when(apart(s, kept), F.concat(kept, F.array(s))).otherwise(kept))
    rows = rows.withColumn("best", F.transform(best, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["label"].alias("label"))))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("bases", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("bases", F.transform("best", lambda s: s["label"]))), ",").alias("labels"),
        "score",
        F.sort_array(F.concat("base_spans", "best")).alias("spans"),
    )
