"""Secrets in text: candidates by shape, false positives removed by a random forest.

A candidate is a run of 12 or more characters of ``[A-Za-z0-9+/=_.-]`` with a digit, without an
assignment's name before it; any issued key; and any value assigned to a secret's name, whatever its
characters and length (between quotes all of it, else up to white space). What the forest reads of each: its length, how its characters change kind from one
to the next and how evenly they are spread, how much of it dictionary words cover, whether it looks
like a path, an address or a number, whether its document's source reads like sample code, and the
words beside it. It is trained on labelled findings: a table of ``candidate``, ``before``,
``after``, ``source`` and ``label``. ``findings`` makes one from the text
itself by rules that are sure either way (issued key formats and assignments to a secret's name;
addresses, numbers and words), leaving all others unlabelled; the forest then judges every candidate.

The forest is fitted on about ``SAMPLE`` findings of each label, chosen by hash. Null text counts
as empty. Equal candidates in equal surroundings are judged alike, rows one by one. Without
findings of both labels only sure secrets are secrets. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import Words, by_slice, light, released, slices, stored, strings
from tradewind.session import scratch_path

SAMPLE = 20_000
DICTIONARY = 20_000
REDACTED = "[secret]"
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/=_.\-])[A-Za-z+/=_.\-]*+\d[A-Za-z0-9+/=_.\-]*+")
ASSIGNED = re.compile(r"(?i)\b\w{0,30}(?:password|passwd|secret|token|api_?key|access_?key|auth)\b\s?[=:]\s?[\"']?$")
SAMPLES = re.compile(r"(?i)test|example|sample|mock|fixture|doc")
WORDS = re.compile(r"[A-Za-z_]+")
SECRET_NAMES = frozenset("password passwd pwd secret token apikey api_key key access_key auth bearer credential".split())
# Shapes of issued keys.
ISSUED = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_\-]{35}")
ISSUED_KEY = re.compile(rf"(?<![A-Za-z0-9])(?:{ISSUED.pattern})(?![A-Za-z0-9])")
NAMES = "password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer"
VALUE = re.compile(rf"(?i)(?:{NAMES})\w{{0,20}}[\"']?[ \t]{{0,3}}(?::=|=>|[=:])[ \t]{{0,3}}(?:\"([^\"\n]+)\"|'([^'\n]+)'|[\"']?([^\s\"']\S*))")
HARMLESS = re.compile(r"\d[\d.\-/]*|\d+(?:\.\d+)+|[^@\s]+\.(?:com|org|net|html?|txt|pdf|png|jpe?g)|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[A-Za-z]+[-_.][A-Za-z._\-]+\d{0,4}")
KINDS = 4  # of characters: small letter, capital, digit, other
NEAR = 3


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text", source: str | None = None, number: str | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``start``, ``end``, ``candidate``, the text ``before`` and ``after`` it on its line, in the order of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: dict[str, list] = {name: [] for name in ("at", "start", "end", "candidate", "before", "after")}
            texts = strings(batch.column("text"))
            worth = pc.match_substring_regex(texts, rf"[0-9]|(?i:{NAMES})|AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_live_|AIza")
            for at in np.flatnonzero(worth).tolist():
                text = texts[at].as_py()
                for start, end in spots(text):
                    line = text.rfind("\n", 0, start) + 1
                    stop = text.find("\n", end)
                    values = (at, start, end, text[start:end], text[max(line, start - 60) : start], text[end : min(end + 60, stop if stop >= 0 else len(text))])
                    for name, value in zip(out, values, strict=True):
                        out[name].append(value)
            place = pa.array(out.pop("at"), pa.int64())
            columns = {name: batch.column(name).take(place) for name in ("row", "doc_id", "source")}
            columns |= {name: pa.array(v, pa.int64() if name in ("start", "end") else pa.string()) for name, v in out.items()}
            yield pa.RecordBatch.from_pydict(columns)

    frame = df.select((F.col(f"`{number}`") if number else F.monotonically_increasing_id()).alias("row"), F.col(key).alias("doc_id"), (F.col(source).cast("string") if source else F.lit("")).alias("source"), F.col(text).cast("string").alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(released(run), f"row long, doc_id {kind}, source string, start long, end long, candidate string, before string, after string")


def spots(text: str) -> list[tuple[int, int]]:
    """Candidates of a text; an assignment's name and sign are not part of one, nor is a full stop at its end."""
    found = []
    for match in CANDIDATE.finditer(text):
        start, end = match.span()
        sign = text.rfind("=", start, end - 8)
        if sign >= 0 and WORDS.fullmatch(text, start, sign):
            start = sign + 1
        while end > start and text[end - 1] == ".":
            end -= 1
        if end - start >= 12:
            found.append((start, end))
    more = [m.span() for m in ISSUED_KEY.finditer(text)]
    for match in VALUE.finditer(text):
        start, end = match.span(match.lastindex)
        while match.lastindex == 3 and end > start + 1 and text[end - 1] in ".,;)]}>\"'":
            end -= 1
        more.append((start, end))
    if not more:
        return found
    whole: list[tuple[int, int]] = []
    runs = set(found)
    for start, end in sorted(found + more):  # overlapping ones are one, but a run is cut where a key or value begins in it
        if whole and start < whole[-1][1]:
            first, last = whole.pop()
            if (first, last) in runs and first < start:
                if start - first >= 12 and re.search(r"\d", text[first:start]):
                    whole.append((first, start))
                first = start
            whole.append((first, max(end, last)))
        else:
            whole.append((start, end))
    return whole


def judged(candidate: str, before: str) -> int | None:
    """1 for a sure secret, 0 for a sure false positive, None if no rule says."""
    if ISSUED.fullmatch(candidate):
        return 1
    if len(candidate) < 12 or not re.search(r"\d", candidate):
        return None
    if HARMLESS.fullmatch(candidate):
        return 0
    if ASSIGNED.search(before[-40:]) and len(set(candidate)) >= 8:
        return 1
    return None


def features(candidate: str, before: str, after: str, source: str | None, dictionary: frozenset[str]) -> list[float]:
    n = len(candidate)
    kinds = [0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in candidate]
    moves = [0.0] * (KINDS * KINDS)
    for a, b in zip(kinds, kinds[1:], strict=False):
        moves[a * KINDS + b] += 1 / (n - 1)
    counts = Counter(candidate)
    spread = -sum(c / n * np.log2(c / n) for c in counts.values())
    covered = sum(len(w) for w in re.findall(r"[A-Za-z]{3,}", candidate) if w.lower() in dictionary) / n
    left = WORDS.findall(before.lower())[-NEAR:]
    right = WORDS.findall(after.lower())[:NEAR]
    hexadecimal = all(c in "0123456789abcdefABCDEF" for c in candidate)
    return [
        float(n), spread, len(counts) / n, covered, candidate.count("/") / n, candidate.count(".") / n, candidate.count("-") / n,
        float(hexadecimal), float("://" in before[-12:] or before.endswith(("/", "\\", "www."))), float(before.endswith("@") or after.startswith("@")),
        float(before.rstrip(" \"'").endswith(("=", ":"))), float(any(w in SECRET_NAMES for w in left)), float(any(w in SECRET_NAMES for w in right)),
        sum(w in dictionary for w in left + right) / (2 * NEAR), float(bool(SAMPLES.search(source or ""))), *moves,
    ]


def words(df: DataFrame, text: str = "text") -> frozenset[str]:
    """The commonest words of three or more letters over all texts, about ``DICTIONARY``: what the forest knows as words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            own = Words.of(strings(batch.column("t")), lower=True)
            n = np.bincount(own.codes, minlength=len(own.vocabulary)).astype(np.int64)
            plain = pc.match_substring_regex(own.vocabulary, "^[a-z]{3,20}$")
            yield pa.RecordBatch.from_pydict({"w": own.vocabulary.filter(plain), "n": n[plain.to_numpy(zero_copy_only=False)]})

    counted = df.select(F.col(text).cast("string").alias("t")).mapInArrow(released(count), "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))
    counted = stored(counted, "words")
    level = F.floor(F.log2("n") * 8)
    per_level = counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()  # a few hundred levels
    least, share, kept = 0, 0.0, 0
    for least, words in sorted(((r["level"], r["words"]) for r in per_level), reverse=True):  # noqa: B007
        share = min(1.0, (DICTIONARY - kept) / words)
        kept += words
        if share < 1:  # of the last level that fits, a share by hash
            break
    some = F.pmod(F.xxhash64("w"), F.lit(1 << 20)) < int(share * (1 << 20))
    return frozenset(r["w"] for r in counted.where((level > least) | ((level == least) & some)).select("w").collect())


def _featured(found: DataFrame, dictionary: frozenset[str]) -> DataFrame:
    """With ``x``, the features, and ``label`` (null: no rule says)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [batch.column(c).to_pylist() for c in ("candidate", "before", "after", "source")]
        rows = [features(*p, dictionary) for p in zip(*parts, strict=True)]
        labels = [judged(c, b) for c, b in zip(parts[0], parts[1], strict=True)]
        batch = batch.append_column("x", pa.array(rows, pa.list_(pa.float64())))
        return batch.append_column("label", pa.array(labels, pa.int32()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return by_slice(found, "candidate", work, f"{schema}, x array<double>, label int")


def train(featured: DataFrame, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from rows with ``x`` and ``label``, or None without both labels.

    It is saved and read back: a freshly fitted one holds its session, which cannot travel to executors."""
    counts = {r["label"]: r["count"] for r in featured.where("label IN (0, 1)").groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    # About SAMPLE findings of each label by hash; equal ones are judged alike, so copies are in or out together.
    place = F.pmod(F.xxhash64("candidate", "before", "after", "start"), F.lit(1 << 32))
    share = F.when(F.col("label") == 1, SAMPLE / counts[1]).otherwise(SAMPLE / counts[0])
    sample = featured.where(F.col("label").isin(0, 1) & (place < share * float(1 << 32)))
    sample = stored(sample.select("x", F.col("label").cast("double").alias("label")), "findings")
    sample = sample.select(array_to_vector("x").alias("features"), "label")
    if sample.select("label").distinct().count() < 2:
        return None
    path = scratch_path(featured.sparkSession, "forest")
    RandomForestClassifier(numTrees=40, maxDepth=8, seed=seed).fit(sample).write().save(path)
    return RandomForestClassificationModel.load(path)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", source: str | None = None, findings: DataFrame | None = None, number: str | None = None) -> DataFrame:
    """All candidates with ``score`` (the forest's share for a secret) and ``secret`` (at least one half)."""
    dictionary = words(df, text)
    found = stored(_featured(candidates(df, key, text, source, number), dictionary), "candidates")
    labelled = found
    if findings is not None:
        given = findings.select("candidate", "before", "after", "source", F.col("label").alias("given"), F.lit(0).cast("long").alias("start"))
        labelled = _featured(given, dictionary).withColumn("label", F.col("given"))
    forest = train(labelled)
    if forest is None:
        sure = F.coalesce(F.col("label") == 1, F.lit(False))
        return found.withColumns({"score": sure.cast("double"), "secret": sure}).drop("x", "label")
    scored = forest.transform(found.withColumn("features", array_to_vector("x")))
    scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.select(*[c for c in found.columns if c not in ("x", "label")], "score", (F.col("score") >= 0.5).alias("secret"))


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", source: str | None = "source") -> DataFrame:
    """The rows of ``df`` with every secret replaced by ``REDACTED``; other columns unchanged. ``source`` may be missing."""
    number = "row"
    while number in df.columns:
        number += "_"
    numbered = stored(df.withColumn(number, F.monotonically_increasing_id()), "numbered")  # numbered once, whatever made ``df``
    found = scan(numbered, key, text, source if source in df.columns else None, number=number)
    secrets = found.where("secret").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    secrets = light(stored(secrets, "secrets"))
    spare = "spans"
    while spare in df.columns:
        spare += "_"
    named = numbered.select(F.col(f"`{number}`").alias("row"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("kept"))
    joined = named.join(secrets, "row", "left").select("kept.*", F.col("spans").alias(spare))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(text).to_pylist()
        for i, spans in enumerate(batch.column(spare).to_pylist()):
            if spans:
                parts, last = [], 0
                for s in spans:
                    parts += [texts[i][last : s["start"]], REDACTED]
                    last = s["end"]
                texts[i] = "".join([*parts, texts[i][last:]])
        names = [n for n in batch.schema.names if n != spare]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text else batch.column(n) for n in names], names=names)

    return by_slice(joined, text, work, df.schema)
