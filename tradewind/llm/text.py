"""Words of whole texts, Arrow batch by Arrow batch.

A word is a run of characters other than ``\\x20`` and ``\\x09-\\x0D``. Texts are handled in slices
of a bounded number of bytes; only a single text larger than that makes a larger slice.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import materialise

SLICE_BYTES = 2_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows go to Python workers in batches of about so many bytes; by default a batch of long texts is far larger,
# and both sides hold it.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# A table of a few numbers a row is sent to every executor up to so many rows (about 32 MB).
SENT_ROWS = 2_000_000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set(BATCH_BYTES, "4m")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again; the shuffle files that the write needed
    go when it is done, since nothing reads them afterwards."""
    conf = df.sparkSession.conf
    small_batches(df.sparkSession)
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return materialise(df, name)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def light(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row: sent to every executor if it is small, else joined as any other."""
    return F.broadcast(df) if df.count() <= SENT_ROWS else df


def remainder(column: str, n: int) -> Column:
    """crc32 of an integer as text, modulo ``n``; a missing number counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One chunk of strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, at most ``limit`` bytes of text at a time if one row fits."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task that gives freed memory back to the machine at its end: workers live on, and
    what one task held must not add to what the next one needs."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the usual C library has it
            if trim is not None:
                trim(0)

    return whole


def by_slice(
    df: DataFrame, column: str, work: Callable[[pa.RecordBatch], dict | pa.RecordBatch], schema: str
) -> DataFrame:
    """``mapInArrow`` over slices; ``work`` returns a record batch or its columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column):
            out = work(batch)
            yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(released(run), schema)


class Words:
    """Words of several texts as numbers: ``codes[i]`` is the place of word i in ``vocabulary``,
    ``owner[i]`` the text that holds it."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, vocabulary: pa.Array):
        self.codes, self.counts, self.vocabulary = codes, counts, vocabulary
        self.owner = np.repeat(np.arange(len(counts)), counts)

    @classmethod
    def of(cls, texts: pa.Array, lower: bool = False) -> Words:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        words, owner = lists.flatten(), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(words), 0)
        if not pc.all(real, min_count=0).as_py():
            words, owner = words.filter(real), owner.filter(real)
        coded = words.dictionary_encode()
        counts = np.bincount(owner.to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int64)
        return cls(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, coded.dictionary)

    def some(self, kept: np.ndarray) -> Words:
        """Only the texts where ``kept`` is true."""
        return Words(self.codes[kept[self.owner]], self.counts[kept], self.vocabulary)

    def total(self, per_word: np.ndarray) -> np.ndarray:
        """Sum over the words of each text of a whole number that each distinct word has."""
        return np.bincount(self.owner, per_word[self.codes], len(self.counts)).astype(np.int64)

    def starts(self, width: int) -> np.ndarray:
        """Places where ``width`` words of one text begin."""
        last = len(self.owner) - width + 1
        if last <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.owner[:last] == self.owner[width - 1 :])
