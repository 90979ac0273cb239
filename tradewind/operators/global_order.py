"""Exact ntile and rank over a whole frame without sorting it in one task.

A window without partition keys moves every row to one task. The functions here sort into ranges
instead, write the sorted frame once, and turn per-range counts into global positions. NULL values
come last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewind.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def _sorted_ranges(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` sorted into ranges and written, with ``_range`` and ``_row`` (both from 0)."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return (
        materialise(placed, "ranges")
        .withColumn("_range", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id")
    )


def _range_offsets(ranges: DataFrame, amount: Column) -> DataFrame:
    """Total of ``amount`` in all earlier ranges: one row per range, so never more than tasks."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranges.groupBy("_range")
        .agg(amount.alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )


def bucket_starts(rows: int, buckets: int) -> list[int]:
    """First position of buckets 2, 3, ... as ntile deals ``rows`` out: larger buckets first."""
    size, larger = divmod(rows, buckets)
    starts = [b * size + min(b, larger) for b in range(1, buckets)]
    return [start for start in starts if start < rows]


def _cut_rows(df: DataFrame, value: str, key: str, rows: int, buckets: int) -> list:
    """The rows that open buckets 2, 3, ...: at most ``buckets - 1`` rows reach the driver."""
    ranges = _sorted_ranges(df.select(value, key), F.col(value).asc_nulls_last(), F.col(key).asc())
    offsets = _range_offsets(ranges, F.count("*"))
    position = F.col("_offset") + F.col("_row")
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .filter(position.isin(bucket_starts(rows, buckets)))
        .orderBy(F.col(value).asc_nulls_last(), key)
        .select(value, key)
        .collect()
    )


def with_ntile(df: DataFrame, columns: dict[str, str], key: str, rows: int, buckets: int = 5) -> DataFrame:
    """Add ``ntile(buckets)`` over (value, key) for each ``{new column: value column}``.

    ``key`` must be unique, ``df`` cheap to read repeatedly (a written table) and ``rows`` its
    size. The score is a comparison with the few rows that open each bucket, so no second shuffle
    of the frame is needed.
    """

    def reached(value: str, cut) -> Column:  # noqa: ANN001
        own = F.col(value)
        if cut[0] is None:
            return own.isNull() & (F.col(key) >= F.lit(cut[1]))
        return own.isNull() | (own > F.lit(cut[0])) | ((own == F.lit(cut[0])) & (F.col(key) >= F.lit(cut[1])))

    def score(value: str) -> Column:
        passed = [reached(value, cut).cast("int") for cut in _cut_rows(df, value, key, rows, buckets)]
        return reduce(lambda total, flag: total + flag, passed, F.lit(1))

    return df.withColumns({new: score(value) for new, value in columns.items()})


def with_rank_desc(df: DataFrame, value: str, new: str) -> DataFrame:
    """Add ``rank() over (order by value desc nulls last)``; ties share the lower number.

    Equal values collapse to one row before they are ordered, however many rows share them.
    """
    tallies = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_tied"))
    ranges = _sorted_ranges(tallies, F.col(value).desc())
    before = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        ranges.withColumn("_before", F.coalesce(F.sum("_tied").over(before), F.lit(0)))
        .join(F.broadcast(_range_offsets(ranges, F.sum("_tied"))), "_range")
        .select(value, (F.col("_offset") + F.col("_before") + 1).cast("int").alias(new))
    )
    ranked = df.join(ranks, value, "left")
    top_of_nulls = df.agg((F.count(value) + 1).cast("int")).scalar()
    return ranked.select(*df.columns, F.coalesce(F.col(new), top_of_nulls).alias(new))


def first_in_group(df: DataFrame, group: str, order: list[str], wanted: dict) -> DataFrame:
    """The first ``wanted[value]`` rows of each group in the given order, exactly, however large a group is.

    Rows are sorted into ranges and written; counts per range and group (never more rows than tasks and
    groups together) tell where each range's share of a group begins. ``order`` must tell rows of a group apart.
    """
    ranges = _sorted_ranges(df, F.col(group), *[F.col(o) for o in order])
    tallies = ranges.groupBy("_range", group).agg(F.count("*").alias("_n"), F.min("_row").alias("_from"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tallies.select(
        F.col("_range").alias("_r"), F.col(group).alias("_g"), "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    limit = reduce(lambda held, item: held.when(F.col(group).eqNullSafe(F.lit(item[0])), item[1]), wanted.items(), F.when(F.lit(False), 0))
    placed = ranges.join(F.broadcast(offsets), (F.col("_range") == F.col("_r")) & F.col(group).eqNullSafe(F.col("_g")))
    return placed.filter(F.col("_offset") + F.col("_row") - F.col("_from") < limit.otherwise(0)).select(*df.columns)
