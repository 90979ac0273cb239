"""Reading source CSV files: everything as text, then permissive typing."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tradewind.tables import SourceTable, source_table

log = logging.getLogger(__name__)

SAMPLE_ROWS = 5_000

# Cell texts read as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class SourceFileMissingError(FileNotFoundError):
    pass


def read_text(spark: SparkSession, folder: str, table: SourceTable) -> DataFrame:
    """The table's files with every column as text, plus the file each row came from.

    Only reviews hold line breaks inside fields; the other files stay splittable.
    """
    pattern = f"{folder.rstrip('/')}/{table.file}"
    try:
        frame = (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("multiLine", table.name == "order_reviews")
            .csv(pattern)
        )
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise SourceFileMissingError(f"{table.file} not found in {folder}") from error
        raise
    return frame.select("*", F.col("_metadata.file_name").alias("_source_file"))


def _typed(cell: Column, kind: T.DataType) -> Column:
    """Cast one text cell; what does not parse becomes NULL."""
    text = F.when(~cell.isin(*MISSING_TOKENS), cell)
    number = F.trim(text).try_cast("double")
    if isinstance(kind, T.IntegerType):
        return F.bround(number).try_cast("int")
    if isinstance(kind, T.DecimalType):
        return number.try_cast(kind)
    if isinstance(kind, T.DoubleType):
        return number
    if isinstance(kind, T.TimestampNTZType):
        return F.date_trunc("second", F.trim(text).try_cast("timestamp_ntz")).cast("timestamp_ntz")
    return F.nullif(F.trim(text), F.lit(""))


def coerce(frame: DataFrame, table: SourceTable) -> DataFrame:
    """The declared columns in declared order and type. Absent columns are NULL, others dropped."""
    columns = []
    for field in table.schema.fields:
        if field.name in frame.columns:
            columns.append(_typed(F.col(field.name).cast("string"), field.dataType).alias(field.name))
        else:
            log.warning("%s: source has no column '%s', filling with NULL", table.name, field.name)
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    lineage = [name for name in ("_source_file",) if name in frame.columns]
    return frame.select(*columns, *lineage)


def read_table(spark: SparkSession, folder: str, name: str, sample_rows: int | None = None) -> DataFrame:
    """One source table, typed. ``sample_rows`` is the explicit sample mode; lookups ignore it."""
    table = source_table(name)
    frame = read_text(spark, folder, table)
    if sample_rows is not None and not table.never_sample:
        frame = frame.limit(sample_rows)
    return coerce(frame, table)
