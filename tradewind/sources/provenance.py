"""Where a folder of source files came from, as a one-row JSON table beside them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

MARKER = "_provenance"
REAL_SOURCE = "published"
_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("written_at", T.StringType()),
        T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
    ]
)


@dataclass(frozen=True)
class Provenance:
    source: str = "unknown"
    dataset: str = "unknown"
    written_at: str = ""
    detail: dict[str, str] = field(default_factory=dict)

    @property
    def is_real_data(self) -> bool:
        return self.source == REAL_SOURCE


def write(spark: SparkSession, folder: str, source: str, dataset: str, **detail: object) -> Provenance:
    record = Provenance(
        source,
        dataset,
        datetime.now(UTC).isoformat(timespec="seconds"),
        {key: str(value) for key, value in detail.items()},
    )
    row = (record.source, record.dataset, record.written_at, record.detail)
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("overwrite").json(f"{folder}/{MARKER}")
    return record


def read(spark: SparkSession, folder: str) -> Provenance:
    """The record, or an unknown one when it is absent or unreadable."""
    try:
        row = spark.read.schema(_SCHEMA).json(f"{folder}/{MARKER}").first()
    except PySparkException:
        return Provenance()
    if row is None or row["source"] is None:
        return Provenance()
    return Provenance(row["source"], row["dataset"] or "unknown", row["written_at"] or "", row["detail"] or {})
