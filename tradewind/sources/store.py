"""Published tables by schema-qualified name, model outputs, and Parquet snapshots."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


class Store:
    """Relations such as ``analytics.agg_kpi_summary`` as Parquet folders, or catalog tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, relation: str) -> str:
        schema, _, table = relation.partition(".")
        return f"{self.folder}/{schema}/{table}"

    def find(self, relation: str) -> DataFrame | None:
        """The relation, or None when neither the folder nor the catalog has it."""
        try:
            return self.spark.read.parquet(self.path(relation))
        except AnalysisException:
            return self.spark.table(relation) if self._in_catalog(relation) else None

    def _in_catalog(self, relation: str) -> bool:
        try:
            return self.spark.catalog.tableExists(relation)
        except AnalysisException:
            return False

    def exists(self, relation: str) -> bool:
        return self.find(relation) is not None

    def read(self, relation: str) -> DataFrame:
        frame = self.find(relation)
        if frame is None:
            raise LookupError(f"{relation} is not available yet, run its job first")
        return frame

    def write(self, df: DataFrame, relation: str) -> DataFrame:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(relation))
        return self.read(relation)

    def write_model_output(self, df: DataFrame, table: str, run_id: str | None = None) -> DataFrame:
        """Replace one table of the ``ml`` schema, stamping every row with its run."""
        stamped = df.withColumn("generated_at", F.current_timestamp()).withColumn(
            "run_id", F.lit(run_id).cast("string")
        )
        return self.write(stamped, f"ml.{table}")


def export_snapshot(store: Store, folder: str, strict: bool = False) -> dict[str, int]:
    """Write every published dataset as Parquet, with a manifest. Returns rows per dataset.

    A missing relation is skipped; with ``strict`` a missing required one is an error.
    """
    from tradewind.plans.published import DATASETS

    written: dict[str, int] = {}
    skipped: list[str] = []
    for dataset in DATASETS:
        if not store.exists(dataset.relation):
            if strict and dataset.required:
                raise RuntimeError(f"{dataset.relation} does not exist, cannot export {dataset.name}")
            skipped.append(dataset.relation)
            continue
        path = f"{folder.rstrip('/')}/{dataset.name}.parquet"
        dataset.frame(store).write.mode("overwrite").parquet(path)
        written[dataset.name] = store.spark.read.parquet(path).count()
    manifest = store.spark.createDataFrame(
        [(datetime.now(UTC).isoformat(timespec="seconds"), written, skipped)],
        "generated_at string, tables map<string,bigint>, skipped array<string>",
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder.rstrip('/')}/manifest")
    return written


def load_dataset(store: Store, snapshot_folder: str, name: str) -> DataFrame | None:
    """A published dataset from the store, else from the snapshot, else None."""
    from tradewind.plans.published import dataset_named

    dataset = dataset_named(name)
    if store.exists(dataset.relation):
        return dataset.frame(store)
    try:
        return store.spark.read.parquet(f"{snapshot_folder.rstrip('/')}/{name}.parquet")
    except AnalysisException:
        return None
