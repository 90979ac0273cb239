"""Shared by the model jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tradewind.sources.store import Store


@dataclass
class ModelRun:
    """Output tables of one model job by name, and its headline figures."""

    tables: dict[str, DataFrame]
    summary: dict[str, object] = field(default_factory=dict)

    def save(self, store: Store, run_id: str | None = None) -> dict[str, object]:
        for name, frame in self.tables.items():
            self.tables[name] = store.write_model_output(frame, name, run_id)
        return self.summary
