from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from oracle.check import compare, connect
from tradewind.catalog import QUERIES

ROOT = Path(__file__).resolve().parents[1]
# Jobs over model training are timed and checked elsewhere; here only what SQL can verify.
CHEAP = [n for n in entry.oracle_sql() if n.startswith(("src_", "stg_", "int_", "dim_", "fact_", "agg_", "insight_"))]


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without_sql = set(QUERIES) - set(entry.oracle_sql())
    allowed = ("segment_", "forecast_", "sentiment_", "serve_forecast", "serve_sentiment", "insight_forecast", "insight_late")
    assert all(name.startswith(allowed) for name in without_sql)


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and frame.columns[0] == "month_start_date"


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", CHEAP)
def test_equals_sql(spark, sf_dir, con, name):
    assert compare(con, entry.queries()[name](spark, sf_dir), entry.oracle_sql()[name]) is None


def test_no_lineage_cut_on_executors_and_no_machine_folders():
    for path in (ROOT / "tradewind").rglob("*.py"):
        if path.parent.name == "llm":
            continue
        source = path.read_text(encoding="utf-8")
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|toPandas", source), path
        if path.name != "session.py":
            assert "tempfile" not in source, path
