from __future__ import annotations

import pytest

from tradewind import Warehouse, get_spark

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = get_spark("tests", master="local[8]", **{"spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def warehouse(spark, tmp_path_factory):
    """Star schema and aggregates built once over the smallest test tables."""
    lazy = Warehouse.over_market(spark, SF_DIR)
    from tradewind.plans.warehouse import MODELS

    return lazy.build(str(tmp_path_factory.mktemp("tables")), MODELS)
