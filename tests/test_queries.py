"""Registered queries: equal to their SQL on all rows, and planned the way they should be."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import FOLDER
from tests.oracle_check import differences, duck_connection
from tidewire.plans.catalog import QUERIES
from tidewire.schemas import FEATURES


@pytest.fixture(scope="module")
def con():
    return duck_connection(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and set(df.columns) == set(FEATURES.fieldNames())


def plan(spark, name):
    return queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["window_features", "hourly_features", "macro_asof", "market_features"])
def test_no_pairwise_joins(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "SinglePartition" not in text or name in ("macro_asof", "hourly_features")


def test_dedup_moves_no_text(spark):
    """The exchange of the duplicate filter sits above the projection that drops the texts."""
    text = plan(spark, "window_features")
    above = text[text.index("WindowGroupLimit"):]
    partial = next(line for line in above.splitlines() if "Project" in line and "relevant" in line)
    assert not re.search(r"\bcontent#", partial.split("relevant")[0])


def test_window_filter_prunes_columns(spark):
    text = plan(spark, "stage_counters")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert all("n_chars" not in s for s in scans)
