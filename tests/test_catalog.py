"""A sample of the registered queries against SQL; check_oracle.py runs them all."""

from pathlib import Path

import pytest

import check_oracle
from nodecast.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
FITTED = {"ridge_forecast", "importance_of_features", "model_comparison", "model_comparison_power"}
SAMPLE = (
    "time_range_filter", "node_semi_join", "node_coverage_topn", "metric_full_outer_join",
    "complete_grid_left_join", "prepared_telemetry", "quality_overview", "sampling_gap",
    "duplicate_keys", "supervised_target", "history_filter", "persistence_metrics",
    "residual_histogram", "best_model", "archive_readings", "telemetry_parquet", "telemetry_csv",
    "saved_ridge_latest", "node_ridge_forecast",
    "stored_series_supervised", "quality_by_period", "periods_of_quality",
)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return check_oracle.database(FOLDER)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, connection, name):
    build = check_oracle.entry.queries()[name]
    problem, _ = check_oracle.compare(
        spark, connection, FOLDER, name, build, check_oracle.entry.oracle_sql()[name]
    )
    assert problem is None


def test_every_query_has_sql_unless_it_fits_a_model():
    queries, answers = check_oracle.entry.queries(), check_oracle.entry.oracle_sql()
    assert set(QUERIES) - set(answers) == FITTED and set(answers) <= set(queries)


def test_entry(spark):
    assert {r.split for r in check_oracle.entry.entry(spark).collect()} == {"train", "validation", "test"}
