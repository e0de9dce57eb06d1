from datetime import timedelta

import numpy as np
import pytest

from conftest import START
from nodecast.operators.features import build_supervised, store_supervised, supervised_from_store
from nodecast.operators.series import add_series_columns
from nodecast.sources.series_store import read_series, write_series


@pytest.fixture(scope="module")
def gappy(spark):
    """Three nodes with gaps; one of them has most rows."""
    chance = np.random.default_rng(7)
    rows = [
        (node, START + timedelta(minutes=int(m)), float(chance.normal()))
        for node, n in (("hot", 900), ("b", 90), ("c", 4))
        for m in sorted(chance.choice(2000, n, replace=False))
    ]
    return spark.createDataFrame(rows, "node string, timestamp timestamp, value double").cache()


def columns(over):
    return {
        "lag_7": over.lag("value", 7), "mean_9": over.recent("avg(value)", 9), "ahead_3": over.lead("value", 3),
    }


def listed(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def store(spark, gappy, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "series")
    write_series(gappy, path, 9, 3, piece_steps=60, buckets=6)
    return path


def test_same_columns_as_from_the_table(spark, gappy, store):
    wanted = add_series_columns(gappy, columns, 9, 3, piece_steps=60)
    got = read_series(spark, store).add_columns(columns, 9, 3)
    assert got.columns == wanted.columns
    assert [tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in listed(got.na.fill(0.0))] == [
        tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in listed(wanted.na.fill(0.0))
    ]


def test_windows_without_an_exchange(spark, store):
    plan = read_series(spark, store).add_columns(columns, 9, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan and "Bucketed: true" in plan


def test_the_hot_node_lies_in_all_buckets(spark, store):
    pieces = read_series(spark, store).pieces
    rows = pieces.where("node = 'hot'").selectExpr("_metadata.file_name AS file").distinct().count()
    assert rows == 6 == pieces.selectExpr("_metadata.file_name AS file").distinct().count()


def test_rows_come_back_once(spark, gappy, store):
    assert listed(read_series(spark, store).table) == listed(gappy)


def test_another_session_reads_it(spark, store):
    other = spark.newSession()
    name = read_series(spark, store).pieces.sparkSession.catalog.listTables()
    for table in name:
        if table.name.startswith("nodecast_series_"):
            other.sql(f"DROP TABLE {table.name}")
    assert read_series(other, store).add_columns(columns, 9, 3).count() == 994


def test_a_longer_reach_raises(spark, store):
    with pytest.raises(ValueError, match="9 rows back and 3 ahead"):
        read_series(spark, store).add_columns(columns, 10, 3)


def test_supervised_rows_from_a_store(spark, telemetry, tmp_path):
    path = str(tmp_path / "series")
    store_supervised(telemetry, path, 5, piece_steps=7, buckets=4)
    wanted = build_supervised(telemetry, "cpu_temp_max", 5, piece_steps=7)
    got = supervised_from_store(read_series(spark, path), "cpu_temp_max", 5)
    assert got.features == wanted.features and got.frame.count() == wanted.frame.count() > 0
    assert got.frame.exceptAll(wanted.frame).isEmpty()
    with pytest.raises(ValueError, match="target"):
        supervised_from_store(read_series(spark, path), "nothing")


def test_an_empty_table(spark, gappy, tmp_path):
    write_series(gappy.limit(0), str(tmp_path / "none"), 9, 3, buckets=3)
    assert read_series(spark, str(tmp_path / "none")).add_columns(columns, 9, 3).count() == 0
