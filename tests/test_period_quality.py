from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import START
from nodecast.operators.period_quality import merged, overview, period_rows, relative_error, store_periods
from nodecast.operators.quality import quality_overview


@pytest.fixture(scope="module")
def readings(spark):
    """Ten days, 30,000 nodes, some repeated keys and missing nodes and times."""
    at = F.timestamp_micros(F.lit(int(START.timestamp()) * 1_000_000) + F.col("id") % 240 * F.lit(3_600_000_000))
    node = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 30_000).cast("string"))
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 997 != 0, node).alias("node"), F.when(F.col("id") % 1009 != 0, at).alias("timestamp")
    )
    return rows.cache()


def test_merged_equals_the_overview_but_for_the_estimate(readings):
    got, wanted = merged(period_rows(readings)).first().asDict(), quality_overview(readings).first().asDict()
    nodes = got.pop("nodes"), wanted.pop("nodes")
    assert got == wanted and nodes[1] > 20_000
    assert abs(nodes[0] - nodes[1]) <= relative_error() * nodes[1]


def test_the_order_of_merging_does_not_matter(readings):
    periods = period_rows(readings).cache()
    wanted = merged(periods).first()
    assert all(merged(periods.orderBy(order).coalesce(parts)).first() == wanted
               for order, parts in ((F.desc("period"), 1), ("period", 1), (F.hash("period"), 3)))


def test_a_new_day_and_a_corrected_day(spark, readings, tmp_path):
    path = str(tmp_path / "periods")
    fifth = START + timedelta(days=5)
    store_periods(readings.where(F.col("timestamp") < fifth), path)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "periods").rglob("*.parquet")}
    store_periods(readings.where((F.col("timestamp") >= fifth) | F.col("timestamp").isNull()), path)
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "periods").rglob("*.parquet")}
    assert before.items() < after.items()  # stored days are left alone
    assert overview(spark, path).first() == merged(period_rows(readings)).first()
    day = readings.where(F.col("timestamp").between(fifth, fifth + timedelta(hours=23)))
    store_periods(day.unionAll(day), path)
    found = overview(spark, path).first()
    twice = readings.unionAll(day)
    assert found.rows == twice.count() and found.duplicates_node_timestamp == quality_overview(twice).first()[5]


def test_no_rows(spark, readings):
    found = merged(period_rows(readings.limit(0))).first()
    assert tuple(found) == (0, 0, 0, None, None, 0)
