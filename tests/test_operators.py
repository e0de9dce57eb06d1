import math
import random
import statistics
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from nodecast.functions.timeline import as_utc, floor_moment, floor_to, step_micros
from nodecast.operators import align, compare, coverage, metrics, quality, quantiles
from nodecast.operators.features import build_supervised
from nodecast.operators.quantiles import exact_percentile, exact_percentiles, values_at_ranks
from nodecast.operators.split import (
    after_boundary,
    boundary_positions,
    chronological_split,
    split_boundaries,
    split_counts,
)

START = datetime(2021, 3, 3, tzinfo=timezone.utc)


@pytest.mark.parametrize(
    "text, seconds", [("1min", 60), ("90s", 90), ("2 hours", 7200), ("7 days", 604800), ("D", 86400)]
)
def test_steps(text, seconds):
    assert step_micros(text) == seconds * 1_000_000


@pytest.mark.parametrize("text", ["", "1 month", "soon", "0s"])
def test_bad_steps(text):
    with pytest.raises(ValueError):
        step_micros(text)


def test_floor_before_and_after_the_epoch(spark):
    micros = step_micros("90s")
    moments = [datetime(1969, 12, 31, 23, 59, 59, tzinfo=timezone.utc), START + timedelta(seconds=100)]
    rows = spark.createDataFrame([(m,) for m in moments], "t timestamp")
    floored = rows.select(F.unix_micros(floor_to(F.col("t"), micros)).alias("at")).collect()
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    for row, m in zip(floored, moments):
        assert row.at == (floor_moment(m, micros) - epoch) // timedelta(microseconds=1)


def test_start_times():
    assert as_utc("2021-03-03T02:00:00+02:00") == START == as_utc("2021-03-03")


# --- percentiles ----------------------------------------------------------


@pytest.fixture(scope="module")
def numbers(spark):
    chance = random.Random(3)
    rows = [("wide", chance.gauss(0, 1e6)) for _ in range(3000)]
    rows += [("few", float(chance.choice([1, 1, 1, 2, 50]))) for _ in range(2000)]
    rows += [("one", 7.0), ("same", 4.0), ("same", 4.0), ("wide", None), ("none", None)]
    return rows, spark.createDataFrame(rows, "g string, v double").cache()


@pytest.fixture(params=["whole", "sketched"])
def either_way(request, monkeypatch):
    """With Spark's own percentile, and as for groups that are too large for it."""
    if request.param == "sketched":
        monkeypatch.setattr(quantiles, "WHOLE", -1)


def test_percentiles_by_group(numbers, either_way):
    rows, frame = numbers
    chosen = [0.0, 0.1, 0.5, 0.9, 1.0]
    found = exact_percentiles(frame, ["g"], "v", chosen)
    got = {r.g: (r.n, r.percentiles) for r in found.collect()}
    for group in ("wide", "few", "one", "same"):
        values = [v for g, v in rows if g == group and v is not None]
        assert got[group][0] == len(values)
        assert got[group][1] == pytest.approx(list(np.percentile(values, [p * 100 for p in chosen])))
    assert "none" not in got


def test_percentile_of_all_and_ranks(numbers, either_way):
    rows, frame = numbers
    values = sorted(v for _, v in rows if v is not None)
    assert exact_percentile(frame, "v", 0.5) == pytest.approx(
        statistics.median(values)
    )
    places = [0, 17, 2500, len(values) - 1]
    got = values_at_ranks(frame.dropna(), "v", places, len(values))
    assert got == [values[p] for p in places]


def test_percentiles_of_uneven_values(spark, monkeypatch, either_way):
    """Infinite values, a wide lognormal spread, one large group, a coarse sketch and few parts."""
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    monkeypatch.setattr(quantiles, "PARTS", 7)
    chance = random.Random(5)
    rows = [("hot", chance.lognormvariate(0, 20)) for _ in range(20000)]
    rows += [("hot", math.inf), ("hot", -math.inf), (None, 3.0), (None, 5.0)]
    rows += [("ties", float(chance.choice([1, 1, 1, 1, 9]))) for _ in range(5000)]
    rows += [(f"g{i % 40}", chance.gauss(0, 1)) for i in range(400)]
    frame = spark.createDataFrame(rows, "g string, v double")
    chosen = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {r.g: r.percentiles for r in exact_percentiles(frame, ["g"], "v", chosen).collect()}
    for group in {g for g, _ in rows}:
        values = sorted(v for g, v in rows if g == group)
        for p, got in zip(chosen, found[group]):
            at = (len(values) - 1) * p
            low, high = values[math.floor(at)], values[math.ceil(at)]
            assert got == (low if low == high else pytest.approx(low + (high - low) * (at - math.floor(at))))
    assert exact_percentile(frame, "v", 1.0) == math.inf


def test_percentile_of_nothing(spark, either_way):
    assert exact_percentile(spark.createDataFrame([], "v double"), "v", 0.5) is None


# --- coverage and alignment -----------------------------------------------


@pytest.fixture(scope="module")
def readings(spark):
    """Three readings a minute of some metrics, fewer of others."""
    rows = []
    for node, scale in (("a", 1.0), ("b", 2.0), ("c", 3.0)):
        for second in range(0, 600, 20):
            at = START + timedelta(seconds=second)
            rows.append(("ipmi_pub", "total_power", node, at, scale * second))
            rows.append(("ipmi_pub", "p0_core20_temp", node, at, 40 + scale))
            if second % 40 == 0:
                rows.append(("ipmi_pub", "p1_core10_temp", node, at, 50 + scale))
            if second % 120 == 0 and node != "c":
                rows.append(("ganglia_pub", "cpu_user", node, at, 5.0))
    return spark.createDataFrame(
        rows, "plugin string, metric string, node string, timestamp timestamp, value double"
    ).cache()


def test_coverage_and_choice(readings):
    table = coverage.coverage_table(readings)
    got = {r.node: (r.total_power, r.cpu_user, r.minimum_rows, r.total_rows) for r in table.collect()}
    assert got == {"a": (30, 5, 5, 80), "b": (30, 5, 5, 80)}  # c has no cpu_user
    assert coverage.choose_nodes(table, 1) == ["a"]  # equal coverage: by id
    assert coverage.choose_nodes(table, 9) == ["a", "b"]
    with pytest.raises(RuntimeError, match="no node"):
        coverage.choose_nodes(table.where("false"), 3)
    assert coverage.parse_node_list(" a, ,b,") == ["a", "b"]


def test_alignment_forms_agree(readings):
    columns = {m: (p, m) for p, m in (
        ("ipmi_pub", "total_power"), ("ipmi_pub", "p1_core10_temp"), ("ganglia_pub", "cpu_user"))}
    one = align.align_metrics(readings, columns)
    many = align.merge_metric_frames(
        [align.aggregate_metric(readings, p, m) for p, m in columns.values()]
    ).select(one.columns)
    assert one.count() == 30
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()
    # weights: the mean of a bucket is over its readings, not over partial means
    first = one.where("node = 'b'").orderBy("timestamp").first()
    assert first.total_power == pytest.approx(2.0 * 20)


def test_alignment_takes_one_shuffle(readings):
    plan = align.align_metrics(readings)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_core_temperatures_and_absent_metrics(readings):
    rows = align.build_core_temperature_features(readings).where("node = 'a'").orderBy("timestamp")
    first = rows.first()
    assert (first.cpu_temp_mean, first.cpu_temp_max, first.cpu_temp_sensor_count) == (46.0, 51.0, 2.0)
    wide = align.align_metrics(readings)
    assert wide.where("load_one IS NOT NULL").isEmpty()  # never reported: a column of NULLs


def test_unknown_aggregation(readings):
    with pytest.raises(ValueError, match="unknown aggregation"):
        align.align_metrics(readings, aggregation="mode")


@pytest.mark.parametrize("span", [3, 10_000])
def test_grid(spark, readings, monkeypatch, span):
    monkeypatch.setattr(align, "GRID_SPAN_STEPS", span)
    nodes = readings.select("node").distinct()
    end = START + timedelta(minutes=14)
    grid = align.complete_time_grid(nodes, START, end)
    assert grid.count() == grid.distinct().count() == 3 * 14
    ends = grid.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    assert ends[1] - ends[0] == 13 * 60_000_000
    full = align.add_complete_time_grid(align.align_metrics(readings), nodes, START, end)
    assert full.count() == 42 and full.where("total_power IS NULL").count() == 12
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_derived_columns(spark):
    rows = spark.createDataFrame(
        [(START, 1.0, None, 3.0), (START, None, None, 4.0)],
        "timestamp timestamp, cpu_user double, cpu_system double, p0_power double",
    )
    made = align.add_derived_columns(rows)
    assert [r.cpu_busy for r in made.collect()] == [1.0, None]
    assert "cpu_socket_power" not in made.columns  # only one of its parts is there
    assert {(r.hour_utc, r.day_of_week_utc) for r in made.collect()} == {(0, 2)}
    assert dict(made.dtypes)["hour_utc"] == "smallint"


# --- quality --------------------------------------------------------------


def test_quality_of_a_broken_table(telemetry):
    doubled = telemetry.unionAll(telemetry.limit(3)).withColumn(
        "ambient", F.when(F.minute("timestamp") < 10, F.col("ambient"))
    ).withColumn("cpu_wio", F.lit(None).cast("double"))
    view = quality.quality_overview(doubled).first()
    assert (view.rows, view.duplicates_node_timestamp) == (83, 3)
    ranges = {r.column: r for r in quality.numeric_ranges(doubled).collect()}
    assert ranges["cpu_wio"].minimum is None and ranges["cpu_wio"].mean is None
    gaps = quality.columns_with_gaps(doubled).collect()
    assert [g.column for g in gaps] == ["cpu_wio", "ambient"] and gaps[0].missing_percent == 100.0


def test_gap_summary_uses_the_exact_median(telemetry):
    holes = telemetry.where("minute(timestamp) NOT IN (5, 6, 7, 20)")
    row = quality.sampling_gap_summary(holes, piece_steps=4).first()
    assert (row.minimum, row.median, row.maximum) == (60.0, 60.0, 240.0)


# --- split ----------------------------------------------------------------


def test_split_of_the_fixture(telemetry):
    frame = build_supervised(telemetry, "cpu_temp_max").frame
    parts = chronological_split(frame)
    assert (parts.train_end.minute, parts.validation_end.minute) == (31, 35)
    assert {r.split: r.rows for r in split_counts(parts.frame).collect()} == {
        "train": 34, "validation": 8, "test": 8,
    }
    assert after_boundary(frame, parts.validation_end).count() == 8
    assert split_boundaries(frame) == (parts.train_end, parts.validation_end)


def test_published_positions():
    assert boundary_positions(824) == (575, 699)
    with pytest.raises(ValueError, match="at least three"):
        boundary_positions(2)


@pytest.mark.parametrize("train, validation", [(0, 0.1), (1.2, 0.1), (0.5, 0), (0.7, 0.3)])
def test_bad_ratios(train, validation):
    with pytest.raises(ValueError):
        boundary_positions(100, train, validation)


# --- metrics --------------------------------------------------------------


def pairs(spark, actual, predicted):
    return spark.createDataFrame(
        [(float(a), None if p is None else float(p)) for a, p in zip(actual, predicted)],
        "actual double, predicted double",
    )


def test_regression_metrics(spark):
    row = metrics.regression_metrics(
        pairs(spark, [1, 2, 3], [1, 3, 2]), tolerances=[1.0, 2.5]
    ).first()
    assert row.mae == pytest.approx(2 / 3) and row.rmse == pytest.approx(math.sqrt(2 / 3))
    assert row.r2 == pytest.approx(0.0) and row.median_absolute_error == 1.0
    assert row.within_1 == 1.0 and row["within_2.5"] == 1.0


def test_constant_actual_values(spark):
    assert metrics.regression_metrics(pairs(spark, [2, 2], [2, 2])).first().r2 == 1.0
    assert metrics.regression_metrics(pairs(spark, [2, 2], [2, 3])).first().r2 == 0.0


def test_missing_predictions_are_an_error(spark):
    with pytest.raises(Exception, match="1 rows have no"):
        metrics.regression_metrics(pairs(spark, [1, 2], [1, None])).collect()


def test_grouped_metrics_agree_with_each_group(spark, telemetry):
    frame = build_supervised(telemetry, "total_power").frame
    both = metrics.regression_metrics(frame, "target", "total_power", [10.0], ["node"])
    for row in both.collect():
        one = metrics.regression_metrics(
            frame.where(F.col("node") == row.node), "target", "total_power", [10.0]
        ).first()
        assert {k: row[k] for k in one.asDict()} == pytest.approx(one.asDict())


def test_event_proxy(spark):
    row = metrics.event_proxy_metrics(pairs(spark, [1, 5, 6, 2], [2, 6, 4, 1]), 5).first()
    assert (row.precision, row.recall, row.accuracy) == (1.0, 0.5, 0.75)
    assert row.f1 == pytest.approx(2 / 3)
    assert row.confusion_matrix == [[2, 0], [1, 1]] and row.positive_rows == 2


def test_event_proxy_without_events(spark):
    row = metrics.event_proxy_metrics(pairs(spark, [1, 2], [1, 2]), 5).first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 1.0)
    assert row.confusion_matrix == [[2, 0], [0, 0]]


def test_histogram(spark):
    chance = random.Random(1)
    actual = [chance.gauss(0, 1) for _ in range(500)]
    rows = metrics.residual_histogram(pairs(spark, actual, [0] * 500)).orderBy("bin").collect()
    counts, edges = np.histogram(actual, bins=35)
    assert [r.rows for r in rows] == list(counts)
    assert [r.bin_start for r in rows] == pytest.approx(list(edges[:-1]))
    same = metrics.residual_histogram(pairs(spark, [3, 3], [1, 1])).collect()
    assert sum(r.rows for r in same) == 2
    assert metrics.residual_histogram(pairs(spark, [], [])).isEmpty()


def test_representative_node(spark):
    rows = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 9.0), ("c", 5.0)], "node string, actual double"
    )
    assert metrics.representative_node(rows).first().node == "b"


def test_choice_and_reduction(spark):
    rows = [
        ("t", "validation", "persistence", 0.5), ("t", "validation", "ridge", 0.9),
        ("t", "validation", "random_forest", 0.9), ("t", "validation", "xgboost", 1.2),
        ("t", "test", "persistence", 2.0), ("t", "test", "ridge", 1.5),
    ]
    table = spark.createDataFrame(rows, "task string, partition string, model string, rmse double")
    table = table.withColumns({"mae": F.lit(1.0), "r2": F.lit(0.5)})
    best = compare.best_models(table, ["ridge", "random_forest", "xgboost"])
    assert best.first().selected_model == "ridge"  # first listed wins the tie
    assert compare.rmse_reduction(table, best).first().rmse_reduction_percent == 25.0
    wider = compare.comparison_table([table, table.withColumn("within_1", F.lit(0.1))])
    assert wider.where("within_1 IS NULL").count() == 6
