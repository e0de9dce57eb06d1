from datetime import datetime, timedelta, timezone

import pytest
from conftest import reading
from pyspark.sql import functions as F

from nodecast.operators.features import (
    align_feature_columns,
    build_inference_features,
    build_supervised,
    engineer_rows,
    history_names,
    latest_per_node,
    node_categories,
    one_hot_nodes,
    recent_rows,
)
from nodecast.operators.series import Over, add_series_columns, add_time_columns, named_sql


START_AT = datetime(2021, 1, 1, tzinfo=timezone.utc)


def test_future_target_and_lags(telemetry):
    data = build_supervised(telemetry, "cpu_temp_max", 5)
    assert data.frame.count() == 50
    ahead = data.frame.select((F.unix_micros("target_timestamp") - F.unix_micros("timestamp")).alias("d"))
    assert [r.d for r in ahead.distinct().collect()] == [300_000_000]
    first = data.frame.where("node = '101'").orderBy("timestamp").first()
    assert first.cpu_temp_max_lag_10 == pytest.approx(reading("cpu_temp_max", "101", 0))
    assert first.target == pytest.approx(reading("cpu_temp_max", "101", 15))


def test_feature_count(telemetry):
    data = build_supervised(telemetry, "cpu_temp_max", 5)
    assert len(data.features) + len(node_categories(data.frame)) == 125 + 2


def test_inference_and_alignment(telemetry):
    data = build_inference_features(telemetry)
    rows = one_hot_nodes(data.frame, node_categories(data.frame))
    assert rows.count() == 60
    expected = rows.columns[2:]
    one = one_hot_nodes(data.frame.where("node = '101'"), ["101"])
    aligned = align_feature_columns(one, expected)
    assert aligned.columns[2:] == expected
    assert aligned.agg(F.max("node_202")).first()[0] == 0.0
    with pytest.raises(ValueError, match="cannot provide"):
        align_feature_columns(one.drop("ambient_lag_1"), expected)


@pytest.mark.parametrize("horizon, column, message", [(0, "cpu_temp_max", "horizon"), (5, "nope", "target")])
def test_rejected_parameters(telemetry, horizon, column, message):
    with pytest.raises(ValueError, match=message):
        build_supervised(telemetry, column, horizon)


@pytest.fixture(scope="module")
def gappy(spark):
    """Three series with gaps, one of them with nearly empty pieces."""
    start = datetime(2021, 3, 3, tzinfo=timezone.utc)
    rows = []
    for node, keep in (("a", lambda m: True), ("b", lambda m: m % 7), ("c", lambda m: m % 23 == 0)):
        rows += [
            (node, start + timedelta(minutes=m), float(m * m % 97)) for m in range(400) if keep(m)
        ]
    return spark.createDataFrame(rows, "node string, timestamp timestamp, v double").cache()


@pytest.mark.parametrize("before, after", [(10, 5), (1, 0), (3, 30), (25, 1)])
@pytest.mark.parametrize("piece_steps", [1, 7, 64])
def test_pieces_equal_whole_series(gappy, before, after, piece_steps):
    def columns(over):
        made = {
            "old": over(f"lag(v, {before})"),
            "mean": over.recent("avg(v)", before + 1),
            "dev": over.recent("stddev_samp(v)", before + 1),
        }
        if after:
            made["next"] = over(f"lead(v, {after})")
            made["due"] = over(f"lead(timestamp, {after})")
        return made

    pieced = add_series_columns(gappy, columns, before, after, piece_steps=piece_steps)
    whole = gappy.selectExpr("*", *named_sql(columns(Over(("node",), "timestamp"))))
    rounded = [
        F.round(c, 9).alias(c) if c in ("mean", "dev") else F.col(c) for c in whole.columns
    ]
    assert pieced.count() == gappy.count()
    assert pieced.select(rounded).exceptAll(whole.select(rounded)).isEmpty()


def test_gap_shifts_rows_but_not_the_target(telemetry):
    gap = telemetry.where(F.minute("timestamp") != 20)
    data = build_supervised(gap, "cpu_temp_max", 5)
    times = {r.timestamp.minute for r in data.frame.where("node='101'").select("timestamp").collect()}
    # rows whose fifth next row is not five minutes ahead are gone
    assert not times & set(range(15, 21)) and 14 in times and 21 in times
    lag = data.frame.where((F.col("node") == "101") & (F.minute("timestamp") == 25)).first()
    # ten rows back, not minutes
    assert lag.cpu_temp_max_lag_10 == pytest.approx(reading("cpu_temp_max", "101", 14))


def test_extra_flag_is_a_feature(telemetry):
    flagged = telemetry.withColumn("hot", F.col("cpu_temp_max") > 50)
    data = build_inference_features(flagged)
    assert "hot" in data.features and "hour_utc" not in data.features


def test_latest_rows_need_few_rows(telemetry):
    broken = telemetry.withColumn(
        "total_power",
        F.when((F.col("node") == "101") & (F.minute("timestamp") == 29), None).otherwise(F.col("total_power")),
    )
    whole = latest_per_node(build_inference_features(broken).frame)
    recent = recent_rows(broken)
    assert recent.count() == 22
    short = latest_per_node(build_inference_features(recent).frame)
    assert short.exceptAll(whole).isEmpty() and short.count() == 2
    assert {r.node: r.timestamp.minute for r in short.collect()} == {"101": 38, "202": 39}


def plan_text(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_all_features_share_one_window(telemetry, spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    telemetry.write.parquet(path)
    plan = plan_text(build_supervised(spark.read.parquet(path), "cpu_temp_max").frame)
    above_union = plan.split("Union")[0]
    assert above_union.count("Window [") == 1 and "Exchange" not in above_union


def test_latest_is_limited_before_the_shuffle(telemetry):
    plan = plan_text(latest_per_node(telemetry.select("node", "timestamp", "ambient")))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_history_names():
    assert history_names() == ["cpu_temp_max_lag_10", "cpu_temp_mean_lag_10", "total_power_lag_10"]


def test_engineer_rows_keeps_every_row(telemetry):
    assert engineer_rows(telemetry).count() == 80


def test_time_windows_see_gaps(spark):
    """Against a lookup by time, over pieces much shorter than the windows."""
    at = [0, 1, 2, 5, 6, 7, 13, 40, 41, 45, 46, 60]
    rows = [(n, START_AT + timedelta(minutes=m), float(m * m + k)) for k, n in enumerate("ab") for m in at[k:]]
    frame = spark.createDataFrame(rows, "node string, timestamp timestamp, x double")
    build = lambda over: {"lag": over.lag("x", 5), "mean": over.recent("avg(x)", 6), "next": over.lead("x", 5)}
    found = add_time_columns(frame, build, before=5, after=5, piece_steps=3)
    plan = found._jdf.queryExecution().executedPlan().toString()  # not run yet
    assert plan.count("Exchange hashpartitioning") == 1
    values = {(n, t): x for n, t, x in rows}
    assert found.count() == len(rows)
    for r in found.collect():
        t = r.timestamp.replace(tzinfo=timezone.utc)
        held = [values.get((r.node, t - timedelta(minutes=m))) for m in range(6)]
        held = [v for v in held if v is not None]
        assert r.lag == values.get((r.node, t - timedelta(minutes=5))) and r.next == values.get((r.node, t + timedelta(minutes=5)))
        assert r.mean == pytest.approx(sum(held) / len(held))


def test_rows_and_time_agree_without_gaps(spark, telemetry):
    by_row, by_time = (build_supervised(telemetry, "cpu_temp_max", 5, mode=m, piece_steps=13) for m in ("rows", "time"))
    shown = lambda data: sorted(data.frame.selectExpr(*[f"round(double(`{c}`), 6) AS `{c}`" if c not in ("node", "timestamp", "target_timestamp") else c for c in data.frame.columns]).collect(), key=str)
    # by rows the first rows of a series have shorter frames too, so the tables agree throughout
    assert by_row.features == by_time.features and shown(by_row) == shown(by_time)
    with pytest.raises(ValueError, match="unknown mode"):
        build_supervised(telemetry, "cpu_temp_max", 5, mode="days")
