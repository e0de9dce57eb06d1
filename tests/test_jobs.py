import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from nodecast.config import CORE_TEMPERATURE_METRICS, GANGLIA_METRICS, IPMI_METRICS, REQUIRED_COLUMNS
from nodecast.models.artifact import load_model
from nodecast.plans.evaluate import evaluate
from nodecast.plans.explore import explore, held_out_results
from nodecast.plans.inspect import inspect
from nodecast.plans.predict import predict
from nodecast.plans.prepare import prepare, requested_period
from nodecast.plans.train import train
from nodecast.session import shared_folder

START = datetime(2021, 3, 3, tzinfo=timezone.utc)
MINUTES, NODES = 150, ("119", "35", "7")


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """Two readings a minute per metric and node; node 7 lacks cpu_user."""
    root = str(tmp_path_factory.mktemp("raw") / "month")
    singles = {m: ("ganglia_pub" if m in GANGLIA_METRICS else "ipmi_pub") for m in
               CORE_TEMPERATURE_METRICS + IPMI_METRICS + GANGLIA_METRICS}
    rows = []
    for place, node in enumerate(NODES):
        for half in range(2 * MINUTES):
            at = START + timedelta(seconds=30 * half)
            wave = math.sin(half / 17) + 0.1 * math.cos(half * 1.7)
            for number, (metric, plugin) in enumerate(singles.items()):
                if metric == "cpu_user" and (node == "7" or half % 6):
                    continue
                value = 50 + 5 * place + 10 * wave + number + (half * 7919 % 13) / 10
                rows.append((plugin, metric, at, value, node))
    frame = spark.createDataFrame(
        rows, "plugin string, metric string, timestamp timestamp, value double, node string"
    )
    frame.write.partitionBy("plugin", "metric").parquet(root)
    return root


@pytest.fixture(scope="module")
def prepared(spark, archive, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("prepared"))
    return out, prepare(spark, archive, out, "2021-03-03T00:00:00Z", days=1, node_count=5)


def test_prepare(spark, prepared):
    out, result = prepared
    assert result.nodes == ["119", "35"]  # node 7 has no cpu_user
    assert result.table.columns == list(REQUIRED_COLUMNS)
    assert result.table.count() == 2 * MINUTES
    assert result.summary["selection_method"] == "automatic overlap coverage"
    assert result.summary["nodes"] == ["119", "35"]
    assert result.summary["requested_end_exclusive"] == "2021-03-04T00:00:00+00:00"
    assert result.summary["missing_percent"]["cpu_user"] == pytest.approx(66.667)
    coverage = spark.read.option("header", True).csv(f"{out}/node-coverage")
    assert {r.node for r in coverage.collect()} == {"119", "35"}
    row = result.table.where("node = '35'").orderBy("timestamp").first()
    assert row.cpu_temp_sensor_count == 8.0 and row.cpu_temp_max > row.cpu_temp_mean


def test_prepare_explicit_nodes(spark, archive, tmp_path):
    result = prepare(
        spark, archive, str(tmp_path), "2021-03-03T00:10:00", days=1, nodes=" 7, 35 ,", step="2min"
    )
    assert result.nodes == ["7", "35"] and result.table.count() == 2 * (MINUTES - 10) // 2
    assert result.summary["selection_method"] == "explicit node list"
    assert not (tmp_path / "node-coverage").exists()
    assert result.table.where("node = '7' AND cpu_busy IS NULL").isEmpty()  # cpu_system alone


def test_prepare_rejects(spark, archive, tmp_path):
    with pytest.raises(ValueError):
        requested_period("2021-03-03", 0)
    with pytest.raises(ValueError):
        prepare(spark, archive, str(tmp_path), "2021-03-03", node_count=0)
    with pytest.raises(FileNotFoundError):
        prepare(spark, str(tmp_path / "none"), str(tmp_path), "2021-03-03")
    with pytest.raises(RuntimeError, match="no node"):
        prepare(spark, archive, str(tmp_path), "2022-03-03")
    with pytest.raises(RuntimeError, match="no temperature rows"):
        prepare(spark, archive, str(tmp_path), "2021-03-03", nodes=["404"])


def test_inspect_and_explore(spark, prepared, tmp_path):
    out, _ = prepared
    report = inspect(spark, f"{out}/telemetry.csv.gz", str(tmp_path / "q.json"))
    assert report["rows"] == 2 * MINUTES and report["sampling_gap_seconds"]["median"] == 60.0
    views = explore(spark, f"{out}/telemetry.parquet")
    assert views["head"].first().nodes == 2 and views["nodes"].count() == 2
    assert "cpu_user" in {r.column for r in views["missing"].collect()}


@pytest.fixture(scope="module")
def trained(spark, prepared, tmp_path_factory):
    out, _ = prepared
    models, reports = (str(tmp_path_factory.mktemp(n)) for n in ("models", "reports"))
    results = train(
        spark, f"{out}/telemetry.parquet", models, reports, sizes={"random_forest": {"numTrees": 8}},
        candidates=["ridge", "random_forest"],
    )
    return f"{out}/telemetry.parquet", models, reports, results


def test_train_reports(spark, trained):
    _, _, reports, results = trained
    heat = results["experiments"]["temperature"]
    assert heat["rows"] == 2 * (MINUTES - 15) and heat["features"] == 125 + 2
    sizes = heat["split"]
    assert sizes["train_rows"] + sizes["validation_rows"] + sizes["test_rows"] == heat["rows"]
    assert set(heat["validation_models"]) == {"persistence", "ridge", "random_forest"}
    assert set(heat["test_models"]) == {"persistence", heat["selected_model"]}
    assert heat["high_temperature_proxy"]["threshold"] > 0
    assert results["experiments"]["power"]["high_temperature_proxy"] is None
    comparison = spark.read.option("header", True).csv(f"{reports}/model_comparison")
    assert comparison.count() == 2 * 5
    assert comparison.where("task = 'power' AND within_1 IS NULL").count() == 5
    importance = spark.read.option("header", True).csv(
        f"{reports}/temperature_5min_feature_importance"
    )
    assert importance.count() == 127
    table = held_out_results(spark, f"{reports}/metrics.json").collect()
    assert {r.task for r in table} == {"temperature", "power"}


@pytest.mark.parametrize("task", ["temperature", "power"])
def test_saved_models_reproduce_their_metrics(spark, trained, task):
    path, models, reports, results = trained
    reported = results["experiments"][task]
    again = evaluate(spark, path, models, task)
    assert again["selected_model"] == reported["selected_model"]
    chosen = reported["test_models"][reported["selected_model"]]
    for name, value in again["model_metrics"].items():
        assert value == pytest.approx(chosen[name], abs=1e-6)
    base = reported["test_models"]["persistence"]
    assert again["persistence_metrics"]["rmse"] == pytest.approx(base["rmse"], abs=1e-6)
    predictions = spark.read.option("header", True).csv(f"{reports}/{task}_5min_test_predictions")
    assert predictions.count() == again["test_rows"]
    assert ("high_temperature_proxy" in again) == (task == "temperature")


def test_predict(spark, trained, tmp_path):
    path, models, _, _ = trained
    latest = predict(spark, path, models, output=str(tmp_path / "out"))
    assert latest.columns == [
        "node", "timestamp", "forecast_timestamp", "predicted_cpu_temp_max", "unit"
    ]
    rows = latest.collect()
    assert sorted(r.node for r in rows) == ["119", "35"]
    assert all(r.forecast_timestamp - r.timestamp == timedelta(minutes=5) for r in rows)
    every = predict(spark, path, models, all_rows=True)
    assert every.count() == 2 * (MINUTES - 10)
    same = every.join(latest.select("node", "timestamp"), ["node", "timestamp"], "left_semi")
    assert {r.node: round(r.predicted_cpu_temp_max, 9) for r in same.collect()} == {
        r.node: round(r.predicted_cpu_temp_max, 9) for r in rows
    }
    assert predict(spark, path, models, node="35").count() == 1
    with pytest.raises(ValueError, match="404"):
        predict(spark, path, models, node="404")


def test_unseen_node_can_be_scored(spark, trained, tmp_path):
    path, models, _, _ = trained
    renamed = spark.read.parquet(path).where("node = '35'").withColumn("node", F.lit("900"))
    other = str(tmp_path / "other.parquet")
    renamed.write.parquet(other)
    assert predict(spark, other, models).first().predicted_cpu_temp_max > 0


def test_artifact(spark, trained):
    _, models, _, results = trained
    _, facts = load_model(spark, f"{models}/temperature_5min")
    assert facts.horizon == 5 and facts.nodes == ["119", "35"] and facts.unit == "degrees Celsius"
    assert facts.validation_end.isoformat() == facts.validation_target_end
    with pytest.raises(FileNotFoundError):
        load_model(spark, f"{models}/temperature_10min")


def test_train_rejects(spark, trained):
    with pytest.raises(ValueError, match="horizon"):
        train(spark, trained[0], "m", "r", horizon=0)
    with pytest.raises(ValueError, match="unknown task"):
        train(spark, trained[0], "m", "r", task="noise")
    with pytest.raises(ValueError, match="unknown task"):
        evaluate(spark, trained[0], "m", "noise")


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
