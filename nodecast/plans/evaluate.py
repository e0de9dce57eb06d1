"""Measure a saved model again on the period after its validation part."""

from __future__ import annotations

from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from nodecast.config import DEFAULT_HORIZON, TASKS
from nodecast.models.artifact import ModelFacts, artifact_path, load_model
from nodecast.operators.features import build_supervised
from nodecast.operators.metrics import event_proxy_metrics, prediction_table, regression_metrics
from nodecast.operators.split import after_boundary
from nodecast.session import materialize, use_utc
from nodecast.sources.telemetry import load_telemetry


def held_out_predictions(table: DataFrame, model: PipelineModel, facts: ModelFacts) -> DataFrame:
    data = build_supervised(table, facts.target_column, facts.horizon, step=facts.step)
    rows = after_boundary(data.frame, facts.validation_end)
    return prediction_table(model.transform(rows), facts.target_column)


def evaluate(
    spark: SparkSession,
    path: str,
    models_dir: str | None = None,
    task: str = "temperature",
    horizon: int = DEFAULT_HORIZON,
    model_path: str | None = None,
) -> dict[str, Any]:
    """Metrics of the model and of persistence; the model is looked up by task
    and horizon unless its path is given."""
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}, use one of {list(TASKS)}")
    where = model_path or artifact_path(models_dir or "models", task, horizon)
    model, facts = load_model(use_utc(spark), where)
    predictions = materialize(
        held_out_predictions(load_telemetry(spark, path), model, facts), f"{task}-held-out"
    )
    rows = predictions.count()

    def measured(column: str) -> dict[str, float]:
        tolerances = TASKS[task].tolerances
        figures = regression_metrics(predictions, "actual", column, tolerances)
        return figures.drop("rows").first().asDict()

    output = {
        "model": where,
        "task": facts.task,
        "selected_model": facts.selected_model,
        "test_rows": rows,
        "model_metrics": measured("predicted"),
        "persistence_metrics": measured("persistence"),
    }
    if facts.high_temperature_threshold is not None:
        proxy = event_proxy_metrics(predictions, facts.high_temperature_threshold).first()
        output["high_temperature_proxy"] = proxy.asDict()
    return output
