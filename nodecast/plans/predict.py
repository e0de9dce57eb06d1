"""Forecast from the latest row of every node, or from every usable row."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.config import DEFAULT_HORIZON, TASKS
from nodecast.functions.timeline import micros_interval, step_micros
from nodecast.models.artifact import ModelFacts, artifact_path, load_model
from nodecast.operators.features import (
    align_feature_columns,
    build_inference_features,
    latest_per_node,
    recent_rows,
)
from nodecast.session import use_utc
from nodecast.sources.sinks import write_csv
from nodecast.sources.telemetry import load_telemetry


def forecast_output(
    rows: DataFrame, predicted: str, target_column: str, horizon: int, step: str, unit: str
) -> DataFrame:
    """Keys, the time the forecast is for, the forecast and its unit."""
    due = F.col("timestamp") + micros_interval(horizon * step_micros(step))
    return rows.select(
        "node",
        "timestamp",
        due.alias("forecast_timestamp"),
        F.col(predicted).alias(f"predicted_{target_column}"),
        F.lit(unit).alias("unit"),
    )


def forecasts(
    table: DataFrame,
    model: PipelineModel,
    facts: ModelFacts,
    node: str | None = None,
    all_rows: bool = False,
) -> DataFrame:
    if node is not None:
        table = table.where(F.col("node") == str(node))
    if not all_rows:
        table = recent_rows(table, step=facts.step)
    rows = build_inference_features(table, step=facts.step).frame
    if not all_rows:
        rows = latest_per_node(rows)
    rows = align_feature_columns(rows, facts.numeric_features)
    scored = model.transform(rows)
    return forecast_output(
        scored, "prediction", facts.target_column, facts.horizon, facts.step, facts.unit
    )


def predict(
    spark: SparkSession,
    path: str,
    models_dir: str | None = None,
    task: str = "temperature",
    horizon: int = DEFAULT_HORIZON,
    model_path: str | None = None,
    node: str | None = None,
    all_rows: bool = False,
    output: str | None = None,
) -> DataFrame:
    """Forecast table; written as CSV if ``output`` is given."""
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}, use one of {list(TASKS)}")
    where = model_path or artifact_path(models_dir or "models", task, horizon)
    model, facts = load_model(use_utc(spark), where)
    result = forecasts(load_telemetry(spark, path), model, facts, node, all_rows)
    if node is not None and result.isEmpty():
        raise ValueError(f"node {node} has no row with enough history")
    if output:
        write_csv(result, output, sort=("node", "timestamp"))
    return result
