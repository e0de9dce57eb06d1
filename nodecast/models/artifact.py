"""Saving a selected model together with what is needed to use it again."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from nodecast.sources.sinks import read_report, write_report


@dataclass(frozen=True)
class ModelFacts:
    """Everything about a saved model except the fitted stages."""

    task: str
    target_column: str
    display_name: str
    unit: str
    horizon: int
    step: str
    selected_model: str
    selected_parameters: dict[str, Any]
    selection_metric: str
    train_target_end: str
    validation_target_end: str
    high_temperature_threshold: float | None
    numeric_features: list[str]
    nodes: list[str]
    medians: dict[str, float]
    dropped_features: list[str]
    spark_version: str

    @property
    def validation_end(self) -> datetime:
        return datetime.fromisoformat(self.validation_target_end)


def artifact_path(models_dir: str, task: str, horizon: int) -> str:
    """Models are looked up by task and horizon."""
    return f"{models_dir.rstrip('/')}/{task}_{horizon}min"


def save_model(spark: SparkSession, path: str, model: PipelineModel, facts: ModelFacts) -> None:
    model.write().overwrite().save(f"{path}/pipeline")
    write_report(spark, asdict(facts), f"{path}/facts")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, ModelFacts]:
    facts = ModelFacts(**read_report(spark, f"{path}/facts"))
    return PipelineModel.load(f"{path}/pipeline"), facts
