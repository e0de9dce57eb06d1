"""The tables one looks at first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.operators.compare import PERSISTENCE
from nodecast.operators.quality import columns_with_gaps, dataset_head, node_ranges
from nodecast.session import use_utc
from nodecast.sources.sinks import read_report
from nodecast.sources.telemetry import load_telemetry


def explore(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    table = load_telemetry(use_utc(spark), path)
    return {
        "head": dataset_head(table),
        "missing": columns_with_gaps(table),
        "nodes": node_ranges(table),
        "power_and_temperature": table.select("total_power", "cpu_temp_max"),
    }


def held_out_results(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Selected model against persistence, per task, from a metrics report."""
    rows = []
    for task, experiment in read_report(spark, metrics_path)["experiments"].items():
        name = experiment["selected_model"]
        chosen, base = (experiment["test_models"][m] for m in (name, PERSISTENCE))
        rows.append((task, name, chosen["mae"], chosen["rmse"], chosen["r2"], base["rmse"]))
    table = spark.createDataFrame(
        rows,
        "task string, selected_model string, mae double, rmse double, r2 double, "
        "persistence_rmse double",
    )
    reduction = 100 * (F.col("persistence_rmse") - F.col("rmse")) / F.col("persistence_rmse")
    table = table.withColumn("rmse_reduction_percent", reduction)
    figures = [f.name for f in table.schema if f.dataType.typeName() == "double"]
    return table.select("task", "selected_model", *[F.round(c, 3).alias(c) for c in figures])
