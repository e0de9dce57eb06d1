"""Raw readings to a wide telemetry table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.config import (
    CORE_TEMPERATURE_METRICS,
    COVERAGE_METRICS,
    DEFAULT_STEP,
    GANGLIA_METRICS,
    IPMI_METRICS,
    REQUIRED_COLUMNS,
    aligned_metrics,
)
from nodecast.functions.timeline import as_utc, floor_moment, step_micros
from nodecast.operators.align import (
    add_complete_time_grid,
    add_derived_columns,
    align_metrics,
    summarize_core_temperatures,
    with_target_rows,
)
from nodecast.operators.coverage import best_covered, choose_nodes, coverage_table, parse_node_list
from nodecast.operators.quality import summarize_data
from nodecast.session import use_utc
from nodecast.sources.readings import between, read_readings
from nodecast.sources.sinks import (
    data_dictionary,
    with_column_notes,
    write_csv,
    write_parquet,
    write_report,
)


@dataclass(frozen=True)
class Prepared:
    table: DataFrame
    nodes: list[str]
    summary: dict[str, Any]


def requested_period(start: str | datetime, days: int) -> tuple[datetime, datetime]:
    if days <= 0:
        raise ValueError("days must be greater than zero")
    first = as_utc(start)
    return first, first + timedelta(days=days)


def wide_table(
    readings: DataFrame,
    start: datetime | str,
    end: datetime | str,
    step: str = DEFAULT_STEP,
    grid_nodes: DataFrame | None = None,
) -> DataFrame:
    """Readings of chosen nodes and a period as the wide table.

    A step without a core temperature is dropped.  The complete grid only adds
    such steps, so it is built (and joined) only to keep them, for the nodes in
    ``grid_nodes``; it starts at the step that holds ``start``, as the buckets do.
    """
    table = summarize_core_temperatures(align_metrics(between(readings, start, end), step=step))
    if grid_nodes is not None:
        first = floor_moment(start, step_micros(step))
        table = add_complete_time_grid(table, grid_nodes, first, end, step)
    else:
        table = with_target_rows(table)
    return add_derived_columns(table).select(*REQUIRED_COLUMNS)


def prepare(
    spark: SparkSession,
    root: str,
    output_dir: str,
    start: str | datetime,
    days: int = 7,
    node_count: int = 12,
    nodes: Sequence[str] | str = (),
    step: str = DEFAULT_STEP,
    also_csv: bool = True,
) -> Prepared:
    """Choose nodes, align their metrics and write the wide table.

    Two passes over the archive: the four coverage metrics of all nodes, then
    all metrics of the chosen nodes, whose ids reach the Parquet scan.
    """
    use_utc(spark)
    first, last = requested_period(start, days)
    if node_count <= 0:
        raise ValueError("node_count must be greater than zero")
    chosen = parse_node_list(nodes) if isinstance(nodes, str) else [str(n) for n in nodes]
    automatic = not chosen
    if automatic:
        coverage = coverage_table(read_readings(spark, root, COVERAGE_METRICS, first, last))
        write_csv(
            coverage.orderBy(F.desc("minimum_rows"), F.desc("total_rows"), "node"),
            f"{output_dir}/node-coverage",
        )
        written = spark.read.option("header", True).schema(coverage.schema).csv(
            f"{output_dir}/node-coverage"
        )
        chosen = choose_nodes(best_covered(written, node_count), node_count)

    readings = read_readings(
        spark, root, list(aligned_metrics().values()), first, last, chosen
    )
    table = wide_table(readings, first, last, step)
    path = f"{output_dir}/telemetry.parquet"
    write_parquet(with_column_notes(table), path, sort=("node", "timestamp"))
    written = spark.read.parquet(path)
    if written.isEmpty():
        raise RuntimeError("the period has no temperature rows; move the start or take more days")
    if also_csv:
        write_csv(written, f"{output_dir}/telemetry.csv.gz", gzip=True, sort=("node", "timestamp"))
    write_csv(data_dictionary(written), f"{output_dir}/data-dictionary")

    summary = summarize_data(written) | {
        "source": root.rstrip("/").rsplit("/", 1)[-1],
        "requested_start": first.isoformat(),
        "requested_end_exclusive": last.isoformat(),
        "frequency": step,
        "selected_core_temperature_metrics": list(CORE_TEMPERATURE_METRICS),
        "selected_single_metrics": {
            name: {"plugin": plugin, "metric": metric}
            for name, (plugin, metric) in aligned_metrics().items()
            if name in IPMI_METRICS + GANGLIA_METRICS
        },
        "selection_method": "automatic overlap coverage" if automatic else "explicit node list",
    }
    write_report(spark, summary, f"{output_dir}/metadata.json")
    return Prepared(written, chosen, summary)
