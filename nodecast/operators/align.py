"""From readings to one row per node and step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from nodecast.config import (
    CORE_SUMMARY_COLUMNS,
    CORE_TEMPERATURE_METRICS,
    DEFAULT_STEP,
    DERIVED_SUMS,
    aligned_metrics,
)
from nodecast.functions.rowwise import (
    present_count,
    present_max,
    present_mean,
    present_sum,
    quoted,
    quoted_name,
)
from nodecast.functions.timeline import as_utc, calendar_parts, floor_to, moment, step_micros
from nodecast.operators.series import named_sql

AGGREGATIONS = {"mean": "avg", "min": "min", "max": "max", "sum": "sum", "median": "median"}
GRID_SPAN_STEPS = 10_000


def _sql_function(aggregation: str) -> str:
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"unknown aggregation {aggregation!r}, use one of {sorted(AGGREGATIONS)}")
    return AGGREGATIONS[aggregation]


def aggregate_metric(
    readings: DataFrame,
    plugin: str,
    metric: str,
    column: str | None = None,
    aggregation: str = "mean",
    step: str = DEFAULT_STEP,
) -> DataFrame:
    """One metric as ``node, timestamp, <column>``, aggregated per step."""
    chosen = readings.where((F.col("plugin") == plugin) & (F.col("metric") == metric))
    start = floor_to(F.col("timestamp"), step_micros(step)).alias("timestamp")
    value = F.expr(f"{_sql_function(aggregation)}(value)")
    return chosen.groupBy("node", start).agg(value.alias(column or metric))


def merge_metric_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Per-metric tables, each with one row per (node, timestamp), side by side.

    The rows of a full outer join over all of them, from one shuffle: the tables
    are stacked and grouped once.  Empty tables give columns of NULLs; it is an
    error if all are empty.  For metrics that come from one set of readings
    ``align_metrics`` gives the same rows; this form is for tables made elsewhere.
    """
    if not frames or all(frame.isEmpty() for frame in frames):
        raise ValueError("there is nothing to merge")
    stacked = reduce(lambda top, rows: top.unionByName(rows, allowMissingColumns=True), frames)
    values = [c for c in stacked.columns if c not in ("node", "timestamp")]
    return stacked.groupBy("node", "timestamp").agg(
        *[F.first(quoted_name(c), ignorenulls=True).alias(c) for c in values]
    )


def align_metrics(
    readings: DataFrame,
    columns: Mapping[str, tuple[str, str]] | None = None,
    step: str = DEFAULT_STEP,
    aggregation: str = "mean",
) -> DataFrame:
    """All metrics side by side: one conditional aggregate per output column.

    One shuffle however many metrics there are, with partial aggregation before
    it.  The shuffle key holds the time, so a node with very many readings is
    spread over all tasks.  A metric without readings is a column of NULLs.
    """
    columns = aligned_metrics() if columns is None else columns
    start = floor_to(F.col("timestamp"), step_micros(step)).alias("timestamp")
    function = _sql_function(aggregation)
    aggregates = {
        column: f"{function}(value) FILTER "
        f"(WHERE plugin = {quoted(plugin)} AND metric = {quoted(metric)})"
        for column, (plugin, metric) in columns.items()
    }
    wanted = reduce(
        Column.__or__,
        [
            (F.col("plugin") == plugin)
            & F.col("metric").isin(sorted({m for p, m in columns.values() if p == plugin}))
            for plugin in sorted({p for p, _ in columns.values()})
        ],
    )
    return readings.where(wanted).groupBy("node", start).agg(*map(F.expr, named_sql(aggregates)))


def summarize_core_temperatures(
    table: DataFrame, sensors: Sequence[str] = CORE_TEMPERATURE_METRICS
) -> DataFrame:
    """Replace the core sensors by their mean, maximum and count per row."""
    values = [c for c in sensors if c in table.columns]
    summary = (
        present_mean(values),
        present_max(values),
        present_count(values).cast("double"),
    )
    rest = [c for c in table.columns if c not in (*sensors, "node", "timestamp")]
    return table.select(
        "node", "timestamp", *[c.alias(n) for n, c in zip(CORE_SUMMARY_COLUMNS, summary)], *rest
    )


def build_core_temperature_features(
    readings: DataFrame,
    sensors: Sequence[tuple[str, str]] | None = None,
    step: str = DEFAULT_STEP,
) -> DataFrame:
    """``node, timestamp`` and the three core temperature summaries."""
    if sensors is None:
        sensors = [("ipmi_pub", name) for name in CORE_TEMPERATURE_METRICS]
    names = [metric for _, metric in sensors]
    aligned = align_metrics(readings, dict(zip(names, sensors)), step)
    return summarize_core_temperatures(aligned, names)


def complete_time_grid(
    nodes: DataFrame, start: datetime | str, end: datetime | str, step: str = DEFAULT_STEP
) -> DataFrame:
    """Every node at every step of [start, end).

    Generated from the node list in two levels, long spans first and the steps
    inside each after a repartition: no cross join, and no array holds more
    than ``GRID_SPAN_STEPS`` moments.
    """
    micros = step_micros(step)
    span = micros * GRID_SPAN_STEPS
    first, stop = (F.unix_micros(moment(as_utc(m))) for m in (start, end))
    last = stop - 1
    spans = nodes.select("node", F.explode(F.sequence(first, last, F.lit(span))).alias("_span"))
    at = F.sequence(
        F.col("_span"), F.least(F.col("_span") + F.lit(span - 1), last), F.lit(micros)
    )
    return (
        spans.repartition("node", "_span")
        .select("node", F.explode(at).alias("_at"))
        .select("node", F.timestamp_micros("_at").alias("timestamp"))
    )


def add_complete_time_grid(
    table: DataFrame,
    nodes: DataFrame,
    start: datetime | str,
    end: datetime | str,
    step: str = DEFAULT_STEP,
) -> DataFrame:
    """The grid with the table's values where it has a row, NULLs elsewhere."""
    grid = complete_time_grid(nodes, start, end, step)
    return grid.join(table, ["node", "timestamp"], "left")


def add_derived_columns(table: DataFrame) -> DataFrame:
    """Sums over paired signals that are both columns, and calendar parts."""
    sums = {
        name: present_sum(parts)
        for name, parts in DERIVED_SUMS.items()
        if set(parts) <= set(table.columns)
    }
    return table.withColumns(sums | calendar_parts(F.col("timestamp")))


def with_target_rows(table: DataFrame, column: str = "cpu_temp_max") -> DataFrame:
    return table.where(F.col(column).isNotNull())
