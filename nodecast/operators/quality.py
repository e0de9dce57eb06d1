"""Data quality of a wide telemetry table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from nodecast.config import DEFAULT_STEP, PIECE_STEPS
from nodecast.functions.rowwise import is_number, quoted, quoted_name
from nodecast.functions.timeline import iso_text, seconds_between
from nodecast.operators.quantiles import exact_percentiles
from nodecast.operators.series import add_series_columns, named_sql
from nodecast.session import materialize


def key_counts(table: DataFrame) -> DataFrame:
    """Rows per (node, timestamp); hot keys collapse before the shuffle."""
    return table.groupBy("node", "timestamp").agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(table: DataFrame) -> DataFrame:
    """The keys that occur more than once, with how often."""
    return key_counts(table).where("n > 1")


def rows_per_node(table: DataFrame) -> DataFrame:
    return table.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.count(F.lit(1)).alias("rows")
    )


def quality_overview(table: DataFrame) -> DataFrame:
    """One row: rows, distinct nodes and times, time range, duplicate rows.

    Distinct counts are taken in two grouped steps from the key counts rather
    than by several distinct aggregates, which would multiply every row.
    """
    keys = key_counts(table)
    by_time = keys.groupBy("timestamp").agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("extra"))
    by_node = keys.groupBy("node").agg(F.lit(1).alias("one"))
    times = by_time.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("timestamp").alias("unique_timestamps"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates_node_timestamp"),
    )
    return times.select(
        "rows",
        by_node.agg(F.count("node")).scalar().alias("nodes"),
        "unique_timestamps",
        iso_text(F.col("first")).alias("timestamp_min"),
        iso_text(F.col("last")).alias("timestamp_max"),
        "duplicates_node_timestamp",
    )


def sampling_gaps(
    table: DataFrame, step: str = DEFAULT_STEP, piece_steps: int = PIECE_STEPS
) -> DataFrame:
    """Seconds since the previous row of the same node; first rows have none."""
    keys = table.select("node", "timestamp")

    rows = add_series_columns(
        keys,
        lambda over: {"_previous": over("lag(timestamp)")},
        before=1,
        step=step,
        piece_steps=piece_steps,
    )
    gap = seconds_between(F.col("timestamp"), F.col("_previous"))
    return rows.dropna(subset=["_previous"]).select("node", "timestamp", gap.alias("gap_seconds"))


def sampling_gap_summary(
    table: DataFrame, step: str = DEFAULT_STEP, piece_steps: int = PIECE_STEPS
) -> DataFrame:
    """One row: minimum, exact median and maximum gap."""
    gaps = materialize(sampling_gaps(table, step, piece_steps).select("gap_seconds"), "gaps")
    found = exact_percentiles(gaps, [], "gap_seconds", [0.0, 0.5, 1.0])
    return found.select(
        *[
            F.get("percentiles", F.lit(place)).alias(name)
            for place, name in enumerate(("minimum", "median", "maximum"))
        ]
    )


def column_profile(table: DataFrame) -> DataFrame:
    """One row per column: ``column, missing_percent, minimum, maximum, mean``.

    All columns in one pass; the ranges are NULL for columns that are not
    numeric, and for numeric ones without values.
    """
    numeric = {f.name for f in table.schema if is_number(f.dataType)}
    return _profile(table, tuple(table.columns), numeric)


def missing_percent(table: DataFrame) -> DataFrame:
    """(column, missing_percent) with three decimals, for every column."""
    return _profile(table, tuple(table.columns), set()).select("column", "missing_percent")


def columns_with_gaps(table: DataFrame) -> DataFrame:
    return missing_percent(table).where("missing_percent > 0").orderBy(F.desc("missing_percent"), "column")


def numeric_ranges(table: DataFrame) -> DataFrame:
    """(column, minimum, maximum, mean) of every numeric column."""
    names = tuple(f.name for f in table.schema if is_number(f.dataType))
    return _profile(table, names, set(names)).drop("missing_percent")


def _profile(table: DataFrame, columns: tuple[str, ...], numeric: set[str]) -> DataFrame:
    """A wide single-row aggregate, turned into one row per column."""
    figures, entries = {}, []
    for place, column in enumerate(columns):
        held = quoted_name(column)
        taken = {
            "missing_percent": f"round(100 * avg(double({held} IS NULL)), 3)",
            "minimum": f"min(double({held}))",
            "maximum": f"max(double({held}))",
            "mean": f"avg(double({held}))",
        }
        parts = [f"{quoted(column)} AS `column`"]
        for name, sql in taken.items():
            if name == "missing_percent" or column in numeric:
                figures[f"{name}_{place}"] = sql
                parts.append(f"`{name}_{place}` AS `{name}`")
            else:
                parts.append(f"CAST(NULL AS DOUBLE) AS `{name}`")
        entries.append(f"struct({', '.join(parts)})")
    wide = table.agg(*map(F.expr, named_sql(figures)))
    return wide.selectExpr(f"inline(array({', '.join(entries)}))")


def node_ranges(
    table: DataFrame, temperature: str = "cpu_temp_max", power: str = "total_power"
) -> DataFrame:
    """Operating range of each node, two decimals."""
    figures = {
        "temperature_mean": F.avg(temperature),
        "temperature_min": F.min(temperature),
        "temperature_max": F.max(temperature),
        "power_mean": F.avg(power),
        "power_max": F.max(power),
    }
    return table.groupBy("node").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.round(value, 2).alias(name) for name, value in figures.items()],
    )


def dataset_head(table: DataFrame) -> DataFrame:
    """One row: rows, nodes and time range."""
    return quality_overview(table).select("rows", "nodes", "timestamp_min", "timestamp_max")


def quality_report(table: DataFrame, step: str = DEFAULT_STEP) -> dict[str, Any]:
    """The report as nested Python values: one entry per node and per column."""
    overview = quality_overview(table).first().asDict()
    gaps = sampling_gap_summary(table, step).first()
    nodes = rows_per_node(table).orderBy("node").collect()
    return {
        "rows": overview["rows"],
        "columns": table.columns,
        **{k: v for k, v in overview.items() if k != "rows"},
        "rows_per_node": {row.node: row.rows for row in nodes},
        "sampling_gap_seconds": gaps.asDict() if gaps else None,
        **_column_entries(table),
    }


def summarize_data(table: DataFrame) -> dict[str, Any]:
    """The shorter summary that goes with a freshly prepared table."""
    overview = quality_overview(table).first()
    nodes = table.select("node").dropna().distinct().orderBy("node").collect()
    return {
        "rows": overview.rows,
        "columns": table.columns,
        "nodes": [row.node for row in nodes],
        "timestamp_min": overview.timestamp_min,
        "timestamp_max": overview.timestamp_max,
        **_column_entries(table),
    }


def _column_entries(table: DataFrame) -> dict[str, dict[str, Any]]:
    numeric = {f.name for f in table.schema if is_number(f.dataType)}
    profile = column_profile(table).collect()
    return {
        "missing_percent": {row.column: row.missing_percent for row in profile},
        "numeric_ranges": {
            row.column: {"minimum": row.minimum, "maximum": row.maximum, "mean": row.mean}
            for row in profile
            if row.column in numeric
        },
    }
