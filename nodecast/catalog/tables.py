"""The given tables seen as telemetry.

``events`` is already a table of readings: one per user and moment, with the
event type as the metric.  Each ``lineitem`` row becomes one reading of several
machine metrics of its supplier, so that the full set of signals is there: some
on every row, some only on a share of the rows, one core sensor never.  All
rows of both tables are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.config import (
    CORE_TEMPERATURE_METRICS,
    GANGLIA_METRICS,
    REQUIRED_COLUMNS,
)
from nodecast.functions.timeline import floor_to, step_micros
from nodecast.operators.align import add_derived_columns, summarize_core_temperatures
from nodecast.sources.readings import READING_COLUMNS, metric_folder

EVENT_METRICS = ("click", "error", "purchase", "signup", "view")
EVENT_STEP, WEEK = "1 day", "7 days"

# metric -> SQL expression over a lineitem row, the same text in both engines
LINEITEM_METRICS = {
    **{
        name: f"CASE WHEN l_linenumber = {place} THEN 30 + l_quantity END"
        for place, name in enumerate(CORE_TEMPERATURE_METRICS, start=1)
    },
    "ambient": "14 + 100 * l_discount",
    "p0_power": "4 * l_quantity",
    "p1_power": "CASE WHEN l_linestatus = 'F' THEN 3 * l_quantity END",
    "total_power": "l_extendedprice / 100",
    "p0_vdd_temp": "25 + 100 * l_tax",
    "p1_vdd_temp": "22 + 100 * l_discount",
    "cpu_user": "CASE WHEN l_returnflag = 'A' THEN l_quantity END",
    "cpu_system": "CASE WHEN l_returnflag = 'R' THEN 100 * l_tax END",
    "cpu_idle": "CASE WHEN l_returnflag = 'N' THEN 100 - l_quantity END",
    "cpu_wio": "CASE WHEN l_returnflag = 'N' THEN 0 * l_quantity END",
    "cpu_speed": "3800 + 0 * l_quantity",
    "load_one": "l_extendedprice / 1000",
    "load_five": "CASE WHEN l_linenumber < 4 THEN l_quantity END",
    "load_fifteen": "CASE WHEN l_linenumber > 3 THEN l_quantity END",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.lit("app").alias("plugin"),
        F.col("event_type").alias("metric"),
        F.col("user_id").cast("string").alias("node"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "value",
    )


# how the folders of the archive store time, value and node, where not as above
STORED = {
    "error": ("date_format(timestamp, 'yyyy-MM-dd HH:mm:ss.SSSSSS')", "float(value)", "bigint(node)"),
    "purchase": ("CAST(timestamp AS TIMESTAMP_NTZ)", "value", "int(node)"),
    "signup": ("timestamp", "float(value)", "node"),
}


def write_archive(readings: DataFrame, root: str) -> None:
    """One folder per event type, not all with the same stored types."""
    for metric in EVENT_METRICS:
        stored = STORED.get(metric, READING_COLUMNS)
        columns = [f"{sql} AS {name}" for sql, name in zip(stored, READING_COLUMNS)]
        rows = readings.where(F.col("metric") == metric).selectExpr(*columns)
        rows.write.parquet(metric_folder(root, "app", metric))


def lineitem_readings(spark: SparkSession, folder: str) -> DataFrame:
    """One reading per lineitem row and metric that has a value there."""
    values = [f"double({value}) AS `{name}`" for name, value in LINEITEM_METRICS.items()]
    wide = table(spark, folder, "lineitem").selectExpr(
        "string(l_suppkey) AS node", "timestamp(l_shipdate) AS timestamp", *values
    )
    long = wide.unpivot(["node", "timestamp"], list(LINEITEM_METRICS), "metric", "value")
    plugin = F.when(F.col("metric").isin(*GANGLIA_METRICS), "ganglia_pub").otherwise("ipmi_pub")
    return long.where("value IS NOT NULL").select(
        plugin.alias("plugin"), "metric", "node", "timestamp", "value"
    )


def telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """The wide table, one row per supplier and week, with all its columns.

    Averages the metrics straight from the lineitem rows; ``align_metrics`` on
    ``lineitem_readings`` gives the same table.
    """
    week = floor_to(F.col("l_shipdate").cast("timestamp"), step_micros(WEEK))
    averages = [F.expr(f"avg({e}) AS `{name}`") for name, e in LINEITEM_METRICS.items()]
    aligned = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias("node"), week.alias("timestamp"))
        .agg(*averages)
    )
    wide = add_derived_columns(summarize_core_temperatures(aligned))
    return wide.select(*REQUIRED_COLUMNS)


def event_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """A narrower wide table, one row per user and day."""
    day = floor_to(F.col("ts").cast("timestamp"), step_micros(EVENT_STEP)).alias("timestamp")
    by_type = [
        F.expr(f"avg(value) FILTER (WHERE event_type = '{m}') AS `{m}`") for m in EVENT_METRICS
    ]
    return (
        table(spark, folder, "events")
        .groupBy(F.col("user_id").cast("string").alias("node"), day)
        .agg(
            F.avg("value").alias("value_mean"),
            F.max("value").alias("value_max"),
            F.count(F.lit(1)).cast("double").alias("value_count"),
            *by_type,
        )
    )
