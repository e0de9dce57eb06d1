"""A quality overview that grows by period instead of reading all rows again.

Periods share no time, so their rows, times, and repeated keys add up exactly.
Nodes do occur in many periods: each keeps a sketch of its nodes, and the merged
sketches estimate how many there are.  A new or corrected period is read and
stored by itself; storing it again replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.functions.timeline import floor_to, iso_text, step_micros

DAY = "1 day"
REGISTERS = 14  # two to this power of them in a sketch of up to 16 KB


def relative_error(registers: int = REGISTERS) -> float:
    """What the estimate stays within, relative to the count: three deviations."""
    return 3 * 1.04 / 2 ** (registers / 2)


def period_rows(table: DataFrame, period: str = DAY, registers: int = REGISTERS) -> DataFrame:
    """One row per period: rows, distinct times, first and last, repeated keys, nodes.

    Rows without a time are a period of their own, NULL.  Hot keys collapse
    before the shuffle; then a period's times are added up, with one sketch a time.
    """
    keys = table.groupBy("node", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    times = keys.groupBy("timestamp").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") - 1).alias("extra"),
        F.hll_sketch_agg("node", F.lit(registers)).alias("sketch"),
    )
    return times.groupBy(floor_to(F.col("timestamp"), step_micros(period)).alias("period")).agg(
        F.sum("n").alias("rows"),
        F.count("timestamp").alias("unique_timestamps"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.sum("extra").alias("duplicates"),
        F.hll_union_agg("sketch").alias("nodes"),
    )


def store_periods(table: DataFrame, path: str, period: str = DAY, registers: int = REGISTERS) -> None:
    """Add the table's periods to those stored, or replace them.  A period has to
    come whole; other periods are neither read nor written."""
    rows = period_rows(table, period, registers)
    folder = F.coalesce(F.unix_micros("period").cast("string"), F.lit("none")).alias("at")
    writer = rows.select("*", folder).write.mode("overwrite").partitionBy("at")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def overview(spark: SparkSession, path: str) -> DataFrame:
    """``quality_overview`` of all stored periods, with an estimate of the nodes."""
    return merged(spark.read.parquet(path))


def merged(periods: DataFrame) -> DataFrame:
    """One row from any periods; also from none, with counts of 0."""
    zero = F.lit(0).cast("long")
    return periods.agg(
        F.coalesce(F.sum("rows"), zero).alias("rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("nodes")), zero).alias("nodes"),
        F.coalesce(F.sum("unique_timestamps"), zero).alias("unique_timestamps"),
        iso_text(F.min("first")).alias("timestamp_min"),
        iso_text(F.max("last")).alias("timestamp_max"),
        F.coalesce(F.sum("duplicates"), zero).alias("duplicates_node_timestamp"),
    )
