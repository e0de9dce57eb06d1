"""Check a telemetry table and report its quality."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession

from nodecast.config import DEFAULT_STEP
from nodecast.operators.quality import quality_report
from nodecast.session import use_utc
from nodecast.sources.sinks import write_report
from nodecast.sources.telemetry import load_telemetry


def inspect(
    spark: SparkSession, path: str, output: str | None = None, step: str = DEFAULT_STEP
) -> dict[str, Any]:
    report = quality_report(load_telemetry(use_utc(spark), path), step)
    if output:
        write_report(spark, report, output)
    return report
