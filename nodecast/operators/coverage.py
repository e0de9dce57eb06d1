"""How well nodes are covered by readings, and choosing the best covered ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F

from nodecast.config import COVERAGE_METRICS


def count_rows_by_node(readings: DataFrame) -> DataFrame:
    return readings.groupBy("node").agg(F.count(F.lit(1)).alias("rows"))


def coverage_table(
    readings: DataFrame, metrics: Sequence[tuple[str, str]] = COVERAGE_METRICS
) -> DataFrame:
    """Readings per node and metric, for nodes that have all the metrics.

    One conditional count per metric in a single aggregation; a node that lacks
    a metric counts 0 for it and is left out.
    """
    counts = [
        F.count_if((F.col("plugin") == plugin) & (F.col("metric") == metric)).alias(metric)
        for plugin, metric in metrics
    ]
    names = [metric for _, metric in metrics]
    table = readings.groupBy("node").agg(*counts)
    smallest = F.least(*names) if len(names) > 1 else F.col(names[0])
    return table.withColumns(
        {"minimum_rows": smallest, "total_rows": reduce(add, map(F.col, names))}
    ).where("minimum_rows > 0")


def best_covered(coverage: DataFrame, count: int) -> DataFrame:
    """Top nodes by minimum, then total rows; equal ones by node id."""
    return coverage.orderBy(F.desc("minimum_rows"), F.desc("total_rows"), "node").limit(count)


def choose_nodes(coverage: DataFrame, count: int) -> list[str]:
    """The best covered nodes as a list of at most ``count`` ids."""
    nodes = [row.node for row in best_covered(coverage, count).select("node").collect()]
    if not nodes:
        raise RuntimeError(
            "no node has readings of every coverage metric in this period; "
            "move the start or take more days"
        )
    return nodes


def parse_node_list(text: str) -> list[str]:
    return [item for item in map(str.strip, text.split(",")) if item]
