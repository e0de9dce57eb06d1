"""Raw readings: one row per metric, node and moment.

The archive keeps one folder per metric, ``plugin=<p>/metric=<m>/``, each with
the columns ``timestamp``, ``value`` and ``node``.  Folders may differ in how
these are stored (float or double values, text timestamps, numeric node ids).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from nodecast.config import NODE_LIST_LIMIT
from nodecast.functions.rowwise import to_number
from nodecast.functions.timeline import as_utc, moment, parse_timestamp

READING_COLUMNS = ("timestamp", "value", "node")


def read_readings(
    spark: SparkSession,
    root: str,
    metrics: Sequence[tuple[str, str]],
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    nodes: Sequence[str] | None = None,
) -> DataFrame:
    """Readings of the given (plugin, metric) pairs, typed and cleaned.

    Folders that store their columns alike are read by one scan, so an archive
    written uniformly is a single scan with partition pruning.  The time range
    and the node list are also stated on the stored types, which lets Parquet
    skip row groups.
    """
    kinds: dict[tuple[T.DataType, ...], list[str]] = {}
    absent = []
    for plugin, metric in metrics:
        path = metric_folder(root, plugin, metric)
        try:
            stored = spark.read.parquet(path).schema
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            absent.append(path)
            continue
        kinds.setdefault(tuple(stored[c].dataType for c in READING_COLUMNS), []).append(path)
    if absent:
        raise FileNotFoundError(f"no readings found at {absent}")

    scans = []
    for types, paths in kinds.items():
        schema = T.StructType(
            [T.StructField(c, t) for c, t in zip(READING_COLUMNS, types)]
            + [T.StructField(c, T.StringType()) for c in ("plugin", "metric")]
        )
        stored = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        stored = stored.where(_stored_filter(dict(zip(READING_COLUMNS, types)), start, end, nodes))
        scans.append(typed_readings(stored))
    readings = reduce(DataFrame.unionByName, scans)
    return between(on_nodes(readings, nodes), start, end)


def metric_folder(root: str, plugin: str, metric: str) -> str:
    return f"{root.rstrip('/')}/plugin={plugin}/metric={metric}"


def typed_readings(stored: DataFrame) -> DataFrame:
    """Canonical types; rows without a readable time, value or node go."""
    kind = stored.schema["timestamp"].dataType
    return stored.select(
        "plugin",
        "metric",
        F.col("node").cast("string").alias("node"),
        parse_timestamp(F.col("timestamp"), kind).alias("timestamp"),
        to_number(F.col("value")).alias("value"),
    ).dropna(subset=list(READING_COLUMNS))


def between(
    readings: DataFrame, start: datetime | str | None, end: datetime | str | None
) -> DataFrame:
    """Rows with start <= timestamp < end; an open side is not limited."""
    if start is not None:
        readings = readings.where(F.col("timestamp") >= moment(as_utc(start)))
    if end is not None:
        readings = readings.where(F.col("timestamp") < moment(as_utc(end)))
    return readings


def on_nodes(readings: DataFrame, nodes: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the listed nodes.

    A short Python list becomes a predicate.  A long one, or a table of nodes,
    becomes a semi join, which Spark broadcasts only when its measured size is
    below the broadcast threshold.
    """
    if nodes is None:
        return readings
    if not isinstance(nodes, DataFrame) and len(nodes) > NODE_LIST_LIMIT:
        listed = [(str(n),) for n in nodes]
        nodes = readings.sparkSession.createDataFrame(listed, "node string")
    if isinstance(nodes, DataFrame):
        return readings.join(nodes.select("node").distinct(), "node", "left_semi")
    return readings.where(F.col("node").isin([str(n) for n in nodes]))


def _stored_filter(
    types: dict[str, T.DataType],
    start: datetime | str | None,
    end: datetime | str | None,
    nodes: Sequence[str] | None,
) -> Column:
    """The part of the filter that the stored types can express as is."""
    keep = F.lit(True)
    kind = types["timestamp"]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        low, high = (None if m is None else _stored_moment(m, kind) for m in (start, end))
        if low is not None:
            keep = keep & (F.col("timestamp") >= low)
        if high is not None:
            keep = keep & (F.col("timestamp") < high)
    if nodes is None or len(nodes) > NODE_LIST_LIMIT:
        return keep
    if isinstance(types["node"], T.StringType):
        keep = keep & F.col("node").isin([str(n) for n in nodes])
    if isinstance(types["node"], T.IntegralType):
        ids = [int(n) for n in nodes if str(n).lstrip("-").isdecimal()]
        keep = keep & F.col("node").isin(ids)
    return keep


def _stored_moment(value: datetime | str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return moment(as_utc(value))
    wall_clock = as_utc(value).astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(wall_clock.isoformat(sep=" ")).cast("timestamp_ntz")
