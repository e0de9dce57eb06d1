"""The wide telemetry table: loading it, checking it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from nodecast.config import REQUIRED_COLUMNS
from nodecast.functions.rowwise import to_number
from nodecast.functions.timeline import parse_timestamp
from nodecast.session import materialize

SMALL_TYPES = {"hour_utc": "smallint", "day_of_week_utc": "tinyint"}
CORE_NUMBERS = tuple(c for c in REQUIRED_COLUMNS if c not in ("node", "timestamp"))


def load_telemetry(
    spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED_COLUMNS
) -> DataFrame:
    """Read a wide table from Parquet, CSV or gzip CSV, and check it.

    ``path`` may be one file or a folder of such files, named by its suffix.
    The result has a string ``node``, a UTC ``timestamp`` and DOUBLE signals in
    which NaN is NULL.  Extra columns are kept.  Rows are in no special order;
    order them where they are written.
    """
    name = path.rstrip("/").lower()
    if not name.endswith((".parquet", ".csv", ".csv.gz")):
        raise ValueError(f"unsupported telemetry format, use .parquet, .csv or .csv.gz: {path}")
    as_csv = not name.endswith(".parquet")
    try:
        if as_csv:
            stored = spark.read.option("header", True).csv(path)
        else:
            stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"telemetry does not exist: {path}") from error
        raise
    require_columns(stored, required)
    if name.endswith(".gz") and len(stored.inputFiles()) < spark.sparkContext.defaultParallelism:
        # one gzip file is one task; spread the rows of few before any work is done
        stored = stored.repartition("node", "timestamp")
    table = typed_telemetry(stored, _numeric_extras(stored) if as_csv else ())
    if as_csv:  # text is parsed once; all later jobs read its columns
        table = materialize(table, "telemetry")
    check_keys(table)
    return table


def require_columns(table: DataFrame, required: tuple[str, ...]) -> None:
    missing = sorted(set(required) - set(table.columns))
    if missing:
        raise ValueError(f"telemetry is missing required columns: {missing}")


def typed_telemetry(stored: DataFrame, text_numbers: tuple[str, ...] = ()) -> DataFrame:
    """The table with canonical column types and NULL for every NaN."""
    columns = []
    for column in stored.schema:
        value, kind = F.col(f"`{column.name}`"), column.dataType
        if column.name == "node":
            value = value.cast("string")
        elif column.name == "timestamp":
            value = parse_timestamp(value, kind)
        elif column.name in SMALL_TYPES:
            value = to_number(value).cast(SMALL_TYPES[column.name])
        elif column.name in CORE_NUMBERS or column.name in text_numbers:
            value = to_number(value)
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)
        columns.append(value.alias(column.name))
    return stored.select(columns)


def _numeric_extras(stored: DataFrame) -> tuple[str, ...]:
    """Extra CSV columns in which every value that is there is a number."""
    extras = [c for c in stored.columns if c not in REQUIRED_COLUMNS]
    if not extras:
        return ()
    texts = stored.agg(
        *[
            F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast("double").isNotNull())
            .alias(c)
            for c in extras
        ]
    ).first()
    return tuple(c for c in extras if texts[c])


def key_problems(table: DataFrame) -> DataFrame:
    """One row: unreadable timestamps, missing nodes, rows beyond the first of a key."""
    keys = table.groupBy("node", "timestamp").agg(F.count(F.lit(1)).alias("n"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("bigint")

    return keys.agg(
        total(F.col("timestamp").isNull()).alias("invalid_timestamps"),
        total(F.col("node").isNull()).alias("missing_nodes"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
    )


def check_keys(table: DataFrame) -> None:
    """One job over the two key columns; raises on the first kind of problem."""
    found = key_problems(table).first()
    for count, what in (
        (found.invalid_timestamps, "invalid timestamps"),
        (found.missing_nodes, "missing node ids"),
        (found.duplicate_rows, "duplicate node/timestamp rows"),
    ):
        if count:
            raise ValueError(f"telemetry contains {count} {what}")
