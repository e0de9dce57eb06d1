"""Writing tables and reports."""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from nodecast.config import COLUMN_NOTES


def write_parquet(table: DataFrame, path: str, sort: tuple[str, ...] = ()) -> None:
    """Snappy Parquet.  With ``sort`` the files follow each other in that order
    and are sorted inside, so that readers skip files as well as row groups."""
    if sort:
        table = table.orderBy(*sort)
    table.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_csv(
    table: DataFrame, path: str, gzip: bool = False, sort: tuple[str, ...] = ()
) -> None:
    """A folder of CSV files with a header; timestamps are ISO text in UTC."""
    if sort:
        table = table.orderBy(*sort)
    writer = table.write.mode("overwrite").option("header", True)
    writer = writer.option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]xxx")
    # numbers as text shrink little more at the slower levels
    writer = writer.option("zlib.compress.level", "BEST_SPEED")
    writer.option("compression", "gzip" if gzip else "none").csv(path)


def write_report(spark: SparkSession, report: dict[str, Any], path: str) -> None:
    """A report of bounded size as one JSON document."""
    text = json.dumps(report, indent=2, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> dict[str, Any]:
    try:
        rows = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no report at {path}") from error
        raise
    return json.loads(rows.first().value)


def read_report_table(spark: SparkSession, path: str) -> DataFrame:
    """The same document as a DataFrame of nested columns."""
    return spark.read.option("multiLine", True).json(path)


def with_column_notes(table: DataFrame) -> DataFrame:
    """Attach the data dictionary as column comments, which Parquet keeps."""
    return table.select(
        *[
            F.col(c).alias(c, metadata={"comment": COLUMN_NOTES[c]}) if c in COLUMN_NOTES else F.col(c)
            for c in table.columns
        ]
    )


def data_dictionary(table: DataFrame) -> DataFrame:
    """(column, type, description) of a table, in column order."""
    rows = [
        (place, f.name, f.dataType.simpleString(), COLUMN_NOTES.get(f.name))
        for place, f in enumerate(table.schema)
    ]
    described = table.sparkSession.createDataFrame(
        rows, "place int, column string, type string, description string"
    )
    return described.orderBy("place").drop("place")
