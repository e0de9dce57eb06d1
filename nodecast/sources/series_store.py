"""Long series stored in buckets, ready for windows.

A table is written once, cut into pieces of a fixed time span, every piece with
the neighbouring rows that windows over it may reach, and bucketed by node and
piece.  A reader's windows then need no exchange: each bucket has all it takes.
A node with a third of all rows has its pieces in all buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from nodecast.config import DEFAULT_STEP, PIECE_STEPS
from nodecast.functions.rowwise import quoted, quoted_name
from nodecast.operators.series import BORROWED, PIECE, Over, over_pieces, series_pieces
from nodecast.sources.sinks import read_report, write_report

BUCKETS = 64  # one task each; on a cluster choose it so that a bucket is 100 to 200 MB


@dataclass(frozen=True)
class SeriesStore:
    pieces: DataFrame
    before: int
    after: int
    step: str
    key: str
    order: str

    @property
    def table(self) -> DataFrame:
        """The rows as they were before they were cut into pieces."""
        return self.pieces.where(f"NOT {BORROWED}").drop(PIECE, BORROWED)

    def add_columns(self, build: Callable[[Over], dict[str, str]], before: int, after: int = 0) -> DataFrame:
        """``add_series_columns`` without an exchange."""
        if before > self.before or after > self.after:
            raise ValueError(
                f"the stored pieces reach {self.before} rows back and {self.after} ahead, not {before} and {after}"
            )
        return over_pieces(self.pieces, build, self.key, self.order)


def write_series(
    table: DataFrame,
    path: str,
    before: int,
    after: int = 0,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    buckets: int = BUCKETS,
    key: str = "node",
    order: str = "timestamp",
) -> None:
    """Write to a new folder; a folder in use raises.

    Rows are placed by the hash that buckets go by, so a bucket is one file.
    """
    spark = table.sparkSession
    pieces = series_pieces(table, before, after, step, piece_steps, key, order)
    name = _table_name(path)
    writer = pieces.repartition(buckets, key, PIECE).write.format("parquet").option("path", f"{path}/pieces")
    writer.bucketBy(buckets, key, PIECE).sortBy(key, PIECE, order).saveAsTable(name)
    columns = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in pieces.schema)
    facts = {
        "columns": columns, "buckets": buckets, "before": before, "after": after,
        "step": step, "key": key, "order": order,
    }
    write_report(spark, facts, f"{path}/facts")


def read_series(spark: SparkSession, path: str) -> SeriesStore:
    """A stored table, also one that another session has written."""
    facts = read_report(spark, f"{path}/facts")
    columns, buckets, name = facts.pop("columns"), facts.pop("buckets"), _table_name(path)
    keys = f"{quoted_name(facts['key'])}, {PIECE}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
        f"SORTED BY ({keys}, {quoted_name(facts['order'])}) INTO {buckets} BUCKETS LOCATION {quoted(path + '/pieces')}"
    )
    return SeriesStore(spark.table(name), **facts)


def _table_name(path: str) -> str:
    return f"nodecast_series_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
