"""Chronological train / validation / test split by target time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from nodecast.functions.timeline import moment
from nodecast.operators.quantiles import values_at_ranks
from nodecast.session import materialize

TRAIN, VALIDATION, TEST = "train", "validation", "test"


@dataclass(frozen=True)
class ChronologicalSplit:
    """The rows with a ``split`` column, and the two boundary times."""

    frame: DataFrame
    train_end: datetime
    validation_end: datetime

    def part(self, *names: str) -> DataFrame:
        return self.frame.where(F.col("split").isin(*names))


def boundary_positions(
    moments: int, train_ratio: float = 0.70, validation_ratio: float = 0.15
) -> tuple[int, int]:
    """0-based places of the two boundaries among the distinct target times."""
    for name, ratio in (("train_ratio", train_ratio), ("validation_ratio", validation_ratio)):
        if not 0 < ratio < 1:
            raise ValueError(f"{name} must lie between 0 and 1")
    kept = train_ratio + validation_ratio
    if kept >= 1:
        raise ValueError("train_ratio and validation_ratio must leave room for a test part")
    if moments < 3:
        raise ValueError("a split needs at least three distinct target times")
    # fixed formula: results have to agree on how the two places are rounded
    train = max(int(moments * train_ratio) - 1, 0)
    validation = min(max(int(moments * kept) - 1, train + 1), moments - 2)
    if validation <= train:
        raise ValueError("the split leaves a part without rows")
    return train, validation


def split_boundaries(
    rows: DataFrame,
    train_ratio: float = 0.70,
    validation_ratio: float = 0.15,
) -> tuple[datetime, datetime]:
    """Last target time of the train and of the validation part.

    The distinct times are never ranked in one task: the two wanted ranks are
    looked up by operators/quantiles.py.
    """
    times = rows.select(F.unix_micros("target_timestamp").alias("at")).distinct()
    times = materialize(times, "target-times")  # the rows themselves are read once
    total = times.count()
    places = boundary_positions(total, train_ratio, validation_ratio)
    found = values_at_ranks(times, "at", places, total)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    train_end, validation_end = (epoch + timedelta(microseconds=int(at)) for at in found)
    return train_end, validation_end


def label_parts(rows: DataFrame, train_end: datetime, validation_end: datetime) -> DataFrame:
    due = F.col("target_timestamp")
    part = (
        F.when(due <= moment(train_end), TRAIN)
        .when(due <= moment(validation_end), VALIDATION)
        .otherwise(TEST)
    )
    return rows.withColumn("split", part)


def chronological_split(
    rows: DataFrame,
    train_ratio: float = 0.70,
    validation_ratio: float = 0.15,
) -> ChronologicalSplit:
    ends = split_boundaries(rows, train_ratio, validation_ratio)
    return ChronologicalSplit(label_parts(rows, *ends), *ends)


def after_boundary(rows: DataFrame, validation_end: datetime) -> DataFrame:
    """The held-out rows of a split whose boundary was saved earlier."""
    return rows.where(F.col("target_timestamp") > moment(validation_end))


def split_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.max("target_timestamp").alias("target_end")
    )
