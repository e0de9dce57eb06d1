"""Helpers for work on texts inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROWS_PER_BATCH = 512
"""Rows handed to a Python worker at once: texts can be long."""


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand few rows at once to Python workers; the default is 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def text_groups(
    batches: Iterator[pa.RecordBatch], characters: int
) -> Iterator[tuple[list, list[str]]]:
    """(keys, texts) of consecutive rows with about so many characters; a null
    text is empty.  A longer text is a group of its own.  The frame has two
    columns: a key and the text."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            if texts and size + len(text) > characters:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(text)
            size += len(text)
    if keys:
        yield keys, texts


def hashed_sample(frame: DataFrame, mark: Column, rows: int, size: int) -> DataFrame:
    """About ``size`` of the ``rows`` rows (never more), those with the smallest
    hash.  Rows beyond a hash that leaves a few spare are dropped where they are
    read, so that not every task offers a whole sample of its own."""
    share = min(1.0, (1.1 * size + 100) / max(rows, 1))
    low = F.pmod(mark, F.lit(1 << 30)) < int(share * (1 << 30))
    kept = frame.withColumn("_mark", mark).where(low if share < 1 else F.lit(True))
    return kept.orderBy(F.pmod("_mark", F.lit(1 << 30)), "_mark").limit(size).drop("_mark")
