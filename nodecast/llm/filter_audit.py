"""Filter interaction audit by exact constrained least squares.

A filter chain removes a document at the first filter it fails, so what a filter
removes depends on those before it.  All of that follows from one table: how
many documents each of the 2^n coalitions of filters removes.  Documents become
a bit mask of the filters they fail; the masks are counted by part, summed to
coalitions (``coalitions``), and

* a step's numbers are differences of two coalitions (``steps``);
* a filter's Shapley value is the solution of the kernel-weighted least squares
  fit of a sum of single-filter effects to the coalition table, with the fit of
  the full coalition held exact.  The normal equations are solved once, in
  rationals, for all tables at the same time (``shapley_weights``); the result
  is a whole number of removals summed over all orders.

The filters (``failures``) look at whole texts, a null text is empty; words are
stretches without ASCII white space, case-sensitive.  Filter E fails for a text
that a smaller id has too.  A row without an id has no smaller one and is smaller
than none: it passes E.  Rows that repeat id and text pass or fail E alike.  A
label counts if any row of the labels says so for the id; documents without an
id have no label.  A null part is the empty string.  An empty table has no parts,
so no rows.  Other columns are not read.

Copies of one text are joined to their first id by (digest, id), never by the
digest alone, and counted by (id, part) before, so that neither a text with a
third of the rows nor a repeated row fills one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from nodecast.llm.tasks import small_batches
from nodecast.session import materialize

FILTERS = "ABCDE"
FEWEST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 50, 65, 5
COPY = 1 << FILTERS.index("E")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ODD = re.compile(rb"[#$%&*|]")
MEASURES = ("n", "good", "toxic")


def own_failures(text: bytes, n_chars: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # bytes: ASCII white space only
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < FEWEST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITALS_PERCENT * n_chars) << 2
        | (ODD.search(text) is not None) << 3
    )


def failures(documents: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``id, part, mask, n``: how many rows of an id and part fail the same filters."""
    small_batches(documents.sparkSession)
    narrow = documents.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2):
                own = value.as_py()
                raw = own.encode("utf-8")
                masks.append(own_failures(raw, len(own)))
                digests.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                ["id", "part", "mask", "digest"],
            )

    marked = narrow.mapInArrow(run, "id long, part string, mask int, digest binary")
    rows = marked.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    rows = materialize(rows, "failures")
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id"), F.lit(True).alias("first"))
    found = rows.join(firsts, ["digest", "id"], "left")
    copied = F.col("id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(copied, COPY).otherwise(0)
    return found.select("id", "part", mask.alias("mask"), "n")


def labelled(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows with ``good`` and ``toxic``: their ``n`` if the id has that label, else 0."""
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
        (F.max("quality") == 1).alias("is_good"), (F.max("toxic") == 1).alias("is_toxic")
    )
    counted = lambda c: F.when(F.col(c), F.col("n")).otherwise(F.lit(0)).cast("long")
    return rows.join(marks, "id", "left").withColumns({"good": counted("is_good"), "toxic": counted("is_toxic")})


def coalitions(rows: DataFrame, n_filters: int = len(FILTERS)) -> DataFrame:
    """``part`` and, for each measure, an array over all coalitions (as bit
    masks) of how much of it the coalition removes.  One row a part."""
    masks = range(1 << n_filters)
    counted = rows.groupBy("part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES])
    removed = lambda m, s: F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(m))), F.lit(0))
    tables = [F.array(*[removed(m, s).cast("long") for s in masks]).alias(m) for m in MEASURES]
    return counted.groupBy("part").agg(F.sum("n").alias("rows"), *tables)


def shapley_weights(n: int) -> list[list[int]]:
    """For each of ``n`` filters, the weight of each coalition's removals in the
    filter's removals summed over all ``n!`` orders.

    The effects x minimise the sum over coalitions S, neither empty nor full, of
    k(S) (v(S) - sum of x over S)^2, where k(S) = (n - 1) / (C(n, s) s (n - s)),
    under the condition that all effects add up to v(full) - v(empty).  With the
    multiplier of the condition these are n + 1 linear equations whose right
    sides are linear in v; elimination in rationals solves them for every v.
    """
    if n == 1:
        return [[-1, 1]]
    full = (1 << n) - 1
    kernel = {s: Fraction(n - 1, comb(n, s) * s * (n - s)) for s in range(1, n)}
    matrix = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (full + 1) for _ in range(n + 1)]
    for coalition in range(1, full):
        members = [i for i in range(n) if coalition >> i & 1]
        weight = kernel[len(members)]
        for i in members:
            for j in members:
                matrix[i][j] += weight
            right[i][coalition] += weight  # v is taken less v(empty)
            right[i][0] -= weight
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n][full], right[n][0] = Fraction(1), Fraction(-1)
    solved = solve(matrix, right)[:n]
    scaled = [[factorial(n) * x for x in row] for row in solved]
    if any(x.denominator != 1 for row in scaled for x in row):
        raise ArithmeticError("a sum over orders must be whole")
    return [[int(x) for x in row] for row in scaled]


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix`` X = ``right`` by elimination."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    size = len(rows)
    for column in range(size):
        pivot = next(r for r in range(column, size) if rows[r][column])
        rows[column], rows[pivot] = rows[pivot], rows[column]
        head = rows[column][column]
        rows[column] = [x / head for x in rows[column]]
        for r in range(size):
            factor = rows[r][column]
            if r != column and factor:
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[column])]
    return [row[size:] for row in rows]


def weighted(table: Column, weights: Sequence[int]) -> Column:
    terms = [F.get(table, F.lit(s)) * w for s, w in enumerate(weights) if w]
    return sum(terms[1:], terms[0])


def orders(filters: str) -> list[dict]:
    """Every step of every order, with the coalitions (bit masks) its numbers compare."""
    full = (1 << len(filters)) - 1
    found = []
    for order in permutations(filters):
        before = 0
        for step, name in enumerate(order, start=1):
            at = filters.index(name)
            own = 1 << at
            found.append(
                {"filter_order": "".join(order), "step": step, "at": at, "before": before,
                 "after": before | own, "own": own, "others": full ^ own}
            )
            before |= own
    return found


def steps(tables: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of all filters and step of that order."""
    shapley = [weighted(F.col("n"), weights) for weights in shapley_weights(len(filters))]
    # a constant of n * n! steps, whatever the data
    plan = F.from_json(
        F.lit(json.dumps(orders(filters))),
        "array<struct<filter_order: string, step: int, at: int, before: int, after: int, own: int, others: int>>",
    )
    wide = tables.withColumn("_shapley", F.array(*shapley)).withColumn("_step", F.explode(plan))
    value = lambda m, c: F.get(F.col(m), F.col(f"_step.{c}"))
    gone = lambda m: value(m, "after") - value(m, "before")
    return wide.select(
        "part",
        "_step.filter_order",
        "_step.step",
        (F.col("rows") - value("n", "after")).alias("kept"),
        gone("n").alias("removed"),
        (value("n", "own") - gone("n")).alias("redundant"),
        (F.get("n", F.lit((1 << len(filters)) - 1)) - value("n", "others")).alias("unique_fails"),
        gone("good").alias("good_lost"),
        gone("toxic").alias("toxic_lost"),
        value("_shapley", "at").alias("shapley"),
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The steps of all orders of the five filters, by source."""
    tables = coalitions(labelled(failures(documents), labels))
    return steps(materialize(tables, "coalitions"))
