"""Row-based windows over long series, split so that no task holds a whole one.

``Window.partitionBy("node")`` puts all rows of a node into one task, and one
node may hold a third of the table.  Here a series is cut into pieces of a
fixed time span, and every piece borrows the few rows next to it that its
windows reach: ``before`` rows of history and ``after`` rows of future.  The
borrowed rows are found by counting rows, not minutes, so results equal those
of the window over the whole node, gaps and nearly empty pieces included.

Plan: one exchange of the table on (node, piece), read twice; from it the edge
rows of each piece (a tiny share) are ranked per node and sent to the pieces
that need them.  The union keeps the (node, piece) partitioning, so the final
window adds a sort but no further exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from nodecast.config import DEFAULT_STEP, PIECE_STEPS
from nodecast.functions.rowwise import quoted_name
from nodecast.functions.timeline import floor_to, step_micros

PIECE, BORROWED = "_piece", "_borrowed"
DEVIATION_ROWS = 10  # frames up to this size share the value their differences are taken from


@dataclass(frozen=True)
class Over:
    """Writes SQL for functions over an ordered series.

    Wide feature sets are stated as SQL text: a hundred window columns then
    cost one call to Spark instead of several per column.
    """

    partition: tuple[str, ...]
    order: str

    def __call__(self, function: str, rows: str = "") -> str:
        keys = ", ".join(f"`{c}`" for c in self.partition)
        frame = f" ROWS BETWEEN {rows}" if rows else ""
        return f"{function} OVER (PARTITION BY {keys} ORDER BY `{self.order}`{frame})"

    def recent(self, function: str, count: int) -> str:
        """Over the current row and those before it, ``count`` in all."""
        return self(function, f"{count - 1} PRECEDING AND CURRENT ROW")

    def lag(self, value: str, steps: int) -> str:
        return self(f"lag({value}, {steps})")

    def lead(self, value: str, steps: int) -> str:
        return self(f"lead({value}, {steps})")

    def mean(self, name: str, count: int) -> str:
        """Mean of the values that are there, over the current row and those before it."""
        return self.recent(f"avg({quoted_name(name)})", count)

    def deviation(self, name: str, count: int) -> str:
        """Their sample deviation."""
        return self.recent(f"stddev_samp({quoted_name(name)})", count)


@dataclass(frozen=True)
class OverOffsets(Over):
    """Means and deviations from rows at fixed offsets, without sliding frames.

    A sliding frame adds up all its rows anew for every row.  Here each row behind
    is fetched once, and the sums of all frame sizes are arithmetic within one row.
    ``windows`` gathers what is to be computed over the series, ``staged`` what
    follows from it, each stage from those before it.
    """

    windows: dict[str, str] = field(default_factory=dict)
    staged: tuple[dict[str, str], dict[str, str]] = field(default_factory=lambda: ({}, {}))

    def __call__(self, function: str, rows: str = "") -> str:
        return _named(self.windows, super().__call__(function, rows), "_window_")

    def _values(self, name: str, count: int) -> list[str]:
        """The values of the rows of a frame, the current one first."""
        value = quoted_name(name)
        return [f"double({v})" for v in (value, *(self.lag(value, k) for k in range(1, count)))]

    def mean(self, name: str, count: int) -> str:
        values = self._values(name, count)
        oldest_first = " + ".join(f"coalesce({v}, 0D)" for v in reversed(values))
        return f"({oldest_first}) / nullif({_present(values)}, 0)"

    def deviation(self, name: str, count: int) -> str:
        """From differences to the newest value that is there, which is one of the
        frame's if it has any: equal values give 0, and no large sums cancel out."""
        values = self._values(name, count)
        longest = self._values(name, max(count, DEVIATION_ROWS))
        newest = _named(self.staged[0], f"coalesce({', '.join(longest)})", "_newest_")
        apart = [_named(self.staged[1], f"coalesce({v} - {newest}, 0D)", "_apart_") for v in values]
        n, total = _present(values), " + ".join(apart)
        squares = " + ".join(f"{d} * {d}" for d in apart)
        return f"CASE WHEN {n} > 1 THEN sqrt(({squares} - ({total}) * ({total}) / {n}) / ({n} - 1)) END"


def _named(known: dict[str, str], sql: str, prefix: str) -> str:
    """The name of a helper column, the same for the same SQL."""
    return quoted_name(known.setdefault(sql, f"{prefix}{len(known)}"))


def _present(values: list[str]) -> str:
    return "(" + " + ".join(f"int({v} IS NOT NULL)" for v in values) + ")"


@dataclass(frozen=True)
class OverTime:
    """The same over time instead of rows: steps are spans of time, so a gap gives
    a missing lag and a shorter window, not rows from further back.

    ``at`` is the column of epoch microseconds that the frames are ranges of."""

    partition: tuple[str, ...]
    at: str
    micros: int

    def __call__(self, function: str, span: str) -> str:
        keys = ", ".join(f"`{c}`" for c in self.partition)
        return f"{function} OVER (PARTITION BY {keys} ORDER BY `{self.at}` RANGE BETWEEN {span})"

    def _steps(self, steps: int) -> str:
        return f"{steps * self.micros}L"

    def recent(self, function: str, count: int) -> str:
        """Over the rows of the last ``count`` steps, the current one included."""
        return self(function, f"{self._steps(count - 1)} PRECEDING AND CURRENT ROW")

    def lag(self, value: str, steps: int) -> str:
        """The value exactly so many steps ago."""
        return self(f"first({value})", f"{self._steps(steps)} PRECEDING AND {self._steps(steps)} PRECEDING")

    def lead(self, value: str, steps: int) -> str:
        return self(f"first({value})", f"{self._steps(steps)} FOLLOWING AND {self._steps(steps)} FOLLOWING")

    def mean(self, name: str, count: int) -> str:
        return self.recent(f"avg({quoted_name(name)})", count)

    def deviation(self, name: str, count: int) -> str:
        return self.recent(f"stddev_samp({quoted_name(name)})", count)


def add_series_columns(
    table: DataFrame,
    build: Callable[[Over], dict[str, str]],
    before: int,
    after: int = 0,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    key: str = "node",
    order: str = "timestamp",
) -> DataFrame:
    """Add window columns that look at most ``before`` back and ``after`` ahead.

    ``build`` gets the series to write over and returns SQL by column name.
    """
    return over_pieces(series_pieces(table, before, after, step, piece_steps, key, order), build, key, order)


def over_pieces(
    pieces: DataFrame, build: Callable[[Over], dict[str, str]], key: str = "node", order: str = "timestamp"
) -> DataFrame:
    """Window columns over pieces that have the borrowed rows they need; those are left out."""
    over = OverOffsets((key, PIECE), order)
    columns = build(over)
    kept = [quoted_name(c) for c in pieces.columns if c not in (PIECE, BORROWED)]
    built = pieces.selectExpr("*", *helpers(over.windows)).where(f"NOT {BORROWED}")
    for stage in over.staged:
        if stage:
            built = built.selectExpr("*", *helpers(stage))
    return built.selectExpr(*kept, *named_sql(columns))


def add_time_columns(
    table: DataFrame,
    build: Callable[[OverTime], dict[str, str]],
    before: int,
    after: int = 0,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    key: str = "node",
    order: str = "timestamp",
) -> DataFrame:
    """Add window columns that look at most ``before`` steps back in time and
    ``after`` steps ahead.

    A row lies in its own piece and is borrowed by those that begin within
    ``before`` steps after it or end within ``after`` steps before it.  That
    follows from the row's time alone, so the plan has one exchange.  Rows
    without a time have none before or after them.
    """
    micros = step_micros(step)
    span = micros * piece_steps
    at = F.unix_micros(order)
    piece = lambda moment: F.floor(moment / F.lit(span)).cast("long")
    reached = F.sequence(piece(at - F.lit(after * micros)), piece(at + F.lit(before * micros)))
    own = F.coalesce(piece(at), F.lit(0))
    placed = table.withColumns({"_at": at, "_own": own}).withColumn(PIECE, F.explode(F.coalesce(reached, F.array("_own"))))
    columns = build(OverTime((key, PIECE), "_at", micros))
    names = [f"`{c}`" for c in (*table.columns, *columns)]
    built = placed.selectExpr("*", *named_sql(columns))
    return built.where(f"{PIECE} = _own").selectExpr(*names)


def helpers(found: dict[str, str]) -> list[str]:
    return [f"{sql} AS {quoted_name(name)}" for sql, name in found.items()]


def named_sql(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {quoted_name(name)}" for name, sql in columns.items()]


def series_pieces(
    table: DataFrame,
    before: int,
    after: int,
    step: str,
    piece_steps: int,
    key: str,
    order: str,
) -> DataFrame:
    """The table cut into pieces, each with the borrowed rows it needs."""
    span = step_micros(step) * piece_steps
    window = Window.partitionBy(key, PIECE).orderBy(order)
    own = table.withColumn(PIECE, floor_to(F.col(order), span)).repartition(key, PIECE)

    place, size = F.row_number().over(window), F.count(F.lit(1)).over(Window.partitionBy(key, PIECE))
    edges = (
        own.withColumns({"_place": place, "_size": size})
        .where((F.col("_place") <= after) | (F.col("_place") > F.col("_size") - before))
        .drop("_place", "_size")
    )

    # A later piece needs an edge row if it starts within `before` edge rows
    # after it; an earlier piece if it ends within `after` edge rows before it.
    # Pieces too small to satisfy a window consist of edge rows only, so the
    # count is exact across them.
    along = Window.partitionBy(key).orderBy(order)
    reached = F.array_except(
        F.array_union(
            F.collect_set(PIECE).over(along.rowsBetween(1, before)),
            F.collect_set(PIECE).over(along.rowsBetween(-after, -1))
            if after
            else F.array().cast("array<timestamp>"),
        ),
        F.array(PIECE),
    )
    borrowed = (
        edges.withColumn("_reached", reached)
        .select(
            *table.columns, F.explode("_reached").alias(PIECE), F.lit(True).alias(BORROWED)
        )
        .repartition(key, PIECE)
    )
    return own.withColumn(BORROWED, F.lit(False)).unionByName(borrowed)
