"""History features per node, and the exactly timed future target."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F, types as T

from nodecast.config import DEFAULT_FEATURES, DEFAULT_HORIZON, DEFAULT_STEP, PIECE_STEPS, FeaturePlan
from nodecast.functions.rowwise import is_number
from nodecast.functions.timeline import micros_interval, minute_cycle, step_micros
from nodecast.operators.series import Over, OverTime, add_series_columns, add_time_columns
from nodecast.sources.series_store import BUCKETS, SeriesStore, write_series

META = ("node", "timestamp")


@dataclass(frozen=True)
class FeatureTable:
    """Rows with keys, numeric features and, for training, ``target``.

    ``features`` names the numeric inputs in order.  The node itself is an
    input too, encoded when a model is fitted (models/preprocess.py).
    """

    frame: DataFrame
    features: tuple[str, ...]
    target_column: str | None = None


def lag_columns(signals: Sequence[str], lags: Sequence[int], over: Over | OverTime) -> dict[str, str]:
    return {f"{s}_lag_{k}": over.lag(f"`{s}`", k) for s in signals for k in lags}


def rolling_columns(signals: Sequence[str], sizes: Sequence[int], over: Over | OverTime) -> dict[str, str]:
    """Mean (one value suffices) and sample deviation (two) over recent rows."""
    columns = {}
    for signal in signals:
        for size in sizes:
            columns[f"{signal}_roll_mean_{size}"] = over.mean(signal, size)
            columns[f"{signal}_roll_std_{size}"] = over.deviation(signal, size)
    return columns


def delta_columns(signals: Sequence[str], lags: Sequence[int], over: Over | OverTime) -> dict[str, str]:
    return {
        f"{s}_delta_{k}": f"`{s}` - " + over.lag(f"`{s}`", k) for s in signals for k in lags
    }


def history_columns(plan: FeaturePlan, over: Over | OverTime) -> dict[str, str]:
    return (
        lag_columns(plan.lag_signals, plan.lags, over)
        | rolling_columns(plan.trend_signals, plan.rolling_rows, over)
        | delta_columns(plan.trend_signals, plan.delta_lags, over)
    )


def history_names(plan: FeaturePlan = DEFAULT_FEATURES) -> list[str]:
    """The columns without which a row has too little history."""
    return [f"{c}_lag_{max(plan.lags)}" for c in plan.history_columns]


def window_columns(mode: str) -> Callable:
    """How history is counted: in rows, or in steps of time."""
    if mode not in ("rows", "time"):
        raise ValueError(f"unknown mode {mode!r}, use rows or time")
    return add_series_columns if mode == "rows" else add_time_columns


def engineer_rows(
    table: DataFrame,
    plan: FeaturePlan = DEFAULT_FEATURES,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    mode: str = "rows",
) -> DataFrame:
    """All rows with their lags, rolling statistics, deltas and time of day."""
    rows = window_columns(mode)(
        _numeric_flags(table),
        lambda over: history_columns(plan, over),
        before=plan.reach,
        step=step,
        piece_steps=piece_steps,
    )
    return rows.withColumns(minute_cycle(F.col("timestamp")))


def build_supervised(
    table: DataFrame,
    target_column: str,
    horizon: int = DEFAULT_HORIZON,
    plan: FeaturePlan = DEFAULT_FEATURES,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    mode: str = "rows",
) -> FeatureTable:
    """Rows whose target lies exactly ``horizon`` steps ahead.

    History and target come from one window over each series.  With ``mode``
    "rows" lags and rolling statistics count rows, with "time" steps of time.
    """
    _check_target(table, target_column, horizon)
    rows = window_columns(mode)(
        _numeric_flags(table), _supervised_columns(target_column, horizon, plan), plan.reach, horizon, step, piece_steps
    )
    return _supervised_table(rows, target_column, horizon, plan, step)


def store_supervised(
    table: DataFrame,
    path: str,
    horizon: int = DEFAULT_HORIZON,
    plan: FeaturePlan = DEFAULT_FEATURES,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    buckets: int = BUCKETS,
) -> None:
    """Write a table so that ``supervised_from_store`` needs no exchange, for this
    plan and horizon or any that reach less far."""
    write_series(_numeric_flags(table), path, plan.reach, horizon, step, piece_steps, buckets)


def supervised_from_store(
    store: SeriesStore,
    target_column: str,
    horizon: int = DEFAULT_HORIZON,
    plan: FeaturePlan = DEFAULT_FEATURES,
) -> FeatureTable:
    """``build_supervised`` over a stored table, each bucket by itself."""
    _check_target(store.pieces, target_column, horizon)
    rows = store.add_columns(_supervised_columns(target_column, horizon, plan), plan.reach, horizon)
    return _supervised_table(rows, target_column, horizon, plan, store.step)


def _check_target(table: DataFrame, target_column: str, horizon: int) -> None:
    if horizon < 1:
        raise ValueError("the horizon must be at least one step")
    if target_column not in table.columns:
        raise ValueError(f"there is no target column {target_column}")


def _supervised_columns(target_column: str, horizon: int, plan: FeaturePlan) -> Callable[[Over | OverTime], dict[str, str]]:
    return lambda over: history_columns(plan, over) | future_columns(target_column, horizon, over)


def _supervised_table(
    rows: DataFrame, target_column: str, horizon: int, plan: FeaturePlan, step: str
) -> FeatureTable:
    rows = exactly_ahead(rows, horizon, step).dropna(subset=history_names(plan))
    rows = rows.withColumns(minute_cycle(F.col("timestamp")))
    features = numeric_features(rows, plan)
    frame = rows.select(*META, "target_timestamp", "target", *features)
    return FeatureTable(frame, features, target_column)


def future_columns(target_column: str, horizon: int, over: Over | OverTime) -> dict[str, str]:
    return {
        "target": over.lead(f"double(`{target_column}`)", horizon),
        "target_timestamp": over.lead("timestamp", horizon),
    }


def exactly_ahead(rows: DataFrame, horizon: int, step: str = DEFAULT_STEP) -> DataFrame:
    """Drop rows whose target is missing or, because of a gap, at another time."""
    due = F.col("timestamp") + micros_interval(horizon * step_micros(step))
    return rows.where((F.col("target_timestamp") == due) & F.col("target").isNotNull())


def build_inference_features(
    table: DataFrame,
    plan: FeaturePlan = DEFAULT_FEATURES,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
    mode: str = "rows",
) -> FeatureTable:
    rows = engineer_rows(table, plan, step, piece_steps, mode).dropna(subset=history_names(plan))
    features = numeric_features(rows, plan)
    return FeatureTable(rows.select(*META, *features), features)


def numeric_features(rows: DataFrame, plan: FeaturePlan = DEFAULT_FEATURES) -> tuple[str, ...]:
    """Every numeric column that is not a key, a target or a calendar part."""
    return tuple(
        f.name for f in rows.schema if is_number(f.dataType) and f.name not in plan.non_features
    )


def _numeric_flags(table: DataFrame) -> DataFrame:
    """Extra boolean columns are inputs too, as 0 and 1."""
    flags = [f.name for f in table.schema if isinstance(f.dataType, T.BooleanType)]
    return table.withColumns({c: F.col(c).cast("int").cast("double") for c in flags})


def node_categories(rows: DataFrame) -> list[str]:
    """The distinct nodes in text order: one model input each."""
    return [row.node for row in rows.select("node").distinct().orderBy("node").collect()]


def one_hot_nodes(rows: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One 0/1 column ``node_<id>`` per category; other nodes get only zeros."""
    return rows.select(
        "*", *[(F.col("node") == c).cast("double").alias(f"node_{c}") for c in categories]
    )


def align_feature_columns(
    rows: DataFrame, expected: Sequence[str], keep: Sequence[str] = META
) -> DataFrame:
    """The expected inputs in the expected order, after the ``keep`` columns.

    An absent node column means the node does not occur and is 0; any other
    absent column means the input cannot be scored.
    """
    present = set(rows.columns)
    lacking = [c for c in expected if c not in present and not c.startswith("node_")]
    if lacking:
        raise ValueError(f"the input cannot provide these features: {lacking}")
    inputs = [F.col(c) if c in present else F.lit(0.0).alias(c) for c in expected]
    return rows.select(*keep, *inputs)


def latest_per_node(rows: DataFrame, order: str = "timestamp") -> DataFrame:
    """The last row of each node.

    Spark keeps one row per node in every task before the shuffle (a window
    group limit), so a node with very many rows does not meet in one place.
    """
    newest = Window.partitionBy("node").orderBy(F.desc(order))
    return rows.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age")


def recent_rows(
    table: DataFrame,
    plan: FeaturePlan = DEFAULT_FEATURES,
    step: str = DEFAULT_STEP,
    piece_steps: int = PIECE_STEPS,
) -> DataFrame:
    """Per node, the latest row with full history and the rows it looks back on.

    Finds that row on narrow columns first, so that scoring the latest row of
    every node computes the wide features on a few rows per node only.
    """
    reach = plan.reach

    def columns(over: Over | OverTime) -> dict[str, str]:
        lags = lag_columns(plan.history_columns, [max(plan.lags)], over)
        return lags | {"_oldest": over.recent("first(timestamp)", reach + 1)}

    narrow = table.select(*META, *plan.history_columns)
    usable = add_series_columns(
        narrow, columns, reach, step=step, piece_steps=piece_steps
    ).dropna(subset=history_names(plan))
    spans = usable.groupBy("node").agg(
        F.max("timestamp").alias("_latest"), F.max_by("_oldest", "timestamp").alias("_oldest")
    )
    rows = table.join(spans, "node")
    return rows.where(F.col("timestamp").between(F.col("_oldest"), F.col("_latest"))).select(
        *table.columns
    )
