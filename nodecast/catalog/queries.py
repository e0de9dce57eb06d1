"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nodecast.catalog import tables
from nodecast.catalog.tables import EVENT_METRICS, EVENT_STEP, WEEK
from nodecast.config import (
    DEFAULT_FEATURES,
    DEFAULT_HORIZON,
    LAG_SIGNALS,
    ROLLING_ROWS,
    TASKS,
    TREND_SIGNALS,
    FeaturePlan,
)
from nodecast.functions.timeline import calendar_parts, floor_moment, minute_cycle, step_micros
from nodecast.models.artifact import ModelFacts, artifact_path, load_model, save_model
from nodecast.models.candidates import (
    LABEL,
    candidate_models,
    fit_candidate,
    fit_learner,
    label_facts,
)
from nodecast.models.importance import feature_importance
from nodecast.models.node_ridge import fit_node_ridge, load_node_ridge
from nodecast.models.preprocess import (
    VECTOR,
    assembled,
    fit_preprocessor,
    node_encoder,
    train_medians,
)
from nodecast.operators import (
    align,
    compare,
    coverage,
    features,
    metrics,
    period_quality,
    quality,
    split,
)
from nodecast.operators.series import add_series_columns, add_time_columns
from nodecast.plans.predict import forecast_output, forecasts
from nodecast.plans.prepare import wide_table
from nodecast.plans.train import select_and_test
from nodecast.session import materialize, scratch_path, use_utc
from nodecast.sources.readings import between, on_nodes, read_readings
from nodecast.sources.series_store import read_series
from nodecast.sources.sinks import with_column_notes, write_csv, write_parquet
from nodecast.sources.telemetry import key_problems, load_telemetry

# the features that the queries on baseline forecasts need
FEW_FEATURES = FeaturePlan(
    lag_signals=DEFAULT_FEATURES.history_columns,
    lags=(10,),
    trend_signals=(TASKS["temperature"].column, TASKS["power"].column),
    delta_lags=(),
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TEMPERATURE = TASKS["temperature"]
POWER = TASKS["power"]
KEYS = ("node", "timestamp")
PERIOD = "28 days"
BASELINES = ("persistence", "mean_3", "mean_5", "mean_10")


def whole_period(readings: DataFrame) -> tuple[datetime, datetime]:
    """The first moment of the readings, and the one after the last."""
    at = F.unix_micros("timestamp")
    first, last = readings.agg(F.min(at), F.max(at)).first()
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return epoch + timedelta(microseconds=first), epoch + timedelta(microseconds=last + 1)


def query(build: Query) -> Query:
    """Register a query; results are shown with plain column types."""
    QUERIES[build.__name__] = lambda spark, folder: shown(build(use_utc(spark), folder))
    return build


def shown(result: DataFrame) -> DataFrame:
    """Times as text, whole numbers as BIGINT, and six decimals of the rest."""
    forms = {
        T.TimestampType: "date_format(`{0}`, 'yyyy-MM-dd HH:mm:ss') AS `{0}`",
        T.IntegralType: "bigint(`{0}`) AS `{0}`",
        T.FractionalType: f"{six_decimals('(double(`{0}`) + 1e-9D)')} AS `{{0}}`",
    }

    def form(field: T.StructField) -> str:
        fits = [sql for kind, sql in forms.items() if isinstance(field.dataType, kind)]
        return (fits[0] if fits else "`{0}`").format(field.name)

    return result.selectExpr(*map(form, result.schema))


def six_decimals(number: str) -> str:
    """``round(number, 6)`` of a DOUBLE, as SQL, to the same last bit.

    Spark's ``round`` goes through decimal text, which costs more than the windows
    of a wide result.  A millionth part that is not near a tie is found by plain
    arithmetic: the nearest whole number of millionths, divided once.  Ties,
    large, missing and infinite numbers are left to ``round``.
    """
    millionths = f"({number} * 1e6D)"
    plain = f"abs({millionths}) < 1e12D AND abs({millionths} - rint({millionths})) < 0.499D"
    return f"CASE WHEN {plain} THEN rint({millionths}) / 1e6D + 0D ELSE round({number}, 6) END"


# --- readings -------------------------------------------------------------


@query
def time_range_filter(spark, folder):
    return between(tables.event_readings(spark, folder), "2024-01-08", "2024-01-22T12:00:00Z")


@query
def archive_readings(spark, folder):
    """The readings written as an archive of folders, and a range of time read from it."""
    root = scratch_path(spark, "archive")
    tables.write_archive(tables.event_readings(spark, folder), root)
    return read_readings(
        spark, root, [("app", m) for m in EVENT_METRICS], "2024-01-08", "2024-01-22T12:00:00Z"
    )


@query
def node_semi_join(spark, folder):
    readings = tables.event_readings(spark, folder)
    covered = coverage.coverage_table(readings, [("app", m) for m in EVENT_METRICS])
    chosen = on_nodes(readings, coverage.best_covered(covered, 12))
    return chosen.groupBy("node", "metric").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("value").alias("value_mean")
    )


@query
def node_counts(spark, folder):
    return coverage.count_rows_by_node(tables.event_readings(spark, folder))


@query
def node_coverage(spark, folder):
    return coverage.coverage_table(tables.lineitem_readings(spark, folder))


@query
def node_coverage_topn(spark, folder):
    return coverage.best_covered(
        coverage.coverage_table(tables.lineitem_readings(spark, folder)), 12
    )


@query
def bucket_mean(spark, folder):
    return align.aggregate_metric(
        tables.event_readings(spark, folder), "app", "click", "click_mean", step="1h"
    )


@query
def metric_full_outer_join(spark, folder):
    readings = tables.event_readings(spark, folder)
    return align.merge_metric_frames(
        [align.aggregate_metric(readings, "app", m, step=EVENT_STEP) for m in EVENT_METRICS]
    )


@query
def metric_conditional_wide(spark, folder):
    readings = tables.event_readings(spark, folder)
    return align.align_metrics(readings, {m: ("app", m) for m in EVENT_METRICS}, EVENT_STEP)


@query
def aligned_machine_metrics(spark, folder):
    return align.align_metrics(tables.lineitem_readings(spark, folder), step=WEEK)


@query
def core_temperatures(spark, folder):
    return align.build_core_temperature_features(
        tables.lineitem_readings(spark, folder), step=WEEK
    )


@query
def complete_grid_left_join(spark, folder):
    readings = tables.event_readings(spark, folder)
    daily = align.align_metrics(readings, {m: ("app", m) for m in EVENT_METRICS}, EVENT_STEP)
    nodes = readings.select("node").distinct()
    start, end = whole_period(readings)
    first = floor_moment(start, step_micros(EVENT_STEP))
    return align.add_complete_time_grid(daily, nodes, first, end, EVENT_STEP)


@query
def derived_sums(spark, folder):
    wide = tables.telemetry(spark, folder)
    return wide.select(
        "node", "timestamp", "cpu_user", "cpu_system", "cpu_busy", "p0_power", "p1_power",
        "cpu_socket_power",
    )


@query
def prepared_telemetry(spark, folder):
    readings = tables.lineitem_readings(spark, folder)
    chosen = coverage.best_covered(coverage.coverage_table(readings), 12).select("node")
    start, end = whole_period(readings)
    return wide_table(on_nodes(readings, chosen), start, end, WEEK)


@query
def prepared_with_empty_steps(spark, folder):
    """The same with a row for every week, also those without readings."""
    readings = tables.lineitem_readings(spark, folder)
    chosen = coverage.best_covered(coverage.coverage_table(readings), 12).select("node")
    start, end = whole_period(readings)
    return wide_table(on_nodes(readings, chosen), start, end, WEEK, chosen)


@query
def calendar_columns(spark, folder):
    readings = tables.event_readings(spark, folder)
    return readings.select("node", "timestamp", "value").withColumns(
        calendar_parts(F.col("timestamp"))
    )


@query
def cyclic_minute(spark, folder):
    readings = tables.event_readings(spark, folder)
    return readings.select("node", "timestamp", "value").withColumns(
        minute_cycle(F.col("timestamp"))
    )


# --- quality --------------------------------------------------------------


@query
def quality_overview(spark, folder):
    return quality.quality_overview(tables.telemetry(spark, folder))


@query
def quality_by_period(spark, folder):
    """The overview from stored periods: all but the nodes exact, those within the bound."""
    path = scratch_path(spark, "periods")
    wide = tables.telemetry(spark, folder)
    period_quality.store_periods(wide, path, PERIOD)
    found = period_quality.overview(spark, path)
    nodes, bound = wide.agg(F.count_distinct("node")).scalar(), F.lit(period_quality.relative_error())
    within = F.abs(F.col("nodes") - nodes) <= F.ceil(bound * nodes)
    return found.withColumn("nodes_within_bound", within).withColumn("nodes", nodes)


@query
def periods_of_quality(spark, folder):
    """What is stored of each period, the sketch aside."""
    rows = period_quality.period_rows(tables.telemetry(spark, folder), PERIOD)
    return rows.select("period", "rows", "unique_timestamps", "first", "last", "duplicates")


@query
def dataset_head(spark, folder):
    return quality.dataset_head(tables.event_telemetry(spark, folder))


@query
def rows_per_node(spark, folder):
    return quality.rows_per_node(tables.telemetry(spark, folder))


@query
def sampling_gap(spark, folder):
    return quality.sampling_gap_summary(tables.telemetry(spark, folder), WEEK)


@query
def sampling_gaps(spark, folder):
    return quality.sampling_gaps(tables.event_readings(spark, folder), EVENT_STEP)


@query
def missing_percent(spark, folder):
    return quality.missing_percent(tables.telemetry(spark, folder))


@query
def columns_with_gaps(spark, folder):
    return quality.columns_with_gaps(tables.event_telemetry(spark, folder))


@query
def numeric_ranges(spark, folder):
    return quality.numeric_ranges(tables.telemetry(spark, folder))


@query
def column_profile(spark, folder):
    return quality.column_profile(tables.event_telemetry(spark, folder))


@query
def node_ranges(spark, folder):
    return quality.node_ranges(tables.telemetry(spark, folder))


@query
def duplicate_keys(spark, folder):
    return quality.duplicate_keys(_shipments(spark, folder))


@query
def key_check(spark, folder):
    return key_problems(_shipments(spark, folder))


def _shipments(spark, folder):
    return tables.table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("node"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )


# --- features -------------------------------------------------------------


@query
def lag_features(spark, folder):
    return add_series_columns(
        tables.telemetry(spark, folder).select("node", "timestamp", *LAG_SIGNALS),
        lambda w: features.lag_columns(LAG_SIGNALS, DEFAULT_FEATURES.lags, w),
        before=10, step=WEEK,
    )


def _rolling(spark, folder, kind):
    frame = add_series_columns(
        tables.telemetry(spark, folder).select("node", "timestamp", *TREND_SIGNALS),
        lambda w: features.rolling_columns(TREND_SIGNALS, ROLLING_ROWS, w),
        before=9, step=WEEK,
    )
    return frame.select("node", "timestamp", *[c for c in frame.columns if kind in c])


@query
def rolling_mean(spark, folder):
    return _rolling(spark, folder, "_roll_mean_")


@query
def rolling_std(spark, folder):
    return _rolling(spark, folder, "_roll_std_")


@query
def delta_features(spark, folder):
    return add_series_columns(
        tables.telemetry(spark, folder).select("node", "timestamp", *TREND_SIGNALS),
        lambda w: features.delta_columns(TREND_SIGNALS, DEFAULT_FEATURES.delta_lags, w),
        before=5, step=WEEK,
    )


@query
def supervised_target(spark, folder):
    """The exactly timed target on the daily event table, gaps and all."""
    daily = tables.event_telemetry(spark, folder).select("node", "timestamp", "value_max")
    rows = add_series_columns(
        daily,
        lambda w: features.future_columns("value_max", DEFAULT_HORIZON, w),
        before=0, after=DEFAULT_HORIZON, step=EVENT_STEP, piece_steps=7,
    )
    return features.exactly_ahead(rows, DEFAULT_HORIZON, EVENT_STEP)


TIME_PLAN = FeaturePlan(
    lag_signals=("value_mean", "value_max"), lags=(1, 2, 5), trend_signals=("value_mean",), rolling_rows=(3, 5),
    delta_lags=(1, 5), history_columns=("value_max",),
)


@query
def time_window_features(spark, folder):
    """History by time on the daily event table: a gap gives a missing lag and a
    shorter window, and the target is the value exactly five days on."""
    daily = tables.event_telemetry(spark, folder).select("node", "timestamp", "value_mean", "value_max")
    return add_time_columns(
        daily,
        lambda w: features.history_columns(TIME_PLAN, w) | features.future_columns("value_max", DEFAULT_HORIZON, w),
        before=TIME_PLAN.reach, after=DEFAULT_HORIZON, step=EVENT_STEP, piece_steps=7,
    )


@query
def time_window_supervised(spark, folder):
    """Rows with a value exactly five days before and after them."""
    daily = tables.event_telemetry(spark, folder).select("node", "timestamp", "value_mean", "value_max")
    data = features.build_supervised(daily, "value_max", DEFAULT_HORIZON, TIME_PLAN, EVENT_STEP, 7, mode="time")
    return data.frame.select("node", "timestamp", "target_timestamp", "target", "value_max_lag_5", "value_mean_roll_mean_5")


@query
def history_filter(spark, folder):
    wide = tables.telemetry(spark, folder)
    names = features.history_names()
    rows = add_series_columns(
        wide.select("node", "timestamp", *DEFAULT_FEATURES.history_columns),
        lambda w: features.lag_columns(DEFAULT_FEATURES.history_columns, [10], w),
        before=10, step=WEEK, piece_steps=26,
    )
    return rows.dropna(subset=names).select("node", "timestamp", *names)


def supervised(spark, folder, task=TEMPERATURE, plan=DEFAULT_FEATURES):
    wide = tables.telemetry(spark, folder)
    return features.build_supervised(wide, task.column, DEFAULT_HORIZON, plan, WEEK)


@query
def supervised_full(spark, folder):
    return supervised(spark, folder).frame


@query
def stored_series_supervised(spark, folder):
    """The same from a table bucketed by node and piece, without an exchange."""
    path = scratch_path(spark, "series")
    features.store_supervised(tables.telemetry(spark, folder), path, step=WEEK)
    return features.supervised_from_store(read_series(spark, path), TEMPERATURE.column).frame


@query
def supervised_power(spark, folder):
    frame = supervised(spark, folder, POWER, FEW_FEATURES).frame
    return frame.select("node", "timestamp", "target_timestamp", POWER.column, "target")


@query
def inference_rows(spark, folder):
    return features.build_inference_features(tables.telemetry(spark, folder), step=WEEK).frame


@query
def latest_per_node(spark, folder):
    recent = features.recent_rows(tables.telemetry(spark, folder), step=WEEK)
    return features.latest_per_node(features.build_inference_features(recent, step=WEEK).frame)


@query
def forecast_rows(spark, folder):
    recent = features.recent_rows(tables.telemetry(spark, folder), step=WEEK)
    usable = features.build_inference_features(recent, FEW_FEATURES, WEEK)
    rows = features.latest_per_node(usable.frame)
    return forecast_output(
        rows, TEMPERATURE.column, TEMPERATURE.column, DEFAULT_HORIZON, WEEK, TEMPERATURE.unit
    )


@query
def telemetry_parquet(spark, folder):
    """The wide table written in order with its column notes, and loaded again."""
    path = scratch_path(spark, "telemetry.parquet")
    write_parquet(with_column_notes(tables.telemetry(spark, folder)), path, sort=KEYS)
    return load_telemetry(spark, path)


@query
def telemetry_csv(spark, folder):
    """The same through gzip CSV."""
    path = scratch_path(spark, "telemetry.csv.gz")
    write_csv(tables.telemetry(spark, folder), path, gzip=True, sort=KEYS)
    return load_telemetry(spark, path)


@query
def one_hot_nodes(spark, folder):
    """The slot of each node in the one-hot vector, and the vector's size.

    The vector stays sparse: its only slot is read as a number."""
    rows = tables.telemetry(spark, folder).select("node").distinct()
    nodes = features.node_categories(rows)
    encoded = PipelineModel(node_encoder(rows, nodes)).transform(rows)
    return encoded.select(
        "node",
        F.col("_node_index").cast("bigint").alias("slot"),
        F.lit(len(nodes)).cast("bigint").alias("width"),
        F.when(F.col("_node_index") < len(nodes), 1.0).otherwise(0.0).alias("ones"),
    )


# --- split and metrics ----------------------------------------------------


def _narrow(spark, folder, task=TEMPERATURE):
    """Supervised rows with the few columns that the metrics need, written once."""
    data = supervised(spark, folder, task, FEW_FEATURES)
    means = [f"{task.column}_roll_mean_{n}" for n in ROLLING_ROWS]
    rows = data.frame.select(
        "node", "timestamp", "target_timestamp", "target", task.column, *means
    )
    return materialize(rows, f"{task.key}-narrow")


def _parts(spark, folder, task=TEMPERATURE):
    return split.chronological_split(_narrow(spark, folder, task))


@query
def split_boundaries(spark, folder):
    ends = split.split_boundaries(_narrow(spark, folder))
    seconds = [int(end.timestamp()) for end in ends]
    return spark.range(1).select(
        *[F.timestamp_seconds(F.lit(s)).alias(n) for n, s in zip(("train_end", "validation_end"), seconds)]
    )


@query
def split_counts(spark, folder):
    return split.split_counts(_parts(spark, folder).frame)


@query
def train_part_medians(spark, folder):
    """Medians of the signals over the train part only."""
    wide = tables.telemetry(spark, folder)
    signals = features.numeric_features(wide)
    rows = supervised(spark, folder, plan=FEW_FEATURES).frame.select(
        "node", "target_timestamp", *signals
    )
    parts = split.chronological_split(materialize(rows, "signals"))
    return train_medians(parts.part(split.TRAIN), signals)


@query
def train_input_medians(spark, folder):
    """The same of every numeric input, the derived ones too."""
    data, parts = _split_features(spark, folder)
    return train_medians(parts.part(split.TRAIN), data.features)


@query
def persistence_metrics(spark, folder):
    rows = _parts(spark, folder).frame
    return metrics.regression_metrics(
        rows, "target", TEMPERATURE.column, TEMPERATURE.tolerances, ["split"],
    )


@query
def persistence_metrics_by_node(spark, folder):
    rows = supervised(spark, folder, POWER, FEW_FEATURES).frame
    return metrics.regression_metrics(
        rows, "target", POWER.column, POWER.tolerances, ["node"],
    )


def _predictions(spark, folder, task=TEMPERATURE):
    """Test rows with the three-row mean in the place of a forecast."""
    parts = _parts(spark, folder, task)
    test = parts.part(split.TEST)
    return parts, metrics.prediction_table(test, task.column, f"{task.column}_roll_mean_3")


@query
def test_predictions(spark, folder):
    return _predictions(spark, folder)[1]


@query
def event_proxy(spark, folder):
    parts, predictions = _predictions(spark, folder)
    known = parts.part(split.TRAIN, split.VALIDATION)
    threshold = metrics.event_threshold(known)
    result = metrics.event_proxy_metrics(predictions, threshold)
    cells = {
        name: F.get(F.get("confusion_matrix", F.lit(real)), F.lit(said))
        for name, real, said in (
            ("true_negative", 0, 0), ("false_positive", 0, 1),
            ("false_negative", 1, 0), ("true_positive", 1, 1),
        )
    }
    return result.withColumns(cells).drop("confusion_matrix")


@query
def representative_node(spark, folder):
    return metrics.representative_node(_predictions(spark, folder)[1])


@query
def representative_series(spark, folder):
    predictions = materialize(_predictions(spark, folder)[1], "predictions")
    chosen = metrics.representative_node(predictions).first()
    return metrics.node_series(predictions, chosen.node)


@query
def residual_histogram(spark, folder):
    return metrics.residual_histogram(_predictions(spark, folder)[1])


# --- comparing forecasters ------------------------------------------------


def _comparison(spark, folder):
    """Persistence and recent means as forecasters, both tasks."""
    parts = []
    for task in TASKS.values():
        rows = _parts(spark, folder, task).frame.where("split <> 'train'")
        columns = [task.column, *[f"{task.column}_roll_mean_{n}" for n in ROLLING_ROWS]]
        entries = F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("model"), F.col(c).alias("predicted"))
                    for name, c in zip(BASELINES, columns)
                ]
            )
        )
        long = rows.select("target", F.col("split").alias("partition"), entries)
        figures = metrics.regression_metrics(
            long, "target", "predicted", task.tolerances, ["partition", "model"]
        )
        parts.append(figures.withColumn("task", F.lit(task.key)))
    return compare.comparison_table(parts)


@query
def comparison_union(spark, folder):
    return _comparison(spark, folder)


@query
def best_model(spark, folder):
    return compare.best_models(_comparison(spark, folder), BASELINES[1:])


@query
def rmse_reduction(spark, folder):
    table = materialize(_comparison(spark, folder), "comparison")
    return compare.rmse_reduction(table, compare.best_models(table, BASELINES[1:]))


# --- models ---------------------------------------------------------------


def _split_features(spark, folder, task=TEMPERATURE):
    data = supervised(spark, folder, task)
    return data, split.chronological_split(materialize(data.frame, f"{task.key}-features"))


def _ridge(spark, folder):
    data, parts = _split_features(spark, folder)
    known = parts.part(split.TRAIN, split.VALIDATION)
    nodes = features.node_categories(parts.frame)
    before = fit_preprocessor(known, data.features, nodes)
    return parts, known, before, fit_candidate(candidate_models()[0], known, before)


def _two_signal_ridge(spark, folder):
    """Ridge on the current value and the ten-row mean, a closed form in SQL.

    The model is saved and loaded before it is used."""
    inputs = [TEMPERATURE.column, f"{TEMPERATURE.column}_roll_mean_10"]
    parts = _parts(spark, folder)
    assemble = VectorAssembler(inputCols=inputs, outputCol=VECTOR)
    vectors = assemble.transform(parts.part(split.TRAIN, split.VALIDATION))
    fitted = fit_learner(candidate_models()[0], vectors, label_facts(vectors, len(inputs)))
    path = scratch_path(spark, "two-signal-ridge")
    PipelineModel([assemble, *fitted]).write().save(path)
    return parts, vectors, inputs, PipelineModel.load(path)


@query
def ridge_two_signals(spark, folder):
    """The weight of each input per population deviation, and the intercept."""
    _, vectors, inputs, model = _two_signal_ridge(spark, folder)
    weights = feature_importance(model, inputs, vectors).select("feature", F.round("importance", 4).alias("weight"))
    start = [("intercept", float(model.stages[-1].intercept))]
    intercept = spark.createDataFrame(start, "feature string, weight double")
    return weights.unionAll(intercept.select("feature", F.round("weight", 4).alias("weight")))


@query
def ridge_two_signals_forecast(spark, folder):
    parts, _, _, model = _two_signal_ridge(spark, folder)
    table = metrics.prediction_table(model.transform(parts.part(split.TEST)), TEMPERATURE.column)
    return table.select("node", "target_timestamp", "actual", F.round("predicted", 4).alias("predicted"))


@query
def saved_ridge_latest(spark, folder):
    """The same model saved as the training job saves it, loaded, and applied to
    the latest row of every node."""
    parts, _, inputs, model = _two_signal_ridge(spark, folder)
    path = artifact_path(scratch_path(spark, "models"), TEMPERATURE.key, DEFAULT_HORIZON)
    facts = ModelFacts(
        task=TEMPERATURE.key,
        target_column=TEMPERATURE.column,
        display_name=TEMPERATURE.display_name,
        unit=TEMPERATURE.unit,
        horizon=DEFAULT_HORIZON,
        step=WEEK,
        selected_model=candidate_models()[0].name,
        selected_parameters=candidate_models()[0].parameters,
        selection_metric="validation_rmse",
        train_target_end=parts.train_end.isoformat(),
        validation_target_end=parts.validation_end.isoformat(),
        high_temperature_threshold=None,
        numeric_features=inputs,
        nodes=[],
        medians={},
        dropped_features=[],
        spark_version=spark.version,
    )
    save_model(spark, path, model, facts)
    found = forecasts(tables.telemetry(spark, folder), *load_model(spark, path))
    predicted = f"predicted_{TEMPERATURE.column}"
    return found.withColumn(predicted, F.round(predicted, 4))


def _node_ridge(spark, folder):
    """Ridge on two signals and an effect for every node, saved and loaded."""
    parts = _parts(spark, folder)
    inputs = [TEMPERATURE.column, f"{TEMPERATURE.column}_roll_mean_10"]
    path = scratch_path(spark, "node-ridge")
    fit_node_ridge(parts.part(split.TRAIN, split.VALIDATION), inputs).save(path)
    return parts, load_node_ridge(spark, path)


@query
def node_ridge_effects(spark, folder):
    """The effect of every node, none of them a model input."""
    _, model = _node_ridge(spark, folder)
    return model.effects.select("node", "rows", F.round("effect", 4).alias("effect"))


@query
def node_ridge_forecast(spark, folder):
    parts, model = _node_ridge(spark, folder)
    table = metrics.prediction_table(model.transform(parts.part(split.TEST)), TEMPERATURE.column)
    return table.select("node", "target_timestamp", "actual", F.round("predicted", 4).alias("predicted"))


@query
def ridge_forecast(spark, folder):
    parts, _, _, model = _ridge(spark, folder)
    return metrics.prediction_table(model.transform(parts.part(split.TEST)), TEMPERATURE.column)


@query
def importance_of_features(spark, folder):
    _, known, before, model = _ridge(spark, folder)
    return feature_importance(model, before.slots, assembled(known, before, LABEL))


@query
def model_comparison(spark, folder):
    """All five candidates in their published sizes: selection, refit and test."""
    data, parts = _split_features(spark, folder)
    return select_and_test(data, parts, TEMPERATURE).comparison


@query
def model_comparison_power(spark, folder):
    """The same for the other task."""
    data, parts = _split_features(spark, folder, POWER)
    return select_and_test(data, parts, POWER).comparison
