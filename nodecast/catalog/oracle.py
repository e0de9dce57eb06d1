"""The registered queries stated again in SQL, for an independent check.

The texts are built from the same fixed lists of signals and metrics, but
nothing of the Spark code is used: windows run over whole series, percentiles
and ranks over whole columns.
"""

from __future__ import annotations

from nodecast.catalog.tables import EVENT_METRICS, LINEITEM_METRICS
from nodecast.config import (
    CORE_TEMPERATURE_METRICS,
    COVERAGE_METRICS,
    DELTA_LAGS,
    GANGLIA_METRICS,
    HISTORY_COLUMNS,
    IPMI_METRICS,
    LAG_SIGNALS,
    LAGS,
    REQUIRED_COLUMNS,
    ROLLING_ROWS,
    TREND_SIGNALS,
)

SINGLES = IPMI_METRICS + GANGLIA_METRICS
NUMBERS = tuple(c for c in REQUIRED_COLUMNS if c not in ("node", "timestamp"))
SIGNALS = tuple(c for c in NUMBERS if c not in ("hour_utc", "day_of_week_utc"))
WHOLE = ("hour_utc", "day_of_week_utc")


def near(expression: str, name: str | None = None) -> str:
    """Six decimals, with a nudge off exact ties; both engines show it so."""
    return f"round(CAST({expression} AS DOUBLE) + 1e-9, 6) AS {name or expression}"


def text(expression: str, name: str = "timestamp") -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS \"{name}\""


def listed(items) -> str:
    return ", ".join(items)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- common tables --------------------------------------------------------

EVENTS = """readings AS (
  SELECT 'app' AS plugin, event_type AS metric, CAST(user_id AS VARCHAR) AS node, ts, value
  FROM events)"""

DAILY = f"""daily AS (
  SELECT CAST(user_id AS VARCHAR) AS node, date_trunc('day', ts) AS ts,
    avg(value) AS value_mean, max(value) AS value_max, count(*) AS value_count,
    {listed(f"avg(value) FILTER (WHERE event_type = '{m}') AS {m}" for m in EVENT_METRICS)}
  FROM events GROUP BY 1, 2)"""

# history and target by time: ranges of days instead of numbers of rows
_DAYS = "PARTITION BY node ORDER BY ts RANGE BETWEEN"


def _exact(column: str, days: int, way: str) -> str:
    return f"first_value({column}) OVER ({_DAYS} INTERVAL {days} DAY {way} AND INTERVAL {days} DAY {way})"


def _span(function: str, days: int) -> str:
    return f"{function}(value_mean) OVER ({_DAYS} INTERVAL {days - 1} DAY PRECEDING AND CURRENT ROW)"


_TIME_COLUMNS = {
    **{f"{c}_lag_{k}": _exact(c, k, "PRECEDING") for c in ("value_mean", "value_max") for k in (1, 2, 5)},
    **{f"value_mean_roll_mean_{n}": _span("avg", n) for n in (3, 5)},
    **{f"value_mean_roll_std_{n}": _span("stddev_samp", n) for n in (3, 5)},
    **{f"value_mean_delta_{k}": f"value_mean - {_exact('value_mean', k, 'PRECEDING')}" for k in (1, 5)},
    "target": _exact("value_max", 5, "FOLLOWING"),
}
TIME_NAMES = ["value_mean", "value_max", *_TIME_COLUMNS]
TIMED = f"""timed AS (
  SELECT node, ts, value_mean, value_max, {_exact('ts', 5, 'FOLLOWING')} AS target_ts,
    {listed(f"{sql} AS {name}" for name, sql in _TIME_COLUMNS.items())}
  FROM daily)"""

ALIGNED = f"""aligned AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS node,
    time_bucket(INTERVAL 7 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS ts,
    {listed(f"avg({e}) AS {m}" for m, e in LINEITEM_METRICS.items())}
  FROM lineitem GROUP BY 1, 2)"""

_SUM = " + ".join(f"coalesce({c}, 0.0)" for c in CORE_TEMPERATURE_METRICS)
_COUNT = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in CORE_TEMPERATURE_METRICS)
CORES = f"""cores AS (
  SELECT *, ({_SUM}) / nullif({_COUNT}, 0) AS cpu_temp_mean,
    list_max([{listed(CORE_TEMPERATURE_METRICS)}]) AS cpu_temp_max,
    CAST({_COUNT} AS DOUBLE) AS cpu_temp_sensor_count
  FROM aligned)"""


def _pair(a: str, b: str, name: str) -> str:
    return (
        f"CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL "
        f"ELSE coalesce({a}, 0.0) + coalesce({b}, 0.0) END AS {name}"
    )


WIDE = f"""wide AS (
  SELECT node, ts, cpu_temp_mean, cpu_temp_max, cpu_temp_sensor_count, {listed(SINGLES)},
    {_pair('cpu_user', 'cpu_system', 'cpu_busy')},
    {_pair('p0_power', 'p1_power', 'cpu_socket_power')},
    hour(ts) AS hour_utc, isodow(ts) - 1 AS day_of_week_utc
  FROM cores)"""

TELEMETRY = (ALIGNED, CORES, WIDE)

_WINDOWS = listed(
    ["w AS (PARTITION BY node ORDER BY ts)"]
    + [
        f"w{n} AS (PARTITION BY node ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for n in ROLLING_ROWS
    ]
)
LAG_NAMES = [f"{c}_lag_{k}" for c in LAG_SIGNALS for k in LAGS]
MEAN_NAMES = [f"{c}_roll_mean_{n}" for c in TREND_SIGNALS for n in ROLLING_ROWS]
STD_NAMES = [f"{c}_roll_std_{n}" for c in TREND_SIGNALS for n in ROLLING_ROWS]
DELTA_NAMES = [f"{c}_delta_{k}" for c in TREND_SIGNALS for k in DELTA_LAGS]
HISTORY_NAMES = LAG_NAMES + MEAN_NAMES + STD_NAMES + DELTA_NAMES

_HISTORY = listed(
    [f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for c in LAG_SIGNALS for k in LAGS]
    + [f"avg({c}) OVER w{n} AS {c}_roll_mean_{n}" for c in TREND_SIGNALS for n in ROLLING_ROWS]
    + [
        f"stddev_samp({c}) OVER w{n} AS {c}_roll_std_{n}"
        for c in TREND_SIGNALS
        for n in ROLLING_ROWS
    ]
    + [f"{c} - lag({c}, {k}) OVER w AS {c}_delta_{k}" for c in TREND_SIGNALS for k in DELTA_LAGS]
)


def _rows(target: str) -> str:
    return f"""engineered AS (
  SELECT *, {_HISTORY},
    sin(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440) AS minute_sin,
    cos(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440) AS minute_cos,
    lead({target}, 5) OVER w AS target, lead(ts, 5) OVER w AS target_ts
  FROM wide WINDOW {_WINDOWS}),
usable AS (
  SELECT * FROM engineered
  WHERE {" AND ".join(f"{c}_lag_10 IS NOT NULL" for c in HISTORY_COLUMNS)}),
supervised AS (
  SELECT * FROM usable WHERE target_ts = ts + INTERVAL 35 DAY AND target IS NOT NULL)"""


SPLIT = """times AS (
  SELECT target_ts, row_number() OVER (ORDER BY target_ts) - 1 AS place
  FROM (SELECT DISTINCT target_ts FROM supervised)),
sized AS (SELECT count(*) AS n FROM times),
first_place AS (
  SELECT n, greatest(CAST(floor(n * CAST(0.70 AS DOUBLE)) AS BIGINT) - 1, 0) AS k1 FROM sized),
places AS (
  SELECT k1, least(greatest(
    CAST(floor(n * (CAST(0.70 AS DOUBLE) + CAST(0.15 AS DOUBLE))) AS BIGINT) - 1, k1 + 1), n - 2) AS k2
  FROM first_place),
bounds AS (
  SELECT max(target_ts) FILTER (WHERE place = k1) AS t1,
    max(target_ts) FILTER (WHERE place = k2) AS t2
  FROM times, places),
labelled AS (
  SELECT s.*, CASE WHEN target_ts <= t1 THEN 'train' WHEN target_ts <= t2 THEN 'validation'
    ELSE 'test' END AS split
  FROM supervised s, bounds)"""


def _split_rows(target: str = "cpu_temp_max") -> tuple[str, ...]:
    return (*TELEMETRY, _rows(target), SPLIT)


def _predictions(target: str = "cpu_temp_max") -> tuple[str, ...]:
    return (
        *_split_rows(target),
        f"""predictions AS (
  SELECT node, ts, target_ts, {target}, target AS actual, {target}_roll_mean_3 AS predicted,
    {target} AS persistence, abs(target - {target}_roll_mean_3) AS absolute_error
  FROM labelled WHERE split = 'test')""",
    )


def _figures(actual: str, predicted: str, tolerances: tuple[int, ...]) -> str:
    e, y = f"({actual} - {predicted})", actual
    within = [near(f"avg(CAST(abs({e}) <= {t} AS INT))", f"within_{t}") for t in tolerances]
    return listed(
        [
            "count(*) AS rows",
            near(f"avg(abs({e}))", "mae"),
            near(f"sqrt(avg({e} * {e}))", "rmse"),
            near(
                f"CASE WHEN var_pop({y}) > 0 THEN 1 - sum({e} * {e}) / (var_pop({y}) * count({y})) "
                f"WHEN sum({e} * {e}) = 0 THEN 1 ELSE 0 END",
                "r2",
            ),
            near(f"median(abs({e}))", "median_absolute_error"),
            *within,
        ]
    )


# --- the queries ----------------------------------------------------------


def _reading_queries() -> dict[str, str]:
    coverage = f"""coverage AS (
  SELECT node, {listed(_covered(m) for _, m in COVERAGE_METRICS)}
  FROM readings GROUP BY node),
covered AS (
  SELECT *, least({listed(m for _, m in COVERAGE_METRICS)}) AS minimum_rows,
    {' + '.join(m for _, m in COVERAGE_METRICS)} AS total_rows
  FROM coverage)"""
    machine = "readings AS (\n" + " UNION ALL ".join(
        f"SELECT CAST(l_suppkey AS VARCHAR) AS node, '{m}' AS metric FROM lineitem "
        f"WHERE {LINEITEM_METRICS[m]} IS NOT NULL\n"
        for _, m in COVERAGE_METRICS
    ) + ")"
    columns = listed(["node", *[m for _, m in COVERAGE_METRICS], "minimum_rows", "total_rows"])
    ranked = "ORDER BY minimum_rows DESC, total_rows DESC, node LIMIT 12"
    event_ranked = f"""ranked AS (
  SELECT node, {listed(f"count(*) FILTER (WHERE metric = '{m}') AS {m}" for m in EVENT_METRICS)}
  FROM readings GROUP BY node),
chosen AS (
  SELECT node FROM ranked WHERE least({listed(EVENT_METRICS)}) > 0
  ORDER BY least({listed(EVENT_METRICS)}) DESC, {' + '.join(EVENT_METRICS)} DESC, node LIMIT 12)"""
    daily_metrics = [f"""{m}_daily AS (
  SELECT node, date_trunc('day', ts) AS ts, avg(value) AS {m} FROM readings
  WHERE metric = '{m}' GROUP BY 1, 2)""" for m in EVENT_METRICS]
    joined = f"{EVENT_METRICS[0]}_daily" + "".join(
        f" FULL JOIN {m}_daily USING (node, ts)" for m in EVENT_METRICS[1:]
    )
    prepared = f"""{coverage},
chosen AS (SELECT node FROM covered WHERE minimum_rows > 0 {ranked})"""
    return {
        "time_range_filter": with_(EVENTS)
        + f"""SELECT plugin, metric, node, {text('ts')}, {near('value')} FROM readings
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:00:00'""",
        "archive_readings": with_(EVENTS)
        + f"""SELECT plugin, metric, node, {text('ts')},
  {near("CASE WHEN metric IN ('error', 'signup') THEN CAST(value AS FLOAT) ELSE value END", 'value')}
FROM readings WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-22 12:00:00'
  AND value IS NOT NULL AND node IS NOT NULL""",
        "node_semi_join": with_(EVENTS, event_ranked)
        + f"""SELECT node, metric, count(*) AS rows, {near('avg(value)', 'value_mean')}
FROM readings WHERE node IN (SELECT node FROM chosen) GROUP BY node, metric""",
        "node_counts": with_(EVENTS) + "SELECT node, count(*) AS rows FROM readings GROUP BY node",
        "node_coverage": with_(machine, coverage)
        + f"SELECT {columns} FROM covered WHERE minimum_rows > 0",
        "node_coverage_topn": with_(machine, coverage)
        + f"SELECT {columns} FROM covered WHERE minimum_rows > 0 {ranked}",
        "bucket_mean": with_(EVENTS)
        + f"""SELECT node, {text("date_trunc('hour', ts)")}, {near('avg(value)', 'click_mean')}
FROM readings WHERE metric = 'click' GROUP BY node, date_trunc('hour', ts)""",
        "metric_full_outer_join": with_(EVENTS, *daily_metrics)
        + f"SELECT node, {text('ts')}, {listed(near(m) for m in EVENT_METRICS)} FROM {joined}",
        "metric_conditional_wide": with_(DAILY)
        + f"SELECT node, {text('ts')}, {listed(near(m) for m in EVENT_METRICS)} FROM daily",
        "aligned_machine_metrics": with_(ALIGNED)
        + f"SELECT node, {text('ts')}, {listed(near(m) for m in LINEITEM_METRICS)} FROM aligned",
        "core_temperatures": with_(ALIGNED, CORES)
        + f"""SELECT node, {text('ts')}, {near('cpu_temp_mean')}, {near('cpu_temp_max')},
  {near('cpu_temp_sensor_count')} FROM cores WHERE cpu_temp_max IS NOT NULL""",
        "complete_grid_left_join": with_(
            DAILY,
            """grid AS (
  SELECT node, unnest(days) AS ts FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS node FROM events),
    (SELECT generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY) AS days FROM events))""",
        )
        + f"""SELECT grid.node, {text('grid.ts')}, {listed(near(m) for m in EVENT_METRICS)}
FROM grid LEFT JOIN daily ON grid.node = daily.node AND grid.ts = daily.ts""",
        "derived_sums": with_(*TELEMETRY)
        + f"""SELECT node, {text('ts')}, {listed(near(c) for c in (
            'cpu_user', 'cpu_system', 'cpu_busy', 'p0_power', 'p1_power', 'cpu_socket_power'))}
FROM wide""",
        "prepared_telemetry": with_(machine, prepared, *TELEMETRY)
        + f"""SELECT node, {text('ts')}, {listed(near(c) for c in SIGNALS)},
  {listed(f'CAST({c} AS BIGINT) AS {c}' for c in WHOLE)}
FROM wide WHERE cpu_temp_max IS NOT NULL AND node IN (SELECT node FROM chosen)""",
        "prepared_with_empty_steps": with_(
            machine,
            prepared,
            *TELEMETRY,
            """grid AS (
  SELECT node, unnest(weeks) AS ts FROM chosen, (SELECT generate_series(
    time_bucket(INTERVAL 7 DAY, min(CAST(l_shipdate AS TIMESTAMP)), TIMESTAMP '1970-01-01'),
    max(CAST(l_shipdate AS TIMESTAMP)), INTERVAL 7 DAY) AS weeks FROM lineitem))""",
        )
        + f"""SELECT grid.node, {text('grid.ts')}, {listed(near(c) for c in SIGNALS)},
  CAST(hour(grid.ts) AS BIGINT) AS hour_utc,
  CAST(isodow(grid.ts) - 1 AS BIGINT) AS day_of_week_utc
FROM grid LEFT JOIN wide ON grid.node = wide.node AND grid.ts = wide.ts""",
        "calendar_columns": with_(EVENTS)
        + f"""SELECT node, {text('ts')}, {near('value')}, CAST(hour(ts) AS BIGINT) AS hour_utc,
  CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week_utc FROM readings""",
        "cyclic_minute": with_(EVENTS)
        + f"""SELECT node, {text('ts')}, {near('value')},
  {near('sin(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440)', 'minute_sin')},
  {near('cos(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440)', 'minute_cos')} FROM readings""",
    }


def _covered(metric: str) -> str:
    return f"count(*) FILTER (WHERE metric = '{metric}') AS {metric}"


def _unpivoted(source: str, columns, one: str) -> str:
    return " UNION ALL ".join(one.format(c=c) + f" FROM {source}" for c in columns)


def _quality_queries() -> dict[str, str]:
    iso = "'%Y-%m-%dT%H:%M:%S+00:00'"

    def span(source: str) -> str:
        return f"""count(*) AS rows, count(DISTINCT node) AS nodes,
  strftime(min(ts), {iso}) AS timestamp_min, strftime(max(ts), {iso}) AS timestamp_max FROM {source}"""

    missing = "SELECT '{n}' AS column, " + near(
        "round(100.0 * avg(CAST({c} IS NULL AS INT)), 3)", "missing_percent"
    )
    wide_names = {"timestamp": "ts"}
    all_wide = [(c, wide_names.get(c, c)) for c in REQUIRED_COLUMNS]
    daily_columns = ["node", "timestamp", "value_mean", "value_max", "value_count", *EVENT_METRICS]
    all_daily = [(c, wide_names.get(c, c)) for c in daily_columns]

    def missing_in(source, columns):
        return " UNION ALL ".join(missing.format(n=n, c=c) + f" FROM {source}" for n, c in columns)

    gaps = """gaps AS (
  SELECT node, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY node ORDER BY ts)) AS us
  FROM {source})"""
    shipments = """shipments AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS node, l_shipdate AS ts FROM lineitem),
keys AS (SELECT node, ts, count(*) AS n FROM shipments GROUP BY node, ts)"""
    return {
        "quality_overview": with_(*TELEMETRY)
        + f"""SELECT count(DISTINCT ts) AS unique_timestamps,
  count(*) - count(DISTINCT (node, ts)) AS duplicates_node_timestamp, {span('wide')}""",
        "quality_by_period": with_(*TELEMETRY)
        + f"""SELECT count(DISTINCT ts) AS unique_timestamps, true AS nodes_within_bound,
  count(*) - count(DISTINCT (node, ts)) AS duplicates_node_timestamp, {span('wide')}""",
        "periods_of_quality": with_(*TELEMETRY)
        + f"""SELECT {text('make_timestamp(us - us % 2419200000000)', 'period')}, count(*) AS rows,
  count(DISTINCT ts) AS unique_timestamps, {text('min(ts)', 'first')}, {text('max(ts)', 'last')},
  count(*) - count(DISTINCT (node, ts)) AS duplicates
FROM (SELECT *, epoch_us(ts) AS us FROM wide) GROUP BY us - us % 2419200000000""",
        "dataset_head": with_(DAILY) + f"SELECT {span('daily')}",
        "rows_per_node": with_(*TELEMETRY) + "SELECT node, count(*) AS rows FROM wide GROUP BY node",
        "sampling_gap": with_(*TELEMETRY, gaps.format(source="wide"))
        + f"""SELECT {near('min(us) / 1e6', 'minimum')}, {near('median(us) / 1e6', 'median')},
  {near('max(us) / 1e6', 'maximum')} FROM gaps""",
        "sampling_gaps": with_(EVENTS, gaps.format(source="readings"))
        + f"SELECT node, {text('ts')}, {near('us / 1e6', 'gap_seconds')} FROM gaps WHERE us IS NOT NULL",
        "missing_percent": with_(*TELEMETRY) + missing_in("wide", all_wide),
        "columns_with_gaps": with_(DAILY)
        + f"SELECT * FROM ({missing_in('daily', all_daily)}) WHERE missing_percent > 0",
        "numeric_ranges": with_(*TELEMETRY)
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column, {near(f'min({c})', 'minimum')}, "
            f"{near(f'max({c})', 'maximum')}, {near(f'avg({c})', 'mean')} FROM wide"
            for c in NUMBERS
        ),
        "column_profile": with_(DAILY)
        + " UNION ALL ".join(
            missing.format(n=n, c=c)
            + "".join(
                ", "
                + near(f"{f}({c})" if c not in ("node", "ts") else "NULL", name)
                for f, name in (("min", "minimum"), ("max", "maximum"), ("avg", "mean"))
            )
            + " FROM daily"
            for n, c in all_daily
        ),
        "node_ranges": with_(*TELEMETRY)
        + f"""SELECT node, count(*) AS rows,
  {near('round(avg(cpu_temp_max), 2)', 'temperature_mean')},
  {near('round(min(cpu_temp_max), 2)', 'temperature_min')},
  {near('round(max(cpu_temp_max), 2)', 'temperature_max')},
  {near('round(avg(total_power), 2)', 'power_mean')},
  {near('round(max(total_power), 2)', 'power_max')}
FROM wide GROUP BY node""",
        "duplicate_keys": with_(shipments) + f"SELECT node, {text('ts')}, n FROM keys WHERE n > 1",
        "key_check": with_(shipments)
        + """SELECT count(*) FILTER (WHERE ts IS NULL) AS invalid_timestamps,
  count(*) FILTER (WHERE node IS NULL) AS missing_nodes,
  count(*) - (SELECT count(*) FROM keys) AS duplicate_rows FROM shipments""",
    }


def _feature_queries() -> dict[str, str]:
    temperature = (*TELEMETRY, _rows("cpu_temp_max"))
    every = listed(
        near(c) for c in [*SIGNALS, *HISTORY_NAMES, "minute_sin", "minute_cos"]
    )
    whole_table = with_(*TELEMETRY) + f"""SELECT node, {text('ts')}, {listed(near(c) for c in SIGNALS)},
  {listed(f'CAST({c} AS BIGINT) AS {c}' for c in WHOLE)} FROM wide"""

    def named(names, signals=()):
        return f"SELECT node, {text('ts')}, {listed(near(c) for c in [*signals, *names])} FROM engineered"

    lag_10 = [f"{c}_lag_10" for c in HISTORY_COLUMNS]
    return {
        "lag_features": with_(*temperature) + named(LAG_NAMES, LAG_SIGNALS),
        "rolling_mean": with_(*temperature) + named(MEAN_NAMES),
        "rolling_std": with_(*temperature) + named(STD_NAMES),
        "delta_features": with_(*temperature) + named(DELTA_NAMES, TREND_SIGNALS),
        "supervised_target": with_(
            DAILY,
            """ahead AS (
  SELECT node, ts, value_max, lead(value_max, 5) OVER w AS target, lead(ts, 5) OVER w AS target_ts
  FROM daily WINDOW w AS (PARTITION BY node ORDER BY ts))""",
        )
        + f"""SELECT node, {text('ts')}, {near('value_max')}, {near('target')},
  {text('target_ts', 'target_timestamp')}
FROM ahead WHERE target_ts = ts + INTERVAL 5 DAY AND target IS NOT NULL""",
        "time_window_features": with_(DAILY, TIMED)
        + f"""SELECT node, {text('ts')}, {text('target_ts', 'target_timestamp')}, {listed(near(c) for c in TIME_NAMES)} FROM timed""",
        "time_window_supervised": with_(DAILY, TIMED)
        + f"""SELECT node, {text('ts')}, {text('target_ts', 'target_timestamp')}, {near('target')},
  {near('value_max_lag_5')}, {near('value_mean_roll_mean_5')}
FROM timed WHERE target IS NOT NULL AND value_max_lag_5 IS NOT NULL""",
        "history_filter": with_(*temperature)
        + f"SELECT node, {text('ts')}, {listed(near(c) for c in lag_10)} FROM usable",
        "supervised_full": with_(*temperature)
        + f"""SELECT node, {text('ts')}, {text('target_ts', 'target_timestamp')},
  {near('target')}, {every} FROM supervised""",
        "stored_series_supervised": with_(*temperature)
        + f"""SELECT node, {text('ts')}, {text('target_ts', 'target_timestamp')},
  {near('target')}, {every} FROM supervised""",
        "supervised_power": with_(*TELEMETRY, _rows("total_power"))
        + f"""SELECT node, {text('ts')}, {text('target_ts', 'target_timestamp')},
  {near('total_power')}, {near('target')} FROM supervised""",
        "inference_rows": with_(*temperature) + f"SELECT node, {text('ts')}, {every} FROM usable",
        "latest_per_node": with_(*temperature, LATEST)
        + f"SELECT node, {text('ts')}, {every} FROM newest",
        "forecast_rows": with_(*temperature, LATEST)
        + f"""SELECT node, {text('ts')}, {text('ts + INTERVAL 35 DAY', 'forecast_timestamp')},
  {near('cpu_temp_max', 'predicted_cpu_temp_max')}, 'degrees Celsius' AS unit FROM newest""",
        "telemetry_parquet": whole_table,
        "telemetry_csv": whole_table,
        "one_hot_nodes": with_(*TELEMETRY, "nodes AS (SELECT DISTINCT node FROM wide)")
        + f"""SELECT node, row_number() OVER (ORDER BY node) - 1 AS slot, count(*) OVER () AS width,
  {near('1.0', 'ones')} FROM nodes""",
    }


def _split_queries() -> dict[str, str]:
    medians = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {near(f'median({c})', 'median')} FROM labelled "
        f"WHERE split = 'train' HAVING count({c}) > 0"
        for c in SIGNALS
    )
    cells = {
        "true_negative": "NOT real AND NOT said",
        "false_positive": "NOT real AND said",
        "false_negative": "real AND NOT said",
        "true_positive": "real AND said",
    }
    return {
        "split_boundaries": with_(*_split_rows())
        + f"SELECT {text('t1', 'train_end')}, {text('t2', 'validation_end')} FROM bounds",
        "split_counts": with_(*_split_rows())
        + f"""SELECT split, count(*) AS rows, {text('max(target_ts)', 'target_end')}
FROM labelled GROUP BY split""",
        "train_part_medians": with_(*_split_rows()) + medians,
        "train_input_medians": with_(*_split_rows())
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {near(f'median({c})', 'median')} FROM labelled "
            f"WHERE split = 'train' HAVING count({c}) > 0"
            for c in [*SIGNALS, *HISTORY_NAMES, "minute_sin", "minute_cos"]
        ),
        "persistence_metrics": with_(*_split_rows())
        + f"""SELECT split, {_figures('target', 'cpu_temp_max', (1, 2))}
FROM labelled GROUP BY split""",
        "persistence_metrics_by_node": with_(*TELEMETRY, _rows("total_power"))
        + f"""SELECT node, {_figures('target', 'total_power', (25, 50, 100))}
FROM supervised GROUP BY node""",
        "test_predictions": with_(*_predictions())
        + f"""SELECT node, {text('ts')}, {text('target_ts', 'target_timestamp')}, {listed(near(c) for c in (
            'cpu_temp_max', 'actual', 'predicted', 'persistence', 'absolute_error'))}
FROM predictions""",
        "event_proxy": with_(
            *_predictions(),
            """limits AS (
  SELECT quantile_cont(target, 0.9) AS threshold FROM labelled WHERE split <> 'test'),
judged AS (
  SELECT threshold, actual >= threshold AS real, predicted >= threshold AS said
  FROM predictions, limits),
cells AS (
  SELECT max(threshold) AS threshold, count(*) AS n, """
            + listed(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in cells.items())
            + " FROM judged)",
        )
        + f"""SELECT {near('threshold')}, {listed(cells)},
  {near('coalesce(true_positive / nullif(true_positive + false_positive, 0), 0)', 'precision')},
  {near('coalesce(true_positive / nullif(true_positive + false_negative, 0), 0)', 'recall')},
  {near('coalesce(2 * true_positive / nullif(2 * true_positive + false_positive + false_negative, 0), 0)', 'f1')},
  {near('(true_positive + true_negative) / n', 'accuracy')},
  true_positive + false_negative AS positive_rows FROM cells""",
        "ridge_two_signals": with_(*_split_rows(), RIDGE)
        + f"""SELECT 'cpu_temp_max' AS feature, {near('round(w1, 4)', 'weight')} FROM solved
UNION ALL SELECT 'cpu_temp_max_roll_mean_10', {near('round(w2, 4)', 'weight')} FROM solved
UNION ALL SELECT 'intercept', {near('round(my - w1 * m1 / s1 - w2 * m2 / s2, 4)', 'weight')} FROM solved""",
        "ridge_two_signals_forecast": with_(*_split_rows(), RIDGE)
        + f"""SELECT node, {text('target_ts', 'target_timestamp')}, {near('target', 'actual')},
  {near('round(my + w1 * (cpu_temp_max - m1) / s1 + w2 * (cpu_temp_max_roll_mean_10 - m2) / s2, 4)', 'predicted')}
FROM labelled, solved WHERE split = 'test'""",
        "saved_ridge_latest": with_(*_split_rows(), RIDGE, LATEST)
        + f"""SELECT node, {text('ts')}, {text('ts + INTERVAL 35 DAY', 'forecast_timestamp')},
  {near('round(my + w1 * (cpu_temp_max - m1) / s1 + w2 * (cpu_temp_max_roll_mean_10 - m2) / s2, 4)', 'predicted_cpu_temp_max')},
  'degrees Celsius' AS unit FROM newest, solved""",
        "node_ridge_effects": with_(*_split_rows(), RIDGE, NODE_RIDGE)
        + f"SELECT node, k AS rows, {near('round(effect, 4)', 'effect')} FROM effects",
        "node_ridge_forecast": with_(*_split_rows(), RIDGE, NODE_RIDGE)
        + f"""SELECT node, {text('target_ts', 'target_timestamp')}, {near('target', 'actual')},
  {near("""round(my + b0 + v1 * (cpu_temp_max - m1) / s1 + v2 * (cpu_temp_max_roll_mean_10 - m2) / s2
    + coalesce(effect, 0), 4)""", 'predicted')}
FROM labelled CROSS JOIN weights CROSS JOIN moments LEFT JOIN effects USING (node) WHERE split = 'test'""",
        "representative_node": with_(*_predictions(), REPRESENTATIVE)
        + f"SELECT node, {near('variance')} FROM chosen",
        "representative_series": with_(*_predictions(), REPRESENTATIVE)
        + f"""SELECT node, {text('target_ts')}, {near('actual')}, {near('predicted')}
FROM predictions WHERE node IN (SELECT node FROM chosen)""",
        "residual_histogram": with_(
            *_predictions(),
            """residuals AS (SELECT actual - predicted AS e FROM predictions),
edges AS (SELECT min(e) AS lo, max(e) AS hi FROM residuals),
placed AS (
  SELECT least(CAST(floor(35.0::DOUBLE * (e - lo) / (hi - lo)) AS BIGINT) + 1, 35) AS bin
  FROM residuals, edges),
counted AS (SELECT bin, count(*) AS rows FROM placed GROUP BY bin)""",
        )
        + f"""SELECT b.bin, {near('lo + (b.bin - 1) * ((hi - lo) / 35)', 'bin_start')},
  {near('lo + b.bin * ((hi - lo) / 35)', 'bin_end')}, coalesce(c.rows, 0) AS rows
FROM range(1, 36) AS b(bin) CROSS JOIN edges LEFT JOIN counted c ON c.bin = b.bin""",
    }


LATEST = """newest AS (
  SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY node ORDER BY ts DESC) = 1)"""

# least squares with penalty 100 on two inputs in population deviations: a 2 x 2 system
RIDGE = """moments AS (
  SELECT count(*) AS n, avg(cpu_temp_max) AS m1, avg(cpu_temp_max_roll_mean_10) AS m2, avg(target) AS my,
    stddev_pop(cpu_temp_max) AS s1, stddev_pop(cpu_temp_max_roll_mean_10) AS s2,
    corr(cpu_temp_max, cpu_temp_max_roll_mean_10) AS r,
    covar_pop(cpu_temp_max, target) / stddev_pop(cpu_temp_max) AS c1,
    covar_pop(cpu_temp_max_roll_mean_10, target) / stddev_pop(cpu_temp_max_roll_mean_10) AS c2
  FROM labelled WHERE split <> 'test'),
solved AS (
  SELECT *, ((n + 100) * n * c1 - n * r * n * c2) / ((n + 100) * (n + 100) - n * r * n * r) AS w1,
    ((n + 100) * n * c2 - n * r * n * c1) / ((n + 100) * (n + 100) - n * r * n * r) AS w2
  FROM moments)"""

# the same with one more input a node: each is eliminated by its own sums, a 3 x 3
# system of the intercept and the two signals is left, solved by Cramer's rule
NODE_RIDGE = """node_sums AS (
  SELECT node, count(*) AS k, sum((cpu_temp_max - m1) / s1) AS t1,
    sum((cpu_temp_max_roll_mean_10 - m2) / s2) AS t2, sum(target - my) AS ty,
    k + 100 * (k / any_value(n)) * (1 - k / any_value(n)) AS d
  FROM labelled, moments WHERE split <> 'test' GROUP BY node),
left_over AS (
  SELECT any_value(n) - sum(k * k / d) AS a00, -sum(k * t1 / d) AS a01, -sum(k * t2 / d) AS a02,
    any_value(n) + 100 - sum(t1 * t1 / d) AS a11, any_value(n * r) - sum(t1 * t2 / d) AS a12,
    any_value(n) + 100 - sum(t2 * t2 / d) AS a22, -sum(k * ty / d) AS r0,
    any_value(n * c1) - sum(t1 * ty / d) AS r1, any_value(n * c2) - sum(t2 * ty / d) AS r2
  FROM node_sums, moments),
determinant AS (
  SELECT *, a00 * (a11 * a22 - a12 * a12) - a01 * (a01 * a22 - a12 * a02) + a02 * (a01 * a12 - a11 * a02) AS det
  FROM left_over),
weights AS (
  SELECT (r0 * (a11 * a22 - a12 * a12) - a01 * (r1 * a22 - a12 * r2) + a02 * (r1 * a12 - a11 * r2)) / det AS b0,
    (a00 * (r1 * a22 - a12 * r2) - r0 * (a01 * a22 - a12 * a02) + a02 * (a01 * r2 - r1 * a02)) / det AS v1,
    (a00 * (a11 * r2 - r1 * a12) - a01 * (a01 * r2 - r1 * a02) + r0 * (a01 * a12 - a11 * a02)) / det AS v2
  FROM determinant),
effects AS (SELECT node, k, (ty - k * b0 - t1 * v1 - t2 * v2) / d AS effect FROM node_sums, weights)"""

REPRESENTATIVE = """chosen AS (
  SELECT node, var_samp(actual) AS variance FROM predictions GROUP BY node
  ORDER BY variance DESC NULLS LAST, node LIMIT 1)"""


def _comparison() -> tuple[str, ...]:
    """The rows of both tasks, each with its own copy of the common tables."""
    parts = []
    for task, target, used in (
        ("temperature", "cpu_temp_max", (1, 2)),
        ("power", "total_power", (25, 50, 100)),
    ):
        forecasters = {"persistence": target} | {
            f"mean_{n}": f"{target}_roll_mean_{n}" for n in ROLLING_ROWS
        }
        long = " UNION ALL ".join(
            f"SELECT split, '{m}' AS model, target, {c} AS predicted FROM labelled WHERE split <> 'train'"
            for m, c in forecasters.items()
        )
        unused = [
            f"CAST(NULL AS DOUBLE) AS within_{t}" for t in (1, 2, 25, 50, 100) if t not in used
        ]
        parts.append(
            f"{task}_rows AS ({with_(*_split_rows(target))} "
            f"SELECT split AS partition, model, {_figures('target', 'predicted', used)}, "
            f"{listed(unused)}, '{task}' AS task FROM ({long}) GROUP BY split, model)"
        )
    return (
        *parts,
        "comparison AS (SELECT * FROM temperature_rows UNION ALL BY NAME SELECT * FROM power_rows)",
        """selected AS (
  SELECT task, arg_min(model, (rmse, CASE model WHEN 'mean_3' THEN 1 WHEN 'mean_5' THEN 2 ELSE 3 END))
    AS selected_model, min(rmse) AS validation_rmse
  FROM comparison WHERE partition = 'validation' AND model <> 'persistence' GROUP BY task)""",
    )


def _comparison_queries() -> dict[str, str]:
    rounded = ("mae", "rmse", "r2", "persistence_rmse")
    reduction = "100 * (persistence_rmse - rmse) / persistence_rmse"
    return {
        "comparison_union": with_(*_comparison()) + "SELECT * FROM comparison",
        "best_model": with_(*_comparison())
        + f"SELECT task, selected_model, {near('validation_rmse')} FROM selected",
        "rmse_reduction": with_(
            *_comparison(),
            """joined AS (
  SELECT c.task, s.selected_model, c.mae, c.rmse, c.r2, p.rmse AS persistence_rmse
  FROM comparison c JOIN selected s ON c.task = s.task AND c.model = s.selected_model
  JOIN comparison p ON p.task = c.task AND p.partition = 'test' AND p.model = 'persistence'
  WHERE c.partition = 'test')""",
        )
        + f"""SELECT task, selected_model, {listed(near(f'round({c}, 3)', c) for c in rounded)},
  {near(f'round({reduction}, 3)', 'rmse_reduction_percent')} FROM joined""",
    }


def oracle_sql() -> dict[str, str]:
    """SQL for every query whose answer SQL can state; fitted models have none."""
    return (
        _reading_queries()
        | _quality_queries()
        | _feature_queries()
        | _split_queries()
        | _comparison_queries()
    )
