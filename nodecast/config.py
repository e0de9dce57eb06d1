"""Fixed values of the telemetry model, and the few knobs of the engine."""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Column names, metric names, lags and tolerances that results
# have to agree on.
# --------------------------------------------------------------------------

CORE_TEMPERATURE_METRICS = (
    "p0_core10_temp",
    "p0_core11_temp",
    "p0_core20_temp",
    "p0_core21_temp",
    "p1_core10_temp",
    "p1_core11_temp",
    "p1_core14_temp",
    "p1_core15_temp",
)

IPMI_METRICS = (
    "ambient",
    "p0_power",
    "p1_power",
    "total_power",
    "p0_vdd_temp",
    "p1_vdd_temp",
)

GANGLIA_METRICS = (
    "cpu_user",
    "cpu_system",
    "cpu_idle",
    "cpu_wio",
    "cpu_speed",
    "load_one",
    "load_five",
    "load_fifteen",
)

COVERAGE_METRICS = (
    ("ipmi_pub", "p0_core20_temp"),
    ("ipmi_pub", "p1_core10_temp"),
    ("ipmi_pub", "total_power"),
    ("ganglia_pub", "cpu_user"),
)

CORE_SUMMARY_COLUMNS = ("cpu_temp_mean", "cpu_temp_max", "cpu_temp_sensor_count")
DERIVED_SUMS = {
    "cpu_busy": ("cpu_user", "cpu_system"),
    "cpu_socket_power": ("p0_power", "p1_power"),
}
CALENDAR_COLUMNS = ("hour_utc", "day_of_week_utc")

LAG_SIGNALS = (
    "cpu_temp_max",
    "cpu_temp_mean",
    "ambient",
    "total_power",
    "cpu_socket_power",
    "p0_power",
    "p1_power",
    "p0_vdd_temp",
    "p1_vdd_temp",
    "cpu_busy",
    "cpu_idle",
    "load_one",
    "load_five",
    "load_fifteen",
)
TREND_SIGNALS = (  # these get rolling statistics and deltas
    "cpu_temp_max",
    "cpu_temp_mean",
    "total_power",
    "cpu_socket_power",
    "cpu_busy",
    "load_one",
)
LAGS = (1, 2, 5, 10)
ROLLING_ROWS = (3, 5, 10)
DELTA_LAGS = (1, 5)
HISTORY_COLUMNS = ("cpu_temp_max", "cpu_temp_mean", "total_power")

# never model inputs
NON_FEATURES = frozenset(
    {"node", "timestamp", "target", "target_timestamp", "hour_utc", "day_of_week_utc"}
)

COLUMN_NOTES = {
    "node": "compute node id, as text",
    "timestamp": "UTC start of the interval the row covers",
    "cpu_temp_mean": "mean over the core temperature sensors that reported",
    "cpu_temp_max": "highest of the core temperature sensors that reported",
    "cpu_temp_sensor_count": "how many core temperature sensors reported",
    "ambient": "air temperature at the node",
    "p0_power": "power of processor socket 0",
    "p1_power": "power of processor socket 1",
    "total_power": "power of the whole node",
    "p0_vdd_temp": "temperature of the power stage of socket 0",
    "p1_vdd_temp": "temperature of the power stage of socket 1",
    "cpu_user": "percent of CPU time in user code",
    "cpu_system": "percent of CPU time in the kernel",
    "cpu_idle": "percent of CPU time idle",
    "cpu_wio": "percent of CPU time waiting for I/O",
    "cpu_speed": "CPU clock as reported, often nominal",
    "load_one": "load average over one minute",
    "load_five": "load average over five minutes",
    "load_fifteen": "load average over fifteen minutes",
    "cpu_busy": "cpu_user plus cpu_system",
    "cpu_socket_power": "p0_power plus p1_power",
    "hour_utc": "hour of day",
    "day_of_week_utc": "day of week, Monday is 0",
}

REQUIRED_COLUMNS = tuple(COLUMN_NOTES)

# --------------------------------------------------------------------------


@dataclass(frozen=True)
class ForecastTask:
    """One signal to forecast and how its errors are judged."""

    key: str
    column: str
    display_name: str
    unit: str
    tolerances: tuple[float, ...]

    def label(self, horizon: int) -> str:
        return f"{self.key}_{horizon}min"


# The tasks, their units and tolerances.
TASKS = {
    task.key: task
    for task in (
        ForecastTask(
            "temperature",
            "cpu_temp_max",
            "maximum CPU-core temperature",
            "degrees Celsius",
            (1.0, 2.0),
        ),
        ForecastTask(
            "power", "total_power", "total node power", "watts", (25.0, 50.0, 100.0)
        ),
    )
}


@dataclass(frozen=True)
class FeaturePlan:
    """Which history features to derive from which signals."""

    lag_signals: tuple[str, ...] = LAG_SIGNALS
    lags: tuple[int, ...] = LAGS
    trend_signals: tuple[str, ...] = TREND_SIGNALS
    rolling_rows: tuple[int, ...] = ROLLING_ROWS
    delta_lags: tuple[int, ...] = DELTA_LAGS
    history_columns: tuple[str, ...] = HISTORY_COLUMNS
    non_features: frozenset[str] = field(default=NON_FEATURES)

    @property
    def reach(self) -> int:
        """Rows of history that the longest feature looks back."""
        return max((*self.lags, *self.delta_lags, *(rows - 1 for rows in self.rolling_rows)))


DEFAULT_FEATURES = FeaturePlan()

# Step, horizon, seed and penalty that results have to agree on.
DEFAULT_STEP = "1 minute"
DEFAULT_HORIZON = 5
DEFAULT_SEED = 42
RIDGE_ALPHA = 100.0

# A series is cut into pieces of at most this many steps, so that one long
# series is worked on by many tasks (operators/series.py).
PIECE_STEPS = 65_536

# Longer lists of nodes are joined instead of being stated in a filter.
NODE_LIST_LIMIT = 1_000


def aligned_metrics() -> dict[str, tuple[str, str]]:
    """Output column -> (plugin, metric) for all metrics that get aligned."""
    ipmi = {name: ("ipmi_pub", name) for name in CORE_TEMPERATURE_METRICS + IPMI_METRICS}
    return ipmi | {name: ("ganglia_pub", name) for name in GANGLIA_METRICS}
