import csv
import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import reading, telemetry_rows
from nodecast.config import REQUIRED_COLUMNS
from nodecast.operators.quality import quality_report
from nodecast.sources.readings import between, on_nodes, read_readings
from nodecast.sources.sinks import (
    data_dictionary,
    read_report,
    read_report_table,
    with_column_notes,
    write_csv,
    write_parquet,
    write_report,
)
from nodecast.sources.telemetry import key_problems, load_telemetry

METRICS = [("ipmi_pub", "ambient"), ("ipmi_pub", "p0_power"), ("ganglia_pub", "cpu_user")]


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """Three metrics that store the same columns in three ways."""
    root = str(tmp_path_factory.mktemp("archive"))

    def store(frame, plugin, metric):
        frame.write.parquet(f"{root}/plugin={plugin}/metric={metric}")

    text = [
        ("2021-03-03 00:00:00+00:00", "21.5", "7"),  # exactly at the start
        ("2021-03-03 00:00:20+00:00", "22.5", "7"),
        ("not a time", "20", "7"),
        ("2021-03-03 00:00:40+00:00", "not a number", "7"),
        ("2021-03-03 00:00:50+00:00", "NaN", "7"),
        ("2021-03-04 00:00:00+00:00", "23.5", "7"),  # exactly at the end
        ("2021-03-03 00:01:00+00:00", "24.5", None),
    ]
    store(spark.createDataFrame(text, "timestamp string, value string, node string"), *METRICS[0])
    times = spark.createDataFrame(
        [("2021-03-03 00:00:05", 100.25, 7), ("2021-03-03 00:00:45", 101.25, 8)],
        "at string, value double, node int",
    )
    at = F.col("at").cast("timestamp")
    store(times.select(at.alias("timestamp"), F.col("value").cast("float"), "node"), *METRICS[1])
    ntz = F.col("at").cast("timestamp_ntz")
    store(
        times.select(ntz.alias("timestamp"), F.col("value").cast("int"), F.col("node").cast("string")),
        *METRICS[2],
    )
    return root


def test_readings_of_mixed_storage(spark, archive):
    rows = read_readings(spark, archive, METRICS, "2021-03-03T00:00:00Z", "2021-03-04T00:00:00Z")
    got = sorted((r.metric, r.node, r.value) for r in rows.collect())
    assert got == [
        ("ambient", "7", 21.5), ("ambient", "7", 22.5),
        ("cpu_user", "7", 100.0), ("cpu_user", "8", 101.0),
        ("p0_power", "7", 100.25), ("p0_power", "8", 101.25),
    ]
    assert dict(rows.dtypes) == {
        "plugin": "string", "metric": "string", "node": "string",
        "timestamp": "timestamp", "value": "double",
    }
    some = read_readings(spark, archive, METRICS, "2021-03-03", "2021-03-04", ["8"])
    assert {r.node for r in some.collect()} == {"8"} and some.count() == 2


def test_absent_metric(spark, archive):
    with pytest.raises(FileNotFoundError, match="no_such"):
        read_readings(spark, archive, [*METRICS, ("ipmi_pub", "no_such")])


def test_filters_reach_the_files(spark, archive):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    rows = read_readings(spark, archive, METRICS[1:2], "2021-03-03", "2021-03-04", ["8"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    assert "GreaterThanOrEqual(timestamp" in pushed and "LessThan(timestamp" in pushed
    assert "EqualTo(node,8)" in pushed or "In(node" in pushed
    ntz = read_readings(spark, archive, METRICS[2:], "2021-03-03", "2021-03-04", ["8"])
    plan = ntz._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan


def test_long_node_lists_are_joined(spark, archive):
    many = [str(n) for n in range(8, 3000)]
    rows = read_readings(spark, archive, METRICS, nodes=many)
    assert {r.node for r in rows.collect()} == {"8"}
    assert "LeftSemi" in rows._jdf.queryExecution().executedPlan().toString()


def test_node_filter_by_table(spark, archive):
    rows = read_readings(spark, archive, METRICS[1:])
    nodes = spark.createDataFrame([("8",), ("8",), ("9",)], "node string")
    assert on_nodes(rows, nodes).count() == 2
    assert on_nodes(rows, None) is rows
    assert between(rows, None, datetime(2021, 3, 3)).isEmpty()


@pytest.fixture(scope="module")
def csv_rows():
    rows = telemetry_rows()
    return [{**r, "timestamp": r["timestamp"].isoformat(sep=" ")} for r in rows]


def write_file(path, rows, opener=open):
    with opener(path, "wt", newline="") as out:
        writer = csv.DictWriter(out, list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def test_gzip_csv_and_its_quality(spark, tmp_path, csv_rows):
    table = load_telemetry(spark, write_file(tmp_path / "t.csv.gz", csv_rows, gzip.open))
    assert dict(table.dtypes)["node"] == "string" and dict(table.dtypes)["timestamp"] == "timestamp"
    report = quality_report(table)
    assert (report["rows"], report["nodes"], report["unique_timestamps"]) == (80, 2, 40)
    assert report["sampling_gap_seconds"] == {"minimum": 60.0, "median": 60.0, "maximum": 60.0}
    assert report["rows_per_node"] == {"101": 40, "202": 40}
    assert report["timestamp_min"] == "2021-01-01T00:00:00+00:00"
    assert report["columns"] == list(REQUIRED_COLUMNS)
    assert set(report["missing_percent"].values()) == {0.0}
    lowest = report["numeric_ranges"]["cpu_temp_max"]["minimum"]
    assert lowest == pytest.approx(reading("cpu_temp_max", "101", 0))
    assert "node" not in report["numeric_ranges"]


def test_duplicate_rows_are_rejected(spark, tmp_path, csv_rows):
    path = write_file(tmp_path / "t.csv", csv_rows + csv_rows[:1] * 2)
    with pytest.raises(ValueError, match="2 duplicate"):
        load_telemetry(spark, path)


def test_bad_keys_are_rejected(spark, tmp_path, csv_rows):
    late = [{**csv_rows[0], "timestamp": "soon"}, *csv_rows[1:]]
    with pytest.raises(ValueError, match="1 invalid timestamps"):
        load_telemetry(spark, write_file(tmp_path / "a.csv", late))
    nameless = [{**csv_rows[0], "node": ""}, *csv_rows[1:]]
    with pytest.raises(ValueError, match="1 missing node"):
        load_telemetry(spark, write_file(tmp_path / "b.csv", nameless))


def test_missing_columns_files_and_formats(spark, tmp_path, csv_rows):
    short = [{k: v for k, v in r.items() if k not in ("ambient", "p0_power")} for r in csv_rows]
    with pytest.raises(ValueError, match=r"\['ambient', 'p0_power'\]"):
        load_telemetry(spark, write_file(tmp_path / "c.csv", short))
    with pytest.raises(FileNotFoundError):
        load_telemetry(spark, str(tmp_path / "none.parquet"))
    with pytest.raises(ValueError, match="unsupported"):
        load_telemetry(spark, str(tmp_path / "t.xlsx"))


def test_extra_csv_columns(spark, tmp_path, csv_rows):
    extra = [{**r, "fan": 1200 + i, "note": "x"} for i, r in enumerate(csv_rows)]
    table = load_telemetry(spark, write_file(tmp_path / "d.csv", extra))
    assert dict(table.dtypes)["fan"] == "double" and dict(table.dtypes)["note"] == "string"


def test_parquet_round_trip_and_nan(spark, telemetry, tmp_path):
    path = str(tmp_path / "t.parquet")
    nan = telemetry.withColumn(
        "ambient", F.when(F.minute("timestamp") == 3, F.lit(float("nan"))).otherwise(F.col("ambient"))
    )
    write_parquet(with_column_notes(nan), path, sort=("node", "timestamp"))
    table = load_telemetry(spark, path)
    assert table.where("ambient IS NULL").count() == 2
    assert table.where("isnan(ambient)").isEmpty()
    assert spark.read.parquet(path).schema["ambient"].metadata["comment"]
    notes = data_dictionary(table).collect()
    assert [n.column for n in notes] == list(REQUIRED_COLUMNS) and all(n.description for n in notes)


def test_csv_folder_round_trip(spark, telemetry, tmp_path):
    path = str(tmp_path / "t.csv.gz")
    write_csv(telemetry, path, gzip=True, sort=("node", "timestamp"))
    again = load_telemetry(spark, path)
    assert again.exceptAll(telemetry.select(again.columns)).isEmpty() and again.count() == 80


def test_key_problems_counts(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), (None, 1), ("a", None)]
    table = spark.createDataFrame(rows, "node string, at int").select(
        "node", F.timestamp_seconds("at").alias("timestamp")
    )
    assert tuple(key_problems(table).first()) == (1, 1, 2)


def test_reports(spark, tmp_path):
    path = str(tmp_path / "r.json")
    write_report(spark, {"rows": 3, "nested": {"x": [1, 2]}}, path)
    assert read_report(spark, path) == {"rows": 3, "nested": {"x": [1, 2]}}
    assert read_report_table(spark, path).select("nested.x").first().x == [1, 2]
