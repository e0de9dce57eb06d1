"""Rows of gzip CSV are spread over tasks only where there are few files."""

import pytest

from nodecast.sources import telemetry as source
from nodecast.sources.sinks import write_csv


@pytest.mark.parametrize("files, spread", [(2, True), (12, False)])
def test_only_few_files_are_spread(spark, telemetry, tmp_path, monkeypatch, files, spread):
    path = str(tmp_path / "telemetry.csv.gz")
    write_csv(telemetry.repartition(files, "node", "timestamp"), path, gzip=True)
    plans = []
    kept = source.materialize
    monkeypatch.setattr(
        source, "materialize",
        lambda table, name: plans.append(table._jdf.queryExecution().optimizedPlan().toString()) or kept(table, name),
    )
    loaded = source.load_telemetry(spark, path)
    assert ("RepartitionByExpression" in plans[0]) == spread
    assert loaded.select("node", "timestamp", "ambient").exceptAll(telemetry.select("node", "timestamp", "ambient")).isEmpty()
    assert loaded.count() == telemetry.count()
