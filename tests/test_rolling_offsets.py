"""Rolling statistics from rows at fixed offsets."""

from datetime import timedelta

import numpy as np
import pytest
from conftest import START
from pyspark.sql import functions as F

from nodecast.operators.features import rolling_columns
from nodecast.operators.series import Over, add_series_columns, named_sql

SIZES = (1, 3, 10, 12)


@pytest.fixture(scope="module")
def holes(spark):
    """Equal values, values far from 0, holes longer than a frame, NaN."""
    chance = np.random.default_rng(2)
    rows = []
    for node, value in (("same", lambda: 0.1), ("far", lambda: 1e6 + chance.normal()), ("near", chance.normal)):
        for m in range(90):
            hole = 20 <= m < 35 or chance.random() < 0.3
            rows.append((node, START + timedelta(minutes=m), None if hole else float(value())))
    rows.append(("near", START + timedelta(minutes=91), float("nan")))
    return spark.createDataFrame(rows, "node string, timestamp timestamp, `v w` double").cache()


def test_equal_to_sliding_frames(holes):
    build = lambda over: rolling_columns(["v w"], SIZES, over)
    found = add_series_columns(holes, build, before=11, piece_steps=16)
    whole = holes.selectExpr("*", *named_sql(build(Over(("node",), "timestamp"))))
    assert found.columns == whole.columns
    rounded = [F.round(c, 7).alias(c) if "roll" in c else F.col(f"`{c}`") for c in whole.columns]
    assert found.count() == holes.count()
    assert found.select(rounded).exceptAll(whole.select(rounded)).isEmpty()
    same = found.where("node = 'same'").agg(F.max("`v w_roll_std_10`")).first()[0]
    assert same == 0.0


def test_no_sliding_frame_in_the_plan(holes):
    found = add_series_columns(holes, lambda over: rolling_columns(["v w"], SIZES, over), before=11)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "stddev_samp" not in plan and "avg(" not in plan and "lag(" in plan
