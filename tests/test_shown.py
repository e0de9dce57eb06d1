"""What queries show, and at what cost."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from nodecast.catalog.queries import shown, six_decimals
from nodecast.session import use_utc


def test_six_decimals_equal_round_to_the_last_bit(spark):
    chance = np.random.default_rng(5)
    whole = chance.integers(-(10**10), 10**10, 3000)
    near_ties = [(whole + part) / 1e6 for part in (0.0, 0.4989999, 0.499, 0.5, 0.501)]
    wide = [chance.normal(size=500) * 10.0**power for power in range(-12, 16)]
    odd = [0.0, -0.0, -1e-9, -1e-7, 5e-7, -5e-7, 1e300, float("inf"), float("-inf"), float("nan")]
    values = spark.createDataFrame(pd.DataFrame({"v": np.concatenate([*near_ties, *wide, odd])}))
    both = values.union(spark.sql("SELECT double(NULL)")).selectExpr(
        f"string({six_decimals('v')}) AS plain", "string(round(v, 6)) AS rounded"
    )
    assert both.where(~F.col("plain").eqNullSafe(F.col("rounded"))).isEmpty()


def test_wide_results_stay_in_compiled_code(spark):
    """Seventy shown numbers in one generated method would be left uncompiled."""
    wide = use_utc(spark).range(10).select(*[(F.col("id") * k).cast("double").alias(f"c{k}") for k in range(70)])
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    result = shown(wide.repartition(2))
    assert "round(" in result._jdf.queryExecution().optimizedPlan().toString()  # still there for ties
    assert "rint" in result._jdf.queryExecution().optimizedPlan().toString().lower()
