import math
import random

import pytest
from pyspark.sql import functions as F

from hindcast.operators import metrics
from hindcast.operators.quantiles import exact_percentile


def brute(values, q):
    v = sorted(x for x in values if x is not None and math.isfinite(x))
    if not v:
        return None
    at = q * (len(v) - 1)
    a, b = v[math.floor(at)], v[math.ceil(at)]
    return a + (b - a) * (at - math.floor(at))


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_narrowing_finds_the_exact_percentile(spark, q):
    rng = random.Random(7)
    groups = {
        "even": [rng.random() for _ in range(3000)],
        "far": [rng.random() for _ in range(900)] + [1e300, -1e300, 1.7e308, -1.7e308],
        "two": [0.0] * 700 + [1.0] * 300,
        "one": [5.5] * 800,
        "steps": [10.0**-k for k in range(300)],
        "tiny": [5e-324 * (k % 3) for k in range(500)],
        "few": [3.0, None, 1.0, float("nan"), float("inf")],
        "none": [None, None],
        None: [float(k % 97) for k in range(1000)],
    }
    rows = [(g, x) for g, v in groups.items() for x in v]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    got = {r["g"]: r["p"] for r in exact_percentile(df, ["g"], F.col("x"), q, "p", sorted_rows=40).collect()}
    assert got == {g: pytest.approx(brute(v, q), rel=1e-15) if brute(v, q) is not None else None for g, v in groups.items()}


def test_without_keys_and_rows(spark):
    df = spark.createDataFrame([(float(k),) for k in range(1001)], "x double").repartition(4)
    assert exact_percentile(df, [], F.col("x"), 0.95, "p", sorted_rows=10).collect() == [(950.0,)]
    assert exact_percentile(df.where("x < 0"), [], F.col("x"), 0.95).collect() == []
    with pytest.raises(ValueError, match="not a share"):
        exact_percentile(df, [], F.col("x"), 1.5)
    empty = metrics.summary(spark.createDataFrame([], "abs_error_mw double, actual_mw double, error_mw double"), []).collect()
    assert [r.asDict() for r in empty] == [{"rows": 0, "wape_pct": None, "mae_mw": None, "bias_mw": None, "p95_ape_pct": None}]


def test_no_task_gathers_a_group(spark):
    df = spark.range(5000).select((F.col("id") % 4999).cast("double").alias("x"))
    plan = exact_percentile(df, [], F.col("x"), 0.5, sorted_rows=50)._jdf.queryExecution().toString()
    assert "percentile(" not in plan and "collect_list" not in plan and "collect_set" not in plan


def test_peaks_need_no_sort(spark):
    rows = spark.createDataFrame([("a", 1, 10.0, 5, 1.0), ("a", 1, 10.0, 3, 2.0), ("a", 1, 9.0, 1, 9.0), ("a", 2, None, 7, 4.0), ("b", 1, 0.0, 1, 3.0)], "weather_zone string, operating_date int, actual_mw double, target_ts_utc bigint, abs_error_mw double")
    out = metrics.zone_scores(rows)
    assert "Sort " not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["weather_zone"]: r for r in out.collect()}
    assert got["a"]["peak_hour_abs_error_mw"] == 4.0 and got["a"]["peak_hour_ape_pct"] == 20.0 and got["a"]["rows"] == 4
    assert got["b"]["peak_hour_ape_pct"] is None and got["b"]["wape_pct"] is None
