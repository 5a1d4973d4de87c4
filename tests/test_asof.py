from datetime import date, datetime, timedelta

import pytest

from hindcast.operators.asof import Params, evaluation_dataset, latest_eligible, latest_hindsight
from hindcast.schemas import EVALUATION_COLUMNS

DAY = date(2026, 9, 22)
TARGET = datetime(2026, 9, 22, 16)  # hour ending 12
CUTOFF = TARGET - timedelta(hours=24)
F_SCHEMA = "publication_ts_utc timestamp, target_ts_utc timestamp, operating_date date, hour_ending int, dst_flag string, weather_zone string, model string, is_ercot_model_in_use boolean, forecast_mw double"
A_SCHEMA = "publication_ts_utc timestamp, target_ts_utc timestamp, operating_date date, hour_ending int, dst_flag string, weather_zone string, actual_mw double"


def forecast(pub, mw, model="E", used=True, target=TARGET, he=12):
    return (pub, target, DAY, he, "N", "COAST", model, used, mw)


def actual(pub, mw, target=TARGET, day=DAY, he=12, flag="N", zone="COAST"):
    return (pub, target, day, he, flag, zone, mw)


TRUTH = [actual(datetime(2026, 9, 23, 10, 50), 1000.0), actual(datetime(2026, 9, 16, 10, 50), 990.0, TARGET - timedelta(days=7), DAY - timedelta(days=7))]
PARAMS = Params(datetime(2026, 9, 22, 5), datetime(2026, 9, 23, 5), datetime(2026, 9, 24, 5))


def rows(spark, forecasts, actuals=TRUTH, params=PARAMS):
    out = evaluation_dataset(spark.createDataFrame(forecasts, F_SCHEMA), spark.createDataFrame(actuals, A_SCHEMA), params)
    assert out.columns == list(EVALUATION_COLUMNS)
    return out.orderBy("target_ts_utc", "weather_zone").collect()


@pytest.mark.parametrize(
    ("forecasts", "mw", "count", "age"),
    [
        ([forecast(CUTOFF, 1111.0)], 1111.0, 1, 0.0),
        ([forecast(CUTOFF + timedelta(seconds=1), 1111.0)], None, 0, None),
        ([forecast(CUTOFF - timedelta(hours=h), mw) for h, mw in ((72, 970.0), (48, 980.0), (1, 990.0))], 990.0, 1, 1.0),
        ([forecast(CUTOFF - timedelta(hours=2), 900.0), forecast(CUTOFF + timedelta(hours=20), 1000.0)], 900.0, 1, 2.0),
        ([forecast(CUTOFF, 1.0, "A3", False), forecast(CUTOFF, 2.0)], 2.0, 1, 0.0),
        ([forecast(CUTOFF, 1111.0), forecast(CUTOFF, 2222.0)], 1111.0, 2, 0.0),
        ([forecast(CUTOFF, 1111.0)] * 3, 1111.0, 1, 0.0),
        ([], None, 0, None),
    ],
)
def test_forecast_at_cutoff(spark, forecasts, mw, count, age):
    (r,) = rows(spark, forecasts)
    assert (r["ercot_forecast_mw"], r["ercot_value_count"], r["ercot_vintage_age_hours"]) == (mw, count, age)
    assert (r["actual_mw"], r["naive_forecast_mw"], r["naive_error_mw"]) == (1000.0, 990.0, -10.0)


def test_naive_input_has_the_same_cutoff(spark):
    late = [TRUTH[0], actual(CUTOFF + timedelta(minutes=1), 990.0, TARGET - timedelta(days=7), DAY - timedelta(days=7))]
    assert rows(spark, [], late)[0]["naive_forecast_mw"] is None


def test_each_hour_has_its_own_cutoff(spark):
    early, late = datetime(2026, 9, 22, 6), datetime(2026, 9, 23, 3)
    pub = datetime(2026, 9, 21, 17)
    got = rows(spark, [forecast(pub, 1111.0, target=t, he=h) for t, h in ((early, 2), (late, 23))], [actual(datetime(2026, 9, 23, 10), 1.0, t, DAY, h) for t, h in ((early, 2), (late, 23))])
    assert [r["ercot_forecast_mw"] for r in got] == [None, 1111.0]


def test_the_same_local_hour_is_167_hours_back_across_spring(spark):
    day, target = date(2026, 3, 14), datetime(2026, 3, 14, 16)
    past = [actual(datetime(2026, 3, 8, 12), mw, t, date(2026, 3, 7), he) for mw, t, he in ((777.0, datetime(2026, 3, 7, 17), 12), (666.0, datetime(2026, 3, 7, 16), 11))]
    (r,) = rows(spark, [], [actual(datetime(2026, 3, 15, 11), 800.0, target, day), *past], Params(datetime(2026, 3, 14, 5), datetime(2026, 3, 15, 5), datetime(2026, 3, 16, 5)))
    assert (r["naive_forecast_mw"], target - r["naive_source_ts_utc"]) == (777.0, timedelta(hours=167))


def test_repeated_hours_are_two_rows_and_totals_none(spark):
    day = date(2026, 11, 1)
    held = [actual(datetime(2026, 11, 2, 12), mw, datetime(2026, 11, 1, h), day, 2, f) for mw, h, f in ((1000.0, 6, "Y"), (900.0, 7, "N"))]
    held.append(actual(datetime(2026, 11, 2, 12), 5.0, datetime(2026, 11, 1, 6), day, 2, "Y", "SYSTEM_TOTAL"))
    got = rows(spark, [], held, Params(datetime(2026, 11, 1, 5), datetime(2026, 11, 2, 6), datetime(2026, 11, 3, 6)))
    assert [(r["dst_flag"], r["actual_mw"]) for r in got] == [("Y", 1000.0), ("N", 900.0)]


def test_empty_tables_give_empty_results(spark):
    assert rows(spark, [], []) == []


def test_selection_is_one_shuffle_with_a_group_limit(spark):
    from pyspark.sql import functions as F

    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.timestamp_seconds("id").alias("p"), F.col("id").cast("double").alias("v"))
    out = latest_eligible(df, ["k"], "p", F.timestamp_seconds(F.lit(50)), ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan
    assert sorted(map(tuple, out.select("k", "v", "v_count").collect()))[0] == (0, 49.0, 1)
    assert latest_hindsight(df, ["k"], "p", "v").where("k = 0").first()["v"] == 98.0


def test_many_deadlines_in_one_pass(spark):
    import random

    from hindcast.operators import asof

    rng = random.Random(8)
    vintages = [(rng.choice(["a", "b", None]), rng.randint(0, 40), rng.choice([1.0, 2.0, 3.0, None])) for _ in range(300)] + [("a", None, 9.0)]
    deadlines = [(k, d, f"{k}{d}") for k in ("a", "b", "c", None) for d in range(-1, 45)]
    v = spark.createDataFrame(vintages, "k string, pub int, value double").repartition(4)
    d = spark.createDataFrame(deadlines, "k string, at int, note string")
    out = asof.at_deadlines(v, ["k"], "pub", "value", d, "at")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    got = {(r["k"], r["at"], r["note"]): (r["pub"], r["value"], r["value_count"]) for r in out.collect()}
    for k, at, note in deadlines:
        before = [p for x, p, _ in vintages if x == k and p is not None and p <= at]
        values = {y for x, p, y in vintages if x == k and p == max(before, default=None) and y is not None} if before else set()
        assert got[k, at, note] == (max(before, default=None), min(values, default=None), len(values)), (k, at)
    assert asof.at_deadlines(v.where("false"), ["k"], "pub", "value", d, "at").where("value_count <> 0 or pub is not null").count() == 0


def test_every_key_by_one_scan(spark):
    rows = [("a", 1, 5.0), ("a", 3, 7.0), ("a", 3, 8.0), ("b", 9, 1.0), ("b", 8, 2.0), (None, 2, None), ("c", None, 4.0)]
    df = spark.createDataFrame(rows, "k string, pub int, value double").repartition(3)
    out = latest_eligible(df, ["k"], "pub", __import__("pyspark").sql.functions.lit(4), ["value"], every_key=True)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["k"]: (r["pub"], r["value"], r["value_count"]) for r in out.collect()} == {"a": (3, 7.0, 2), "b": (None, None, 0), None: (2, None, 0), "c": (None, None, 0)}
