"""As-of selection: the latest value that was knowable at each row's own deadline.

Every selection is one shuffle by its keys: ``rank`` keeps all rows at the latest publication (Catalyst plants a
group limit before the exchange), and the aggregate that follows reuses its partitioning. Ties are never broken: the
least value represents them and ``*_count`` tells how many there were.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.time import hours, minute_boundaries
from hindcast.schemas import EVALUATION_COLUMNS, SYSTEM_TOTAL


def latest_eligible(vintages: DataFrame, keys: list[str], publication: str, deadline: Column, values: list[str], every_key: bool = False) -> DataFrame:
    """For each key, the last publication at or before the deadline: keys, publication, each value's minimum and
    ``<value>_count`` of different values there. Keys without an eligible row give none, or with ``every_key`` one of
    nulls and counts of 0, by the same scan and exchange; null values do not count."""
    latest = F.rank().over(Window.partitionBy(*keys).orderBy(F.col(publication).desc()))
    known = F.col(publication) <= deadline
    rows = vintages.withColumns({c: F.when(known, F.col(c)) for c in (publication, *values)}) if every_key else vintages.where(known)
    rows = rows.withColumn("_rank", latest).where("_rank = 1")
    # different values by their dense rank: windows over the same keys, which spill, and no set of values in memory
    order = {f"_{v}_order": F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col(v).asc_nulls_last())) for v in values}
    count = {v: F.coalesce(F.max(F.when(F.col(v).isNotNull(), F.col(f"_{v}_order"))), F.lit(0)).cast("bigint") for v in values}
    found = [c for v in values for c in (F.min(v).alias(v), count[v].alias(f"{v}_count"))]
    return rows.withColumns(order).groupBy(*keys).agg(F.max(publication).alias(publication), *found)


def latest_hindsight(vintages: DataFrame, keys: list[str], publication: str, value: str) -> DataFrame:
    """For each key the row published last, whatever the deadline; at a tie, the least value."""
    first = Window.partitionBy(*keys).orderBy(F.col(publication).desc(), F.col(value).asc_nulls_last())
    return vintages.withColumn("_row", F.row_number().over(first)).where("_row = 1").drop("_row")


def targets(actuals: DataFrame, start: Column, end: Column) -> DataFrame:
    """The hours to judge: those of the actuals held in [start, end), without the total."""
    inside = (F.col("weather_zone") != SYSTEM_TOTAL) & (F.col("target_ts_utc") >= start) & (F.col("target_ts_utc") < end)
    return actuals.where(inside).select("weather_zone", "target_ts_utc", "operating_date", "hour_ending", "dst_flag").distinct()


def calendar_lag_candidates(wanted: DataFrame, actuals: DataFrame, lag_days: int, cutoff_lag: int) -> DataFrame:
    """Actuals of the same local hour ``lag_days`` operating days before each target, published by its deadline.

    The equality keys drive the join and the deadline is its residual; hours in UTC would be wrong across a clock change.
    """
    past = actuals.select(
        "weather_zone",
        F.date_add("operating_date", lag_days).alias("operating_date"),
        "hour_ending",
        "dst_flag",
        F.col("target_ts_utc").alias("naive_source_ts_utc"),
        F.col("publication_ts_utc").alias("naive_source_publication_ts_utc"),
        F.col("actual_mw").alias("naive_forecast_mw"),
    )
    found = wanted.join(past, ["weather_zone", "operating_date", "hour_ending", "dst_flag"])
    return found.where(F.col("naive_source_publication_ts_utc") <= F.col("target_ts_utc") - hours(cutoff_lag))


@dataclass(frozen=True)
class Params:
    window_start: datetime
    window_end: datetime
    processing_ts: datetime
    cutoff_lag_hours: int = 24
    seasonal_lag_days: int = 7


def evaluation_dataset(forecasts: DataFrame, actuals: DataFrame, params: Params) -> DataFrame:
    """One row for each zone and target hour, with what was known at its deadline, its truth and the naive forecast.

    A side without an eligible row is null and never filled from a later publication. Rows loaded several times change
    nothing: selections use maxima, minima and counts of different values.
    """
    key = ["weather_zone", "target_ts_utc"]
    start, end, seen = (F.lit(t) for t in (params.window_start, params.window_end, params.processing_ts))
    cutoff = F.col("target_ts_utc") - hours(params.cutoff_lag_hours)
    wanted = targets(actuals, start, end)
    inside = (F.col("target_ts_utc") >= start) & (F.col("target_ts_utc") < end) & (F.col("weather_zone") != SYSTEM_TOTAL)
    forecast = latest_eligible(forecasts.where(inside & F.col("is_ercot_model_in_use")), key, "publication_ts_utc", cutoff, ["forecast_mw", "model"])
    forecast = forecast.select(
        *key,
        F.col("publication_ts_utc").alias("ercot_publication_ts_utc"),
        F.col("forecast_mw").alias("ercot_forecast_mw"),
        F.col("model").alias("ercot_model"),
        F.col("forecast_mw_count").alias("ercot_value_count"),
        F.col("model_count").alias("ercot_model_count"),
    )
    actual = latest_eligible(actuals.where(inside), key, "publication_ts_utc", seen, ["actual_mw"]).withColumnsRenamed({"publication_ts_utc": "actual_publication_ts_utc", "actual_mw_count": "actual_value_count"})
    candidates = calendar_lag_candidates(wanted, actuals.where(F.col("weather_zone") != SYSTEM_TOTAL), params.seasonal_lag_days, params.cutoff_lag_hours)
    naive = latest_eligible(candidates, key, "naive_source_publication_ts_utc", cutoff, ["naive_source_ts_utc", "naive_forecast_mw"])
    naive = naive.drop("naive_source_ts_utc_count").withColumnRenamed("naive_forecast_mw_count", "naive_value_count")
    out = wanted.join(forecast, key, "left").join(actual, key, "left").join(naive, key, "left")
    counts = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("ercot_value_count", "ercot_model_count", "actual_value_count", "naive_value_count")}
    out = out.withColumns(counts).withColumn("cutoff_ts_utc", cutoff)
    out = out.withColumns(
        {
            "ercot_vintage_age_hours": minute_boundaries(F.col("ercot_publication_ts_utc"), F.col("cutoff_ts_utc")) / 60.0,
            "ercot_error_mw": F.col("ercot_forecast_mw") - F.col("actual_mw"),
            "naive_error_mw": F.col("naive_forecast_mw") - F.col("actual_mw"),
        }
    )
    return out.select(*EVALUATION_COLUMNS)


def in_order(evaluation: DataFrame) -> DataFrame:
    """The evaluation dataset by hour and zone, for presentation: a table that is written and read again has no order."""
    return evaluation.orderBy("target_ts_utc", "weather_zone")


def at_deadlines(vintages: DataFrame, keys: list[str], published: str, value: str, deadlines: DataFrame, at: str) -> DataFrame:
    """``deadlines(*keys, at, ...)`` with what was known at each: ``published``, ``value`` and ``value_count``.

    Any number of deadlines a key in one pass: publications and deadlines are one table in the order of time, and each
    deadline takes the last publication that came before it or with it. Of different values in one publication the least
    stands, and their number tells; null values do not count. One exchange by the keys and one sort, whose order both
    windows share. A deadline before all publications has nulls and a count of 0; null keys are keys like others."""
    more = [c for c in deadlines.columns if c not in keys]
    key = [F.col(c) for c in keys]
    known = vintages.where(F.col(published).isNotNull()).select(*key, F.col(published).alias("_at"), F.lit(0).alias("_kind"), F.col(value).alias("_value"), F.lit(None).cast(deadlines.select(F.struct(*more)).schema[0].dataType).alias("_asked"))
    asked = deadlines.select(*key, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(vintages.schema[value].dataType).alias("_value"), F.struct(*more).alias("_asked"))
    together = Window.partitionBy(*keys, "_at", "_kind").orderBy("_value")
    upto = Window.partitionBy(*keys).orderBy("_at", "_kind", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # nulls sort first: places of values among those of their publication, without them
    place = F.dense_rank().over(together) - F.max(F.col("_value").isNull().cast("int")).over(together)
    # dealt by the keys at first, or the narrower window would deal by more and the wider one again
    rows = known.unionByName(asked).repartition(*keys).withColumns({"_place": place, "_least": F.min("_value").over(together)})
    told = F.when(F.col("_kind") == 0, F.struct(F.col("_at").alias("published"), F.col("_least").alias("value"), F.col("_place").cast("bigint").alias("n")))
    found = rows.withColumn("_told", F.last(told, ignorenulls=True).over(upto)).where("_kind = 1")
    return found.select(*keys, *[F.col("_asked")[c].alias(c) for c in more], F.col("_told.published").alias(published), F.col("_told.value").alias(value), F.coalesce("_told.n", F.lit(0)).cast("bigint").alias("value_count"))
